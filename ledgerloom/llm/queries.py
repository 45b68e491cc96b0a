"""The queries of this folder's operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    bpe,
    exact_dedup,
    huffman,
    language,
    line_templates,
    ngram_trie,
    packing,
    periodic_runs,
    quality_model,
    quality_rules,
    simhash,
    spelling_variants,
    toxicity,
)
from ledgerloom.llm.common import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return huffman.read_ids(*huffman.write_ids(documents(spark, sf_dir), path, end=0))


@query
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end=1)


@query
def op9_merge_replay_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_and_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query
def op10_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("bucket", "chain")


ORACLES["op1_exact_dedup"] = """
WITH normalised AS (
  SELECT doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normalised
"""


@query
def op4_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op5_output_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(documents(spark, sf_dir))


@query
def op7_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


@query
def op6_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(documents(spark, sf_dir))


@query
def op13_scale_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(documents(spark, sf_dir))


@query
def op12_variable_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(documents(spark, sf_dir))


@query
def op11_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.lm_scores(documents(spark, sf_dir))
