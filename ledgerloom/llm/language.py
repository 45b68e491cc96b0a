"""Operator 5: language by error-correcting output codes.

Each language has a codeword. For every bit a binary classifier tells from character
n-grams which half of the languages a text is in; the halves differ from bit to bit, so
single wrong bits are corrected. Classifiers are log odds of hashed n-grams; the counts
behind them come from all documents to learn from. A text gets the language with the least
loss, a sum over the bits of the logistic loss of the margin, weighted by how well the bit
separates the languages. Where the second best is nearly as good, the text is flagged.

Letters of the whole text are read, in lower case. A text without a letter, or null, is
``und`` with score 0. So is every text where there is nothing to learn from; with one
language that is the answer for all. Rows of null lang are not learned from. Of more than
``LANGUAGES`` values of lang the most frequent are learned. Repeated rows get equal answers.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import COUNTS, fold, rows_of, summed, text_of

BUCKETS = 4096
LANGUAGES = 256
#: Loss between the two best codewords, as a share of all bits' weight, that is ambiguous.
AMBIGUOUS = 0.1

#: What is no letter (category L). The module re has no categories.
_OTHER = regex.compile(r"\P{L}+")


def grams(text: str) -> np.ndarray:
    """Counts of hashed runs of 2 to 4 bytes of the text's letters; empty without any."""
    words = _OTHER.sub(" ", text.lower()).strip()
    if not words:
        return np.zeros(0, np.int64)
    b = np.frombuffer(f" {words} ".encode(), np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:]
    four = three[:-1] * np.uint32(269) + b[3:]
    found = np.concatenate([two, three + np.uint32(1 << 20), four + np.uint32(1 << 28)])
    found = (found * np.uint32(2654435761)) >> np.uint32(20)  # the top 12 bits: 4096 buckets
    return np.bincount(found, minlength=BUCKETS)


def codewords(n: int) -> np.ndarray:
    """n words of +1 and -1: every way to halve up to 6 languages, else the best of some
    random codes by their least distance."""
    if n < 2:
        return np.zeros((n, 0), np.int64)
    if n <= 6:
        columns = [[1] + [-1 if i in out else 1 for i in range(1, n)] for k in range(1, n) for out in combinations(range(1, n), k)]
        return np.array(columns, np.int64).T.reshape(n, -1)
    draw, length = np.random.default_rng(11), 8 * int(np.ceil(np.log2(n)))
    tries = [draw.choice([-1, 1], (n, length)) for _ in range(50)]
    tries = [t for t in tries if (np.abs(t.sum(0)) < n).all()] or tries
    return max(tries, key=lambda t: (length - (t @ t.T + np.diag([-length * 2] * n)).max()))


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # language x bit
    odds: np.ndarray  # bucket x bit
    scale: np.ndarray
    weight: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[str, float, bool]:
        total = counts.sum()
        if not total or not self.languages:
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = 4 * (counts @ self.odds) / total / self.scale
        loss = (self.weight * np.logaddexp(0, -self.codes * margin)).sum(1)
        order = np.argsort(loss, kind="stable")
        like = np.exp(np.clip(loss.min() - loss, -30, 0) * min(1.0, total / 100))
        return self.languages[order[0]], float(like[order[0]] / like.sum()), bool(loss[order[1]] - loss[order[0]] < AMBIGUOUS)


def fit(languages: list[str], counts: np.ndarray) -> Model:
    """``counts``: language x bucket."""
    codes = codewords(len(languages))
    share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    halves = [(share[codes[:, b] > 0].mean(0), share[codes[:, b] < 0].mean(0)) for b in range(codes.shape[1])]
    if not halves:
        return Model(languages, codes, np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(0))
    odds = np.stack([np.log(a) - np.log(b) for a, b in halves], 1)
    mean = share @ odds
    spread = np.sqrt(np.maximum(share @ odds**2 - mean**2, 1e-9))
    scale = np.maximum(np.abs(mean).mean(0), 1e-6)
    weight = np.maximum((mean * codes / spread).min(0), 1e-3)
    return Model(languages, codes, odds, scale, weight / weight.sum())


def _count(names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in enumerate(names)}
        counts = np.zeros((len(names), BUCKETS), np.int64)
        for batch in batches:
            for part in rows_of(batch):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    found = grams(text)
                    if len(found):
                        counts[place[lang]] += found
        for i in np.flatnonzero(counts.sum(1)):
            yield pa.RecordBatch.from_arrays([pa.array([names[i]]), pa.array([counts[i].tobytes()])], ["name", "counts"])

    return run


def learn(docs: DataFrame, most: int = LANGUAGES) -> Model:
    """The classifiers, from n-gram counts of all documents to learn from."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "doc_id", text_of().alias("text"))
    rows = rows.filter((fold() != 0) & F.col("lang").isNotNull())
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()
    names = sorted(r["lang"] for r in known)
    if not names:
        return fit([], np.zeros((0, BUCKETS)))
    some = rows.filter(F.col("lang").isin(names)).select("lang", "text").mapInArrow(_count(names), COUNTS)
    totals = summed(some)
    names = [name for name in names if name in totals]
    return fit(names, np.array([totals[name] for name in names]).reshape(len(names), BUCKETS))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch):
                found = [model.predict(grams(t)) for t in part.column("text").to_pylist()]
                columns = [pa.array(v, k) for v, k in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "ambiguous"])

    texts = docs.select("doc_id", text_of().alias("text"))
    found = texts.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "ambiguous")


def languages(docs: DataFrame) -> DataFrame:
    return predicted(docs, learn(docs))
