"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.workdir import new_folder

#: A session setting: a finished write drops the shuffle files that it read.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes that separate words, in every operator that counts words.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str = "doc_id", by: int = 5) -> Column:
    """Remainder of the CRC-32 of a key's decimal text: which rows are held out."""
    return F.crc32(F.col(column).cast("string")) % by


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it cuts the lineage, fixes
    what a second evaluation might order differently, and outlives an executor."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _setting(spark, CLEANUP, "true"):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(batch: pa.RecordBatch, most_bytes: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most_bytes`` of text each, one row at least, so
    that the Python objects of a slice fit a worker."""
    if not batch.num_rows:
        return
    ends, values = [], batch.column(column)
    size, start = 0, 0
    for i, n in enumerate(pc.binary_length(values).to_pylist()):
        size += n or 0
        if size >= most_bytes:
            ends.append(i + 1)
            size = 0
    if not ends or ends[-1] != batch.num_rows:
        ends.append(batch.num_rows)
    for end in ends:
        yield batch.slice(start, end - start)
        start = end


#: Rows of ``summed``: arrays of 64-bit counts by name.
COUNTS = "name string, counts binary"


def _sum(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = np.frombuffer(data, np.int64)
            totals[name] = totals[name] + counts if name in totals else counts
    for name, counts in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([counts.tobytes()])], ["name", "counts"])


def summed(found: DataFrame, parts: int = 16) -> dict[str, np.ndarray]:
    """Adds up the arrays of one length that each task has for each name, in ``parts``
    tasks and then on the driver, which gets at most ``parts`` arrays for a name."""
    dealt = found.withColumn("part", F.spark_partition_id() % parts).repartition(parts, "part")
    totals: dict[str, np.ndarray] = {}
    for r in dealt.select("name", "counts").mapInArrow(_sum, COUNTS).collect():
        counts = np.frombuffer(r["counts"], np.int64)
        totals[r["name"]] = totals[r["name"]] + counts if r["name"] in totals else counts
    return totals


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_where(docs: DataFrame, verdict: DataFrame, keep: Column, *also: str) -> DataFrame:
    """The rows of ``docs`` whose doc_id, text and columns ``also`` have a verdict that says
    ``keep``; it has the text as text_sha. Null keys meet null keys."""
    names = ["doc_id", "text_sha", *also]
    sha, *kept = unused(docs, "_sha", *(f"_kept_{c}" for c in names))
    some = verdict.filter(keep).select(*(F.col(c).alias(k) for c, k in zip(names, kept, strict=True)))
    same = F.col(sha).eqNullSafe(F.col(kept[1])) & F.col("doc_id").eqNullSafe(F.col(kept[0]))
    for c, k in zip(also, kept[2:], strict=True):
        same = same & F.col(c).cast("string").eqNullSafe(F.col(k))
    return docs.withColumn(sha, text_hash()).join(some, same, "left_semi").drop(sha)


def text_hash(column: str = "text") -> Column:
    """SHA-256 of the text, as column text_sha."""
    return F.sha2(text_of(column), 256).alias("text_sha")


def keep_one(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """For each doc_id and text_sha of ``kept``, which has them once, one row of ``docs``
    with all columns: of repeated rows, that whose columns as JSON come first. Null doc_ids
    meet null doc_ids. ``kept`` must be cheap to read twice."""
    sha, kept_id, kept_sha = unused(docs, "_sha", "_kept_id", "_kept_sha")
    marked = docs.withColumn(sha, text_hash())
    ids = kept.select(F.col("doc_id").alias(kept_id), F.col("text_sha").alias(kept_sha))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    repeated = docs.groupBy("doc_id", text_hash().alias(sha)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = written(repeated.select(F.col("doc_id").alias(kept_id), F.col(sha).alias(kept_sha)), "repeated")
    rows = marked.join(ids, same, "left_semi")
    if repeated.isEmpty():
        return rows.drop(sha)
    once = rows.join(repeated, same, "left_anti").drop(sha)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    again = rows.join(repeated, same, "left_semi").groupBy("doc_id", sha).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return once.unionByName(again.select("row.*"))


#: A key with more than this share of all rows is met by a broadcast. Fewer than
#: ``1 / HOT_SHARE`` keys can be that large, whatever the size of the table.
HOT_SHARE = 0.001


def join_sized(rows: DataFrame, table: DataFrame, on: list[str], size: str) -> DataFrame:
    """Inner join with a table that has each key once, and in column ``size`` how many of
    ``rows`` the key has. Rows of the largest keys are not shuffled; a skewed partition of
    the others can be split by adaptive execution. Both sides must be cheap to read twice."""
    total = table.agg(F.sum(size)).first()[0] or 0
    hot = table.filter(F.col(size) > total * HOT_SHARE)
    n_hot = hot.count()  # less than 1 / HOT_SHARE, since sizes add up to total
    if not n_hot:
        return rows.join(table, on)
    few = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(few, on).unionByName(rest.join(table, on))
