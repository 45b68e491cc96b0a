"""Text, CSV, JSON and Parquet, in and out."""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.quality import require_rows


def read_lines(
    spark: SparkSession, paths: str | list[str], partitions: int | None = None
) -> DataFrame:
    """One row per line, column ``value``; raises if there is none.

    A gzip file is one task. ``partitions`` spreads its lines again, which is
    worth a shuffle only before row-level work; an aggregate right after the scan
    combines in the scan task and is better off without.
    """
    lines = require_rows(spark.read.text(paths), str(paths))
    return lines.repartition(partitions) if partitions else lines


#: Large files whose lines are dealt at most.
MOST_DEALT = 1000
#: Files of these names are read by one task each, whatever their size.
WHOLE = r"\.(gz|zst|snappy|lz4|deflate)$"


def task_bytes(spark: SparkSession, n_files: int, total: int) -> int:
    """Bytes that Spark gives a scan task: at most a file split, and less if there would be
    fewer tasks than cores."""
    conf, cores = spark.conf, spark.sparkContext.defaultParallelism
    most, opening = (_bytes(conf.get(f"spark.sql.files.{c}")) for c in ("maxPartitionBytes", "openCostInBytes"))
    return max(1, min(most, max(opening, (total + n_files * opening) // cores)))


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def read_dealt_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`read_lines` for compressed files of unequal size.

    The files are listed with their sizes, and nothing of them is read for that. Those
    larger than a task's share are read by a task each and their lines dealt evenly over as
    many tasks as they have shares; the others are packed into tasks by the scan.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")
    n_files, total = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    share = task_bytes(spark, n_files, total)
    large = listed.filter(F.col("path").rlike(WHOLE) & (F.col("length") > share))
    files = [(r["path"], r["length"]) for r in large.limit(MOST_DEALT + 1).collect()]
    if not files or len(files) > MOST_DEALT:
        return read_lines(spark, paths)
    tasks = ceil(sum(size for _, size in files) / share)
    dealt = require_rows(spark.read.text([path for path, _ in files]), str(paths)).repartition(tasks)
    if len(files) == n_files:
        return dealt
    small = spark.read.text(paths).filter(~F.col("_metadata.file_path").isin([path for path, _ in files]))
    return small.unionByName(dealt)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without ``schema`` the types are inferred, which reads
    the files twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_csv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, max_records: int | None = None) -> None:
    """Replaces the whole dataset at ``path``."""
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", max_records) if max_records else writer).parquet(path)


def write_partitions(df: DataFrame, path: str, by: list[str], append: bool = False) -> None:
    """Parquet partitioned by ``by``, over many values of it.

    The rebalance hint gathers a partition's rows into files of good size and
    splits a large partition over several writers, so there are neither many
    small files nor one slow writer. The partitions in ``df`` are replaced, so writing
    them again does not double them; ``append`` adds to them instead.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("append" if append else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )

