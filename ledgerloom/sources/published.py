"""Tables by day, whose days appear whole or not at all.

A write goes to a folder of its own, ``_data/version=.../DAY=...``. It is read back and
counted, and only then named by an entry of the table's manifest, one small file that Spark's
commit makes visible at once. Readers follow the manifest: a write that fails or does not
add up leaves the days as they were, and several days written together change together.
A day can be written in buckets by some keys; days that have the same buckets are joined by
these keys without a shuffle. A day has one writer at a time. Folders that no entry names any more are listed by
`superseded`, to be removed when no reader uses them.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DATA, MANIFEST = "_data", "_manifest"
ENTRY = (
    "number long, days array<struct<day: string, versions: array<string>, rows: long, "
    "buckets: int, keys: array<string>>>"
)


class Buckets(NamedTuple):
    keys: list[str]
    number: int


class Day(NamedTuple):
    versions: list[str]
    rows: int
    buckets: Buckets | None = None


def _entries(spark: SparkSession, path: str) -> DataFrame | None:
    """number, day, versions, rows, buckets, keys of all entries; one entry for each write."""
    try:
        entries = spark.read.schema(ENTRY).json(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return entries.select("number", F.inline("days"))


def _current(spark: SparkSession, path: str) -> tuple[dict[str, Day], int]:
    """The days as last published, and the number of the last entry. One row for each
    day comes to the driver."""
    entries = _entries(spark, path)
    if entries is None:
        return {}, 0
    last = F.max(F.struct("number", "versions", "rows", "buckets", "keys")).alias("last")
    found = entries.groupBy("day").agg(last).select("day", "last.*").collect()
    days = {r["day"]: Day(r["versions"], r["rows"], Buckets(r["keys"], r["buckets"]) if r["buckets"] else None) for r in found}
    return days, max((r["number"] for r in found), default=0)


def published_days(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of each published day, in order."""
    return {day: found.rows for day, found in sorted(_current(spark, path)[0].items())}


def _folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/{DATA}/version={version}"


def read_days(spark: SparkSession, path: str, column: str, days: list[str] | None = None) -> DataFrame | None:
    """Some days of a table, or all; None where none of them was ever published. Lists
    those days' folders only."""
    current = _current(spark, path)[0]
    chosen = sorted(set(current) if days is None else set(current) & set(days))
    if not chosen:
        return None
    folders = [f"{_folder(path, v)}/{column}={day}" for day in chosen for v in current[day].versions]
    table = spark.read.option("basePath", f"{path.rstrip('/')}/{DATA}").parquet(*folders)
    return table.withColumn(column, F.col(column).cast("date")).drop("version")


def read_day(spark: SparkSession, path: str, column: str, day: str) -> DataFrame | None:
    """One day of a table, by its buckets if it has any."""
    found = _current(spark, path)[0].get(day)
    if found is None or found.buckets is None:
        return read_days(spark, path, column, [day])
    folder = f"{_folder(path, found.versions[0])}/{column}={day}"
    # Spark knows buckets by its catalog only: a version gets a name there, and stays outside
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
    keys = ", ".join(f"`{k}`" for k in found.buckets.keys)
    name = f"ledgerloom_{found.versions[0]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {found.buckets.number} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name).withColumn(column, F.lit(day).cast("date"))


def _write_bucketed(df: DataFrame, folder: str, column: str, day: str, buckets: Buckets) -> int:
    """One file for each bucket. Returns the rows, which must all be of the day."""
    written, name = Observation(), f"ledgerloom_write_{uuid.uuid4().hex}"
    of_day = F.count_if(F.col(column) == F.lit(day).cast("date"))
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"), of_day.alias("of_day")).drop(column)
    rows = rows.repartition(buckets.number, *buckets.keys)
    path = f"{folder}/{column}={day}"
    rows.write.bucketBy(buckets.number, *buckets.keys).sortBy(*buckets.keys).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # its files stay
    if written.get["of_day"] != written.get["rows"]:
        raise RuntimeError(f"{path}: {written.get['rows']} rows, {written.get['of_day']} of {day}; nothing is published")
    return written.get["rows"]


def _rows_by_day(spark: SparkSession, folder: str, column: str) -> dict[str, int]:
    found = spark.read.parquet(folder).groupBy(F.col(column).cast("string").alias("day")).count()
    return {r["day"]: r["count"] for r in found.collect()}


def write_days(
    df: DataFrame, path: str, column: str, days: list[str], append: bool = False, buckets: Buckets | None = None
) -> dict[str, int]:
    """Publishes the rows of ``days``, which replace what these days had, or are added
    to it. Returns the rows of each day. A day without rows is published empty.

    The number written is observed by the write itself, not by a second run. Rows of one day
    are written without a shuffle; those of several days are rebalanced, which splits
    a large day over several writers. One day can be written in ``buckets`` instead, by a
    shuffle of its keys; rows added later have none, and the day is then read without.
    """
    if buckets is not None and (len(days) != 1 or append):
        raise ValueError("only a single day that is replaced is written in buckets")
    spark = df.sparkSession
    current, last = _current(spark, path)
    version = f"v{uuid.uuid4().hex}"
    folder = _folder(path, version)
    if buckets is not None:
        expected = _write_bucketed(df, folder, column, days[0], buckets)
    else:
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
        if len(days) > 1:
            rows = rows.hint("rebalance", F.col(column))
        rows.write.partitionBy(column).parquet(folder)
        expected = written.get["rows"]
    found = _rows_by_day(spark, folder, column) if expected else {}
    if sum(found.values()) != expected or not set(found) <= set(days):
        raise RuntimeError(f"{path}: {expected} rows of {days} expected, {found} found; nothing is published")
    for day in sorted(set(days) - set(found)):
        buckets = None
        df.drop(column).limit(0).write.mode("append").parquet(f"{folder}/{column}={day}")
    entry = []
    for day in sorted(set(days)):
        before = current.get(day, Day([], 0)) if append else Day([], 0)
        keys, number = buckets or ([], 0)
        entry.append((day, [*before.versions, version], before.rows + found.get(day, 0), number, keys))
    spark.createDataFrame([(last + 1, entry)], ENTRY).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{MANIFEST}")
    return {day: found.get(day, 0) for day in sorted(set(days))}


def write_day(
    df: DataFrame, path: str, column: str, day: str, append: bool = False, buckets: Buckets | None = None
) -> int:
    return write_days(df, path, column, [day], append, buckets)[day]


def superseded(spark: SparkSession, path: str, column: str) -> list[str]:
    """Folders of days that were published once and have been replaced since."""
    entries = _entries(spark, path)
    if entries is None:
        return []
    current = _current(spark, path)[0]
    named = entries.select("day", F.explode("versions").alias("version")).distinct().collect()
    return sorted(f"{_folder(path, r['version'])}/{column}={r['day']}" for r in named if r["version"] not in current[r["day"]].versions)
