"""Joins whose cost does not depend on how evenly the keys are spread.

They measure first: a call runs a small job, and the plan it returns has only what
the data needs.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.workdir import checkpointed

# A lookup of at most this many rows and bytes is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot with more than this share of all rows, so there are under 10,000 of
# them, and more than this many rows, below which one task has no trouble.
HOT_SHARE = 0.0001
HOT_ROWS = 1_000_000


# The smallest share that a sketch of frequent keys answers for; it then tracks 800,000 keys.
SKETCH_SHARE = 0.00001
# Keys tracked for each key that can have the share. The sketch is wrong by at most 2.7 in
# ``TRACKED`` of the share, and lists every key of more than twice that.
TRACKED = 8
# Hashes of candidates that a plan lists by themselves.
MOST_NAMED = 1000


def hot_keys(df: DataFrame, keys: list[str], share: float, rows: int = 0) -> DataFrame:
    """Keys with more than ``share`` of all rows and more than ``rows`` rows, with
    their count and share.

    A sketch of frequent keys comes first, made by every task of its own rows and merged.
    Only the rows of the at most ``2 / share`` keys that it names are counted, so that no
    other key is shuffled; the counts are exact. Below ``SKETCH_SHARE`` all keys are counted.
    """
    least = share
    if rows and share < SKETCH_SHARE:
        least = max(share, rows / max(1, df.count()))
    if least >= 1:  # not even a key with all rows
        return _counted(df.filter(F.lit(False)), keys, 1, share, rows)
    if least < SKETCH_SHARE:
        return hot_groups(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "n", share, rows)
    names, total = frequent_hashes(df, keys, least)
    return _counted(_with_hash(df, keys, names), keys, total, share, rows)


def _key_hash(keys: list[str]) -> Column:
    """Keys of one hash are counted apart afterwards, so a collision costs nothing."""
    return F.xxhash64(*keys)


def _with_hash(df: DataFrame, keys: list[str], names: list[int]) -> DataFrame:
    """The rows whose key has one of these hashes: a list in the plan, or if it is long a
    broadcast of at most ``2 / SKETCH_SHARE`` numbers."""
    if len(names) <= MOST_NAMED:
        return df.filter(_key_hash(keys).isin(names))
    side = df.sparkSession.createDataFrame([(n,) for n in names], "_key long")
    return df.withColumn("_key", _key_hash(keys)).join(F.broadcast(side), "_key", "left_semi").drop("_key")


def _counted(df: DataFrame, keys: list[str], total: int, share: float, rows: int) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("share", F.col("n") / F.lit(total))
    return counts.filter((F.col("share") > share) & (F.col("n") > rows))


def frequent_hashes(df: DataFrame, keys: list[str], share: float) -> tuple[list[int], int]:
    """Hashes of keys, among them all with more than ``share`` of the rows, and the number
    of rows. A sketch has a bounded size, tasks' sketches are merged in two steps."""
    tracked = min(1_000_000, ceil(TRACKED / share))
    groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashes = df.select(_key_hash(keys).alias("_key"))
    parts = hashes.groupBy((F.spark_partition_id() % groups).alias("_part")).agg(
        F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    merged = parts.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n")
    )
    most = min(tracked, ceil(2 / share))
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("keys"), "n").first()
    if found is None:
        return [], 0
    # an estimate is never below the count
    return [k["item"] for k in found["keys"] if k["count"] > share * found["n"]], found["n"]


def hot_groups(groups: DataFrame, count: str, share: float, rows: int = 0) -> DataFrame:
    """The same from one row per key with its number of rows in ``count``."""
    total = groups.agg(F.sum(count)).scalar()
    return groups.withColumn("share", F.col(count) / total).filter(
        (F.col("share") > share) & (F.col(count) > rows)
    )


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` may be broadcast; meant for lookup tables."""
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``, in one pass over it."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    sizes = [F.lit(8 * len(df.columns))]
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, nested):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
    size = reduce(lambda a, b: a + b, sizes).cast("bigint")
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first())


def worth_splitting(hot: DataFrame) -> bool:
    """Whether there are hot keys. Should these few rows be so wide that they are
    over the limit of a broadcast, the skew is left to the adaptive join."""
    rows, size = measured(hot)
    return rows > 0 and size <= BROADCAST_BYTES


def split_hot(
    df: DataFrame,
    hot_lookup: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    broadcast: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in ``hot_lookup``, with its values, and all other rows.

    ``hot_lookup`` has one row for each of a few keys and is broadcast; with
    ``broadcast=False`` it may be long and is met by a shuffle, whose skewed
    partitions adaptive execution splits. A NULL in a key finds nothing and is in the
    first part as well, with NULL values, unless ``null_safe`` makes NULL an ordinary key.
    """
    values = [c for c in hot_lookup.columns if c not in keys]
    marked = hot_lookup.select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], *values, F.lit(True).alias("_hot")
    )
    side = F.broadcast(marked) if broadcast else marked
    flagged = df.join(side, _same(keys, "_hot_", null_safe), "left")
    done = F.col("_hot").isNotNull()
    if not null_safe:
        done = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], done)
    return flagged.filter(done).select(*df.columns, *values), flagged.filter(~done).select(*df.columns)


def _same(keys: list[str], prefix: str, null_safe: bool) -> Column:
    pairs = [(F.col(k), F.col(f"{prefix}{k}")) for k in keys]
    equal = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, equal)


def left_join(df: DataFrame, lookup: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Plain left join; keeps the column order, and matches NULLs if ``null_safe``."""
    values = [c for c in lookup.columns if c not in keys]
    right = lookup.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *values)
    return df.join(right, _same(keys, "_right_", null_safe), "left").select(*df.columns, *values)


def split_join(
    df: DataFrame,
    lookup: DataFrame,
    hot_lookup: DataFrame,
    keys: list[str],
    null_safe: bool = False,
) -> DataFrame:
    """Left join to ``lookup`` (at most one row per key), hot keys apart.

    ``hot_lookup`` is the few lookup rows of hot keys. Rows with such a key are not
    shuffled; the rest is joined as usual. Every row takes exactly one of the ways.
    """
    if not worth_splitting(hot_lookup):
        return left_join(df, lookup, keys, null_safe)
    hot_rows, cold_rows = split_hot(df, hot_lookup.select(*lookup.columns), keys, null_safe)
    return hot_rows.unionByName(left_join(cold_rows, lookup, keys, null_safe))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a table with at most one row per key.

    A lookup that is measured and fits is broadcast. Beyond that the keys of ``df``
    are counted: without a hot key it is a plain join, else see `split_join`, where
    at most ``1 / hot_share`` rows are broadcast.
    """
    if fits_broadcast(lookup, max_broadcast_rows):
        return left_join(df, F.broadcast(lookup), keys)
    hot = checkpointed(hot_keys(df, keys, hot_share, hot_rows).select(*keys))
    if not worth_splitting(hot):
        return left_join(df, lookup, keys)
    return split_join(df, lookup, hot_lookup_rows(hot, lookup, keys), keys)


def hot_lookup_rows(hot: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """One row per hot key with the lookup's values, NULL where it has none: rows
    with a hot key that finds nothing must not be shuffled either."""
    found = checkpointed(lookup.join(F.broadcast(hot), keys, "left_semi"))
    return left_join(hot, F.broadcast(found), keys)


def join_group_values(
    df: DataFrame,
    groups: DataFrame,
    keys: list[str],
    count: str,
    null_safe: bool = False,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a table made by grouping ``df`` by ``keys``, whose column
    ``count`` is the rows per group and so names the hot keys. Drops ``count``.

    The groups are computed once, into a checkpoint.
    """
    groups = checkpointed(groups)
    hot = hot_groups(groups, count, hot_share, hot_rows).drop("share")
    if not worth_splitting(hot):
        return left_join(df, groups.drop(count), keys, null_safe)
    return split_join(df, groups.drop(count), hot.drop(count), keys, null_safe)


def with_exists_flag(
    df: DataFrame, codes: DataFrame, key: str, flag: str = "IS_VALID", **options
) -> DataFrame:
    """``flag`` = 1 where ``key`` is in ``codes``, else NULL; never adds rows."""
    known = codes.select(key).dropna().distinct().withColumn(flag, F.lit(1))
    return lookup_join(df, known, [key], **options)


def join_unique(
    many: DataFrame, unique: DataFrame, keys: list[str], how: str = "inner", **options
) -> DataFrame:
    """Join to a table with one row per key: inner, left, right or full.

    "left" keeps every row of ``many``, "right" every row of ``unique``, whichever
    has no partner padded with NULL. A hot key of ``many`` is no trouble: matches
    come from `lookup_join`, and rows of ``unique`` without a partner from an anti
    join against the distinct keys of ``many``.
    """
    found = lookup_join(many, unique.withColumn("_found", F.lit(True)), keys, **options)
    matched = found if how in ("left", "full") else found.filter(F.col("_found"))
    result = matched.drop("_found")
    if how in ("right", "full"):
        alone = unique.join(many.select(*keys).distinct(), keys, "left_anti")
        result = result.unionByName(alone, allowMissingColumns=True)
    return result
