"""General aggregates that stay cheap when one key holds much of the data."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalars import salt
from ledgerloom.operators.joins import (
    BROADCAST_BYTES,
    HOT_ROWS,
    fits_broadcast,
    hot_groups,
    hot_keys,
    join_group_values,
    left_join,
    measured,
    split_hot,
)
from ledgerloom.sources.workdir import checkpointed

# A window task orders at most about this many rows of a key, however large the table:
# a key is hot by its rows alone, whatever its share.
HOT_WINDOW_SHARE = 0.0
# Order values in a piece of a bucket that is hot itself.
PIECE_ROWS = HOT_ROWS
# Rows of a hot key that borders from a sketch put in one bucket, and the most borders of a
# key. A key of more rows has larger buckets; the windows sort those on disk.
BUCKET_ROWS = HOT_ROWS // 2
MOST_BUCKETS = 4096


def salted_sum_count(
    df: DataFrame, key: str, value: str, salt_by: list[str], buckets: int = 16
) -> DataFrame:
    """Sum and count by key in two steps, the first one by (key, salt).

    Spark's map-side combine already spreads a hot key for sum and count; this
    form also spreads its final merge.
    """
    first = df.groupBy(key, salt(salt_by, buckets).alias("_salt")).agg(
        F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    return first.groupBy(key).agg(F.sum("_sum").alias("total"), F.sum("_n").alias("n"))


def total_length(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.agg(F.sum(F.length(column)).alias("total_length"))


def join_back_summary(
    df: DataFrame, keys: list[str], aggregates: list[Column], **hot
) -> DataFrame:
    """Each row with the aggregates of its group; NULL keys get none. A window would
    sort a whole group in one task; here a hot group's rows are not even shuffled."""
    summary = df.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias("_rows"))
    return join_group_values(df, summary, keys, "_rows", **hot)


def _split_hot_keys(
    df: DataFrame, key: str, hot_share: float, hot_rows: int
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of hot keys, or None if there is no such key, and all other rows."""
    hot = checkpointed(hot_keys(df, [key], hot_share, hot_rows).select(key))
    return _split(df, hot, [key])


def _split(
    df: DataFrame, hot: DataFrame, keys: list[str]
) -> tuple[DataFrame | None, DataFrame]:
    """The same for a list of hot keys, which is broadcast where it is small."""
    rows, size = measured(hot)
    if not rows:
        return None, df
    return split_hot(df, hot, keys, null_safe=True, broadcast=size <= BROADCAST_BYTES)


def _scale(df: DataFrame, order: str) -> Column:
    """A number or time that never falls where ``order`` grows, for a quantile sketch."""
    kind, column = df.schema[order].dataType, F.col(order)
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    if isinstance(kind, T.StringType):  # the first 7 bytes as one number
        first = F.rpad(F.hex(F.substring(F.encode(column, "utf-8"), 1, 7)), 14, "0")
        return F.when(column.isNotNull(), F.conv(first, 16, 10).cast("bigint"))
    raise TypeError(f"{order} of type {kind.simpleString()} needs a bucket")


def quantile_bucket(df: DataFrame, key: str, order: str, rows: int) -> DataFrame:
    """``df`` with _bucket: it grows with ``order`` and has about ``rows`` rows of a key,
    unless more rows tie.

    Every task makes a sketch of quantiles of its rows of each key; merged, they give a
    key's borders, as many as its rows call for. A row finds its bucket by halving.
    """
    scaled = df.select(key, _scale(df, order).alias("_scale"))
    sizes = scaled.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    most = min(MOST_BUCKETS, ceil(largest / rows))
    if most <= 1:
        return df.withColumn("_bucket", F.when(F.col(order).isNotNull(), 0).otherwise(-1))
    shares = F.array(*[F.lit(i / most) for i in range(1, most)])
    own = F.least(F.ceil(F.count(F.lit(1)) / rows), F.lit(most)).cast("int")
    found = scaled.groupBy(key).agg(F.percentile_approx("_scale", shares, 20 * most).alias("_all"), own.alias("_own"))
    # of the borders of the largest key, every so many
    some = F.transform(F.sequence(F.lit(1), F.col("_own") - 1), lambda i: F.get("_all", F.floor(i * most / F.col("_own")).cast("int") - 1))
    borders = checkpointed(found.select(key, F.when(F.col("_own") > 1, some).alias("_borders")))
    side = F.broadcast(borders) if fits_broadcast(borders) else borders
    joined = left_join(df.withColumn("_scale", _scale(df, order)), side, [key], null_safe=True)
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("_borders", at + step - 1) < F.col("_scale"), at + step).otherwise(at)

    bucket = F.when(F.col("_scale").isNull(), -1).otherwise(F.aggregate(halves, F.lit(0), further))
    return joined.withColumn("_bucket", bucket).select(*df.columns, "_bucket")


def _over_buckets(
    df: DataFrame, key: str, order: str, step: Column, bucket: Column | None, hot_share: float, hot_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """Cuts the rows of hot keys into pieces that a task can order.

    ``bucket`` must grow with ``order``; without one it is between quantiles. Returns rows to be ordered inside (key,
    _bucket), and rows of the few (key, _bucket) that are too large for that, or
    None if there are none.

    The first part has one more row per (key, _bucket), with _first = 0, that sorts
    before the others and brings what earlier buckets add up to as _offset, so that
    no join is needed. The second part has the same as columns of its rows.
    """
    if bucket is None:
        df = quantile_bucket(df, key, order, BUCKET_ROWS)
    else:
        df = df.withColumn("_bucket", bucket)
    rows = df.withColumn("_step", step)
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = checkpointed(
        rows.groupBy(key, "_bucket")
        .agg(F.sum("_step").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
        .select(
            key,
            "_bucket",
            F.sum("_sum").over(earlier).alias("_offset"),
            F.sum("_rows").over(Window.partitionBy(key)).alias("_key_rows"),
            "_rows",
        )
    )
    hot = hot_groups(buckets, "_rows", hot_share, hot_rows).drop("_rows", "share")
    large, rest = _split(rows, hot, [key, "_bucket"])
    heads = buckets.drop("_rows").withColumn("_first", F.lit(0))
    ordered = rest.withColumn("_first", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return ordered, large


def _points(large: DataFrame, key: str, order: str) -> DataFrame:
    """One row per order value of a large bucket: copies of a row, and rows that
    tie, are combined before they are shuffled."""
    return large.groupBy(key, "_bucket", order).agg(
        F.sum("_step").alias("_sum"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("_offset").alias("_offset"),
        F.max("_key_rows").alias("_key_rows"),
    )


def _summed_to_here(points: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``points`` with _inside, the sum of ``value`` in (key, _bucket) up to each row.

    A bucket may have any number of order values: ranges of at most about
    ``PIECE_ROWS`` of them are summed on their own, and each is offset by the sum of
    the ranges before it.
    """
    points = checkpointed(points)
    pieces = ceil(points.count() / PIECE_ROWS)
    if pieces <= 1:
        whole = Window.partitionBy(key, "_bucket").orderBy(order)
        return points.withColumn("_inside", F.sum(value).over(whole))
    ranged = points.repartitionByRange(pieces, key, "_bucket", order)
    ranged = checkpointed(ranged.withColumn("_piece", F.spark_partition_id()))
    groups = [key, "_bucket", "_piece"]
    earlier = Window.partitionBy(key, "_bucket").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy(*groups).agg(F.sum(value).alias("_piece_sum"))
    before = before.select(*groups, F.sum("_piece_sum").over(earlier).alias("_before_piece"))
    own = ranged.withColumn("_own", F.sum(value).over(Window.partitionBy(*groups).orderBy(order)))
    inside = F.coalesce(F.col("_own") + F.col("_before_piece"), "_own", "_before_piece")
    return left_join(own, before, groups, null_safe=True).select(*points.columns, inside.alias("_inside"))


def running_total(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    bucket: Column | None = None,
    name: str = "RunningTotal",
    hot_share: float = HOT_WINDOW_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``sum(value) OVER (PARTITION BY key ORDER BY order)``: rows that tie share one total.

    The plain window unless there are hot keys. Their rows are summed in pieces: between
    quantiles of ``order``, or by ``bucket`` if one is given, which must grow with ``order``
    (the day of a timestamp, say); in a bucket that is hot itself by order value. No task
    sorts all rows of a hot key.
    """
    hot_part, plain_part = _split_hot_keys(df, key, hot_share, hot_rows)
    whole = Window.partitionBy(key).orderBy(order)
    result = plain_part.withColumn(name, F.sum(value).over(whole))
    if hot_part is None:
        return result
    ordered, large = _over_buckets(hot_part, key, order, F.col(value), bucket, hot_share, hot_rows)
    # Sums skip NULL, so a total is NULL only where nothing was summed yet.
    so_far = Window.partitionBy(key, "_bucket").orderBy("_first", order)
    added = F.when(F.col("_first") == 0, F.col("_offset")).otherwise(F.col("_step"))
    bucketed = ordered.withColumn(name, F.sum(added).over(so_far)).filter(F.col("_first") == 1)
    result = result.unionByName(bucketed.select(*df.columns, name))
    if large is None:
        return result
    points = (
        _summed_to_here(_points(large, key, order), key, order, "_sum")
        .withColumn(name, F.coalesce(F.col("_inside") + F.col("_offset"), "_inside", "_offset"))
        .select(key, order, name, "_rows")
    )
    tied = join_group_values(
        large.select(*df.columns), points, [key, order], "_rows", True, hot_share, hot_rows
    )
    return result.unionByName(tied)


def percent_rank(
    df: DataFrame,
    key: str,
    order: str,
    bucket: Column | None = None,
    name: str = "percent_rank",
    hot_share: float = HOT_WINDOW_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``percent_rank() OVER (PARTITION BY key ORDER BY order)``, see `running_total`."""
    hot_part, plain_part = _split_hot_keys(df, key, hot_share, hot_rows)
    whole = Window.partitionBy(key).orderBy(order)
    result = plain_part.withColumn(name, F.percent_rank().over(whole))
    if hot_part is None:
        return result
    ordered, large = _over_buckets(hot_part, key, order, F.lit(1), bucket, hot_share, hot_rows)

    def rank(before: Column, key_rows: Column) -> Column:
        others = key_rows - 1
        return F.when(others > 0, before / others).otherwise(F.lit(0.0)).alias(name)

    so_far = Window.partitionBy(key, "_bucket").orderBy("_first", order)
    # The head row has rank 1 and the only _offset and _key_rows.
    offset = F.coalesce(F.max("_offset").over(so_far), F.lit(0))
    bucketed = (
        ordered.withColumn("_before", F.rank().over(so_far) - 2 + offset)
        .withColumn("_key_rows", F.max("_key_rows").over(so_far))
        .filter(F.col("_first") == 1)
        .select(*df.columns, rank(F.col("_before"), F.col("_key_rows")))
    )
    result = result.unionByName(bucketed)
    if large is None:
        return result
    points = (
        _summed_to_here(_points(large, key, order), key, order, "_rows")
        .withColumn("_before", F.col("_inside") - F.col("_rows") + F.coalesce("_offset", F.lit(0)))
        .select(key, order, rank(F.col("_before"), F.col("_key_rows")), "_rows")
    )
    tied = join_group_values(
        large.select(*df.columns), points, [key, order], "_rows", True, hot_share, hot_rows
    )
    return result.unionByName(tied)
