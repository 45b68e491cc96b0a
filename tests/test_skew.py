"""The skew-safe forms against the plain Spark operators, on data where one key
holds more than a third of the rows and others are NULL."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, joins
from ledgerloom.operators.aggregates import (
    join_back_summary,
    percent_rank,
    running_total,
    salted_sum_count,
)


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    key = F.when(n % 5 < 2, "hot").when(n % 5 == 2, None).otherwise(F.concat(F.lit("k"), n % 300))
    value = F.when(n % 11 != 0, n % 97)
    order = F.when(n % 13 != 0, F.pmod(n * 7919, F.lit(500)))
    return spark.range(5000).select(n, key.alias("k"), order.alias("o"), value.alias("v"))


def collected(df):
    return sorted(map(str, df.collect()))


# Nothing is hot, one key is hot, most keys are hot.
HOT = [{}, {"hot_share": 0.1, "hot_rows": 0}, {"hot_share": 0.0005, "hot_rows": 0}]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("options", [{"max_broadcast_rows": 10**6}, *({"max_broadcast_rows": 0, **h} for h in HOT)])
def test_join_unique(spark, rows, how, options):
    lookup = spark.range(0, 300, 2).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("x"))
    lookup = lookup.union(spark.createDataFrame([("hot", 7), (None, 8), ("alone", 9)], "k string, x int"))
    mine = joins.join_unique(rows, lookup, ["k"], how, **options)
    assert mine.columns == ["id", "k", "o", "v", "x"]
    plain = rows.join(lookup, "k", how).select(*mine.columns)
    assert collected(mine) == collected(plain)


def test_hot_key_that_finds_nothing(spark, rows):
    lookup = spark.createDataFrame([("k1", 1), ("k3", 3)], "k string, x int")
    hot = joins.hot_keys(rows, ["k"], 0.1).select("k")
    found = joins.hot_lookup_rows(hot, lookup, ["k"])
    assert {(r.k, r.x) for r in found.collect()} == {("hot", None), (None, None)}
    first, rest = joins.split_hot(rows, found, ["k"])
    assert rest.filter("k = 'hot' OR k IS NULL").isEmpty()
    assert first.count() + rest.count() == rows.count()
    mine = joins.lookup_join(rows, lookup, ["k"], max_broadcast_rows=0, hot_share=0.1, hot_rows=0)
    assert collected(mine) == collected(rows.join(lookup, "k", "left").select(*mine.columns))


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit(1)).alias("a"))
    assert joins.fits_broadcast(wide)
    assert not joins.fits_broadcast(wide, max_rows=99)
    assert not joins.fits_broadcast(wide, max_bytes=100_000)


def test_hot_keys(rows):
    hot = joins.hot_keys(rows, ["k"], 0.3).collect()
    assert [(r.k, r.n, r.share) for r in hot] == [("hot", 2000, 0.4)]
    # A share bounds the number of keys whatever the data.
    assert joins.hot_keys(rows, ["id"], 0.001).count() == 0


@pytest.mark.parametrize("hot", HOT)
def test_join_back_summary(rows, hot):
    mine = join_back_summary(rows, ["k"], [F.sum("v").alias("total")], **hot)
    plain = rows.withColumn("total", F.when(F.col("k").isNotNull(), F.sum("v").over(Window.partitionBy("k"))))
    assert collected(mine) == collected(plain)


BUCKETS = ["floor(o / 50)", "o", "1", None]


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("bucket", BUCKETS)
def test_running_total(rows, bucket, hot):
    mine = running_total(rows, "k", "o", "v", bucket and F.expr(bucket), **hot)
    plain = rows.withColumn("RunningTotal", F.sum("v").over(Window.partitionBy("k").orderBy("o")))
    assert collected(mine) == collected(plain)


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("bucket", BUCKETS)
def test_percent_rank(rows, bucket, hot):
    mine = percent_rank(rows, "k", "o", bucket and F.expr(bucket), **hot)
    plain = rows.withColumn("percent_rank", F.percent_rank().over(Window.partitionBy("k").orderBy("o")))
    assert collected(mine) == collected(plain)


@pytest.mark.parametrize("bytes_", [0, joins.BROADCAST_BYTES])
def test_windows_in_pieces(rows, monkeypatch, bytes_):
    """A long list of hot keys meets its rows by a shuffle; a bucket with many order
    values is cut by ranges."""
    monkeypatch.setattr(aggregates, "BROADCAST_BYTES", bytes_)
    monkeypatch.setattr(aggregates, "PIECE_ROWS", 200)
    whole = Window.partitionBy("k").orderBy("o")
    mine = running_total(rows, "k", "o", "v", F.lit(1), hot_rows=100)
    assert collected(mine) == collected(rows.withColumn("RunningTotal", F.sum("v").over(whole)))
    mine = percent_rank(rows, "k", "o", F.lit(1), hot_rows=100)
    assert collected(mine) == collected(rows.withColumn("percent_rank", F.percent_rank().over(whole)))


def test_no_piece_is_large(rows, monkeypatch):
    points = rows.groupBy("k", F.lit(1).alias("_bucket"), "o").agg(F.count(F.lit(1)).alias("n"))
    monkeypatch.setattr(aggregates, "PIECE_ROWS", 200)
    mine = aggregates._summed_to_here(points, "k", "o", "n")
    inside = F.sum("n").over(Window.partitionBy("k", "_bucket").orderBy("o"))
    assert collected(mine) == collected(points.withColumn("_inside", inside))


def test_hot_by_rows_whatever_the_share(rows):
    hot_part, plain_part = aggregates._split_hot_keys(rows, "k", aggregates.HOT_WINDOW_SHARE, 500)
    assert plain_part.groupBy("k").count().agg(F.max("count")).first()[0] <= 500
    assert hot_part.count() + plain_part.count() == rows.count()


def test_no_task_orders_a_hot_key(rows):
    limits = {"hot_share": 0.01, "hot_rows": 0}
    hot_part, plain_part = aggregates._split_hot_keys(rows, "k", **limits)
    assert plain_part.groupBy("k").count().agg(F.max("count")).first()[0] <= 50
    ordered, large = aggregates._over_buckets(
        hot_part, "k", "o", F.col("v"), F.floor(F.col("o") / 5), **limits
    )
    parts = ordered.groupBy("k", "_bucket").count().agg(F.max("count")).first()[0]
    assert parts <= 0.01 * hot_part.count() + 1
    # Rows without an order value are one bucket, and too many for that.
    assert not large.isEmpty()
    assert ordered.filter("_first = 1").count() + large.count() + plain_part.count() == rows.count()


def test_salted_aggregate(rows):
    mine = salted_sum_count(rows, "k", "v", ["id"], buckets=8)
    plain = rows.groupBy("k").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    assert collected(mine) == collected(plain)


def test_no_rows(spark, rows):
    none = rows.limit(0)
    assert running_total(none, "k", "o", "v", F.col("o")).isEmpty()
    assert percent_rank(none, "k", "o", F.col("o")).isEmpty()
    assert join_back_summary(none, ["k"], [F.sum("v").alias("s")]).isEmpty()
    assert joins.join_unique(none, none.select("k"), ["k"], "full", max_broadcast_rows=-1).isEmpty()
    assert joins.hot_keys(none, ["k"], 0.1).isEmpty()


def test_sketch_names_every_hot_key(spark, monkeypatch):
    """Shares around the limit, among very many keys, over several columns and NULL."""
    n = F.col("id")
    key = F.when(n % 10 == 0, None).when(n % 1000 < 40, n % 1000).otherwise(n)
    rows = spark.range(0, 200_000, 1, 12).select(key.alias("a"), F.when(n % 3 > 0, (n % 2).cast("string")).alias("b"))
    exact = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / 200_000)
    for share, least in [(0.0003, 0), (0.00033, 0), (0.05, 0), (0.0001, 70), (0.0, 66), (0.0, 300_000), (0.0, 1)]:
        mine = joins.hot_keys(rows, ["a", "b"], share, least)
        assert collected(mine) == collected(exact.filter((F.col("share") > share) & (F.col("n") > least))), (share, least)
    monkeypatch.setattr(joins, "MOST_NAMED", 3)  # a longer list is broadcast
    mine = joins.hot_keys(rows, ["a", "b"], 0.0003)
    assert mine.columns == ["a", "b", "n", "share"] and collected(mine) == collected(exact.filter("share > 0.0003"))


def test_hot_keys_shuffle_no_other_key(spark, capsys):
    rows = spark.range(0, 100_000, 1, 4).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("k"))
    names, total = joins.frequent_hashes(rows, ["k"], 0.01)
    assert len(names) == 1 and total == 100_000
    hot = joins.hot_keys(rows, ["k"], 0.01)
    hot.explain("formatted")
    text = capsys.readouterr().out
    # the rows are filtered by the candidate's hash below the first count
    assert text.index("xxhash64(") < text.index("partial_count") and str(names[0]) in text
    assert [(r.k, r.n) for r in hot.collect()] == [(-1, 25_000)]


@pytest.mark.parametrize("order", ["o", "cast(o as decimal(9,2))", "cast(o as double)", "cast(o as string)", "o % 2 = 0",
                                   "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, o)", "date_add(date'2025-01-01', o)"])
def test_windows_between_quantiles(rows, monkeypatch, order):
    monkeypatch.setattr(aggregates, "BUCKET_ROWS", 150)
    typed = rows.withColumn("o", F.expr(order.replace("o)", "cast(o as int))") if "date" in order or "time" in order else order))
    whole = Window.partitionBy("k").orderBy("o")
    mine = running_total(typed, "k", "o", "v", hot_rows=200)
    assert collected(mine) == collected(typed.withColumn("RunningTotal", F.sum("v").over(whole)))
    mine = percent_rank(typed, "k", "o", hot_rows=200)
    assert collected(mine) == collected(typed.withColumn("percent_rank", F.percent_rank().over(whole)))


def test_buckets_of_one_day_are_even(spark):
    """One hot key, all of one day: no bucket has twice the mean."""
    second = F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(pow(id / 1e5, 3) * 80000 as decimal(18,6)))")
    rows = spark.range(0, 100_000, 1, 6).select(F.lit("hot").alias("k"), second.alias("o"))
    rows = rows.union(rows.limit(300).withColumn("k", F.lit("other")))
    sizes = aggregates.quantile_bucket(rows, "k", "o", 1000).groupBy("k", "_bucket").count().collect()
    hot = [r["count"] for r in sizes if r.k == "hot"]
    assert 90 < len(hot) <= 101 and max(hot) < 2 * sum(hot) / len(hot)
    assert sum(r.k == "other" for r in sizes) == 1
    grown = aggregates.quantile_bucket(rows, "k", "o", 1000).groupBy("k", "_bucket").agg(F.min("o").alias("a"), F.max("o").alias("b"))
    ends = [x for r in grown.orderBy("k", "_bucket").collect() if r.k == "hot" for x in (r.a, r.b)]
    assert ends == sorted(ends)
