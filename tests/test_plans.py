"""What the plans must and must not contain, whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import on_day
from ledgerloom.operators.accounts import head_by_rules
from ledgerloom.operators.aggregates import join_back_summary
from ledgerloom.operators.balance import aggregate_by_id, balance_delta, decode_lines, roll_forward
from ledgerloom.operators.joins import lookup_join
from ledgerloom.queries.ledger import RULES, RULES_SCHEMA
from ledgerloom.queries.tables import Tables
from ledgerloom.sources.files import write_partitions


@pytest.fixture
def plan(capsys):
    def text(df):
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture
def t(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def operators(text, name):
    """How often an operator occurs in the plan tree."""
    tree = text.split("\n\n")[0]
    return sum(f" {name} (" in line for line in tree.splitlines())


def test_day_filter_reaches_the_scan(t, plan):
    text = plan(t.events.filter(on_day(F.col("ts"), "2024-01-03")).select("event_id"))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_lines_are_summed_before_the_shuffle(spark, tmp_path, plan):
    (tmp_path / "a.txt").write_text("x")
    text = plan(aggregate_by_id(decode_lines(spark.read.text(str(tmp_path)))))
    assert operators(text, "Exchange") == 1
    assert "partial_sum(DEBIT_AMOUNT" in text
    assert "Python" not in text


def test_rules_need_no_shuffle(spark, t, plan):
    keys = t.postings().select("BRANCH_CODE", "CURRENCY", "CGL")
    text = plan(head_by_rules(keys, spark.createDataFrame(RULES, RULES_SCHEMA)))
    assert operators(text, "Exchange") == 0 and "NestedLoop" not in text and "Python" not in text


def test_large_rule_table_has_equi_joins(spark, t, plan):
    keys = t.postings().select("BRANCH_CODE", "CURRENCY", "CGL")
    rules = spark.createDataFrame(RULES, RULES_SCHEMA)
    assert "NestedLoop" not in plan(head_by_rules(keys, rules, max_broadcast_rows=0))


def test_join_back_has_no_window(t, plan):
    text = plan(join_back_summary(t.postings(), ["CGL"], [F.sum("MILLI").alias("s")]))
    assert "Window" not in text


def test_large_lookup_broadcasts_only_hot_keys(spark, plan):
    fact = spark.range(100_000).select((F.col("id") % 1000).alias("k"))
    lookup = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup_join(fact, lookup, ["k"], max_broadcast_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert operators(text, "SortMergeJoin LeftOuter") == 1
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_roll_forward_adds_no_shuffle(t, plan):
    day = balance_delta(t.transactions())
    previous = roll_forward(None, balance_delta(t.transactions()), "2025-01-01")
    text = plan(roll_forward(previous, day, "2025-01-02"))
    # One for each side's sum; the union keeps their partitioning.
    assert operators(text, "Exchange") == 2


def test_partition_writes_rebalance(spark, t, tmp_path):
    write_partitions(t.postings().select("CURRENCY", "MILLI"), str(tmp_path / "p"), ["CURRENCY"])
    table = spark.read.parquet(str(tmp_path / "p"))
    assert table.count() == t.lineitem.count()
    assert {p.name for p in (tmp_path / "p").iterdir() if p.is_dir()} == {
        "CURRENCY=INR", "CURRENCY=USD", "CURRENCY=EUR",
    }
    assert len(list((tmp_path / "p").rglob("*.parquet"))) == 3
