import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.accounts import head_by_case, head_by_rules, head_fallback, rule_trie
from ledgerloom.queries.ledger import RULES_SCHEMA

KEYS = "BRANCH_CODE string, CURRENCY string, CGL string"


@pytest.mark.parametrize(
    "branch, currency, cgl, head",
    [
        ("01999", "INR", "1204500001", "CAO"),
        ("00002", "INR", "1204500091", "PROVISION"),
        ("00002", "INR", "1204500001", "CASH"),
        ("00002", "INR", "6200123456", "AUCA"),
        ("00002", "INR", "6363123456", "CTA 6363"),
        ("00002", "INR", "4363000001", "CTA 4363"),
        ("00002", "INR", "4100000001", "CTA"),
        ("00002", "INR", "6100000001", "CTA"),
        ("00002", "INR", "7000000001", "I/E"),
        ("00002", "INR", "8000000001", "I/E"),
        ("00002", "INR", "5001234567", "MEMO"),
        ("00002", "USD", "5001234567", "FC MEMO"),
        ("00002", "INR", "2148000001", "BGL"),
        ("00002", "USD", "2148000001", "FC"),
        ("00002", "INR", "2249000001", "INCA"),
        ("00002", "INR", "2111", "PPF"),
        ("00002", "INR", "2111000001", None),
        ("03973", "INR", "1106505002", "LHO"),
        ("00002", "INR", "1106505002", "BCGA"),
        ("00002", "INR", "1000505003", "MIGRATION"),
        ("00002", "INR", "1100505001", "LHO"),
        ("00002", "INR", "1106505001", "LOAN"),
        ("00002", "USD", "1106505001", "FC"),
        (None, None, "1106505001", "FC"),
        ("00002", "INR", None, None),
    ],
)
def test_ordered_rules(spark, branch, currency, cgl, head):
    row = spark.createDataFrame([(branch, currency, cgl)], KEYS)
    assert row.select(head_by_case()).first()[0] == head


def test_options(spark):
    rows = spark.createDataFrame([("1", "INR", "2111000001"), ("1", "USD", "2028070603")], KEYS)
    prefix = [r[0] for r in rows.select(head_by_case(ppf_as_prefix=True)).collect()]
    default = [r[0] for r in rows.select(head_by_case(with_default=True)).collect()]
    assert prefix == ["PPF", None]
    assert default == ["DEPOSITS", "FC"]
    assert [r[0] for r in rows.select(head_fallback()).collect()] == ["OTHER", "OTHER"]


def test_broadcast_and_join_agree(spark):
    pick = random.Random(7)
    maybe = lambda values: pick.choice([None, *values])
    prefixes = ["", "1", "12", "123", "5", "50", "5001234567", "99999999999"]
    rules = [
        (maybe(range(20)), maybe(["A", "B", "*"]), maybe(prefixes), maybe(["INR", "USD"]), maybe([f"H{i}"]))
        for i in range(40)
    ]
    keys = list(
        itertools.product(["A", "B", "C", "*", None], ["INR", "EUR", None], ["123", "5001234567", "7", "", None])
    )
    rows = spark.createDataFrame(keys * 3, KEYS)
    # Without the catch-all rules, so that some keys match nothing.
    table = spark.createDataFrame([r for r in rules if any(r[1:4])], RULES_SCHEMA)
    by_broadcast = sorted(map(str, head_by_rules(rows, table).collect()))
    by_join = sorted(map(str, head_by_rules(rows, table, max_broadcast_rows=0).collect()))
    assert by_broadcast == by_join
    assert len(by_broadcast) == len(keys) * 3

    def expected(branch, currency, cgl):
        fits = [
            (p, h)
            for p, b, g, c, h in rules
            if any((b, g, c))
            and (b is None or b == branch)
            and (c is None or c == currency)
            and (g is None or (cgl is not None and cgl.startswith(g)))
        ]
        order = lambda fit: [(x is not None, str(x).zfill(3)) for x in fit]
        return min(fits, key=order, default=(0, None))[1] or "UNCLASSIFIED"

    heads = {(r.BRANCH_CODE, r.CURRENCY, r.CGL): r.HEAD for r in head_by_rules(rows, table).collect()}
    assert heads == {k: expected(*k) for k in keys}


def test_rule_table_gives_the_ordered_rules(spark):
    # The ordered rules that a table can express.
    rules = [
        (1, "01999", None, None, "CAO"), (2, None, "1204", None, "CASH"), (3, None, "62", None, "AUCA"),
        (4, None, "6363", None, "CTA 6363"), (5, None, "4363", None, "CTA 4363"), (6, None, "4", None, "CTA"),
        (7, None, "6", None, "CTA"), (8, None, "7", None, "I/E"), (9, None, "8", None, "I/E"),
        (10, None, "5", "INR", "MEMO"), (11, None, "5", None, "FC MEMO"), (12, None, "2148", "INR", "BGL"),
        (13, None, "2148", None, "FC"), (14, None, "2249", None, "INCA"),
        (15, None, "1000505003", None, "MIGRATION"), (16, None, "1100505001", None, "LHO"),
    ]
    table = spark.createDataFrame(rules, RULES_SCHEMA)
    codes = ["1204500001", "6200123456", "6363123456", "4363000001", "4100000001", "6100000001",
             "7000000001", "8000000001", "5001234567", "2148000001", "2249000001", "1000505003",
             "1100505001", "2028070603"]
    rows = spark.createDataFrame(list(itertools.product(["01999", "00002"], ["INR", "USD"], codes)), KEYS)
    both = head_by_rules(rows, table).withColumn("case", F.coalesce(head_by_case(), F.lit("UNCLASSIFIED")))
    assert both.filter(F.col("HEAD") != F.col("case")).isEmpty()


@pytest.mark.parametrize("n", [1, 2, 200, 1201])
def test_many_rules(spark, n):
    # One prefix per rule, and a last rule that takes the rest.
    rules = [(i, None, f"{i:04d}", None, f"H{i}") for i in range(n - 1)] + [(n, "B", None, None, "REST")]
    rows = spark.range(n + 50).select(
        F.lit("B").alias("BRANCH_CODE"),
        F.lit("INR").alias("CURRENCY"),
        F.format_string("%04d77", "id").alias("CGL"),
        "id",
    )
    result = head_by_rules(rows, spark.createDataFrame(rules, RULES_SCHEMA))
    assert {r.id: r.HEAD for r in result.collect()} == {
        i: f"H{i}" if i < n - 1 else "REST" for i in range(n + 50)
    }


def test_trie_of_the_rules(spark):
    rules = [(5, None, "12", None, "A"), (3, None, "1204", None, "B"), (9, None, "1204", None, "C"), (7, None, None, None, "D"),
             (1, None, "13", None, "E"), (2, "X", "", "INR", "F")]
    tries = {(r._branch, r._currency): r.nodes for r in rule_trie(spark.createDataFrame(rules, RULES_SCHEMA)).collect()}
    assert set(tries) == {("", ""), ("=X", "=INR")}
    nodes = {n.prefix: [(s.length, s.rule.head_category) for s in n.path] for n in tries["", ""]}
    assert list(nodes) == ["", "=12", "=1204", "=13"]  # in order, for the search
    assert nodes["=1204"] == [(0, "D"), (3, "A"), (5, "B")] and nodes["=13"] == [(0, "D"), (3, "E")]
    codes = ["1204", "12", "1205", "1203", "13", "14", "", "9", None, "12é"]
    rows = spark.createDataFrame([(b, c, g) for b in ("X", "Y", None) for c in ("INR", None) for g in codes], KEYS)
    heads = {(r.BRANCH_CODE, r.CURRENCY, r.CGL): r.HEAD for r in head_by_rules(rows, spark.createDataFrame(rules, RULES_SCHEMA)).collect()}
    want = ["B", "A", "A", "A", "E", "D", "D", "D", "D", "A"]
    assert [heads["Y", "INR", g] for g in codes] == want and [heads["X", None, g] for g in codes] == want
    assert [heads["X", "INR", g] for g in codes] == ["F", "F", "F", "F", "E", "F", "F", "F", "D", "F"]
    none = head_by_rules(rows, spark.createDataFrame([], RULES_SCHEMA))
    assert none.filter("HEAD <> 'UNCLASSIFIED'").isEmpty() and none.count() == rows.count()
