from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.accounts import active_accounts, validate_accounts
from ledgerloom.operators.balance import (
    aggregate_by_id,
    balance_delta,
    balance_history,
    balance_per_row,
    decode_feed,
    decode_lines,
    imbalanced,
    rejected_lines,
    roll_forward,
    to_gl_transactions,
)
from ledgerloom.operators.quality import dq_report, null_counts, require_rows, schema_differences
from ledgerloom.operators.recon import day_over_day, mismatches
from ledgerloom.functions.fixedwidth import Field
from ledgerloom.sources.layouts import FEEDS, GlLayout, family_patterns
from ledgerloom.functions.types import GL_TRANSACTION_COLUMNS
from ledgerloom.sources.files import read_lines

KEY = "00001INR1000000000"


def line(currency="INR", key=KEY, local="0" * 17, foreign="0" * 17):
    return " " * 47 + currency + key + " " * 47 + local + foreign


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_bad_lines_count_but_add_nothing(spark):
    data = lines(
        spark,
        line(local="0000000000001000q"),  # -10.001
        line(local="00000000000020005"),  # 20.005
        line(local="0000000000009000}"),  # bad sign
        line(local="0000000000009000 "),  # blank sign
        line(local=" " * 17),
        line(local="00000000x00090005"),
        "short line",
        "",
    )
    by_id = {r.Id: r for r in aggregate_by_id(decode_lines(data)).collect()}
    good = by_id[KEY]
    assert (good.DEBIT_AMOUNT, good.CREDIT_AMOUNT) == (D("20.005"), D("-10.001"))
    assert good.TRANSACTION_COUNT == 6
    assert by_id[""].TRANSACTION_COUNT == 2
    assert by_id[""].DEBIT_AMOUNT == 0
    assert rejected_lines(data).count() == 6


def test_blank_currency_uses_foreign_slot(spark):
    data = lines(spark, line(currency="   ", local="0" * 16 + "1", foreign="0" * 15 + "25"))
    assert decode_lines(data).first().Amount == D("0.025")


def test_leading_blanks_of_an_amount(spark):
    assert decode_lines(lines(spark, line(local=" " * 12 + "1234q"))).first().Amount == D("-12.341")


def test_empty_id_becomes_the_fallback_account(spark):
    mapped = to_gl_transactions(aggregate_by_id(decode_lines(lines(spark, "x"))), "1", "2025-01-01")
    assert mapped.columns == GL_TRANSACTION_COLUMNS
    accounts = spark.createDataFrame([("1000000000",)], "CGL string")
    row = validate_accounts(mapped, accounts).first()
    assert (row.CGL, row.BRANCH_CODE, row.JOURNAL_ID) == ("1111111111", "", None)


def feed_line(name, amount, sign, key=KEY):
    if name == "GLCC":
        return key + " " * 5 + amount + sign
    start, id_start = {"INV": (30, 200), "BOR": (27, 105)}[name]
    head = " " * (start - 1) + amount.rjust(17) + sign
    return head.ljust(id_start - 1) + key


@pytest.mark.parametrize("name, scale", [("INV", 1000), ("BOR", 1000), ("GLCC", 10000)])
def test_trailing_sign(spark, name, scale):
    data = lines(
        spark,
        feed_line(name, "12345", "+"),
        feed_line(name, "12345", "-"),
        feed_line(name, "12345", "?"),
        feed_line(name, "12x45", "+"),
    )
    amounts = [r.Amount for r in decode_feed(data, FEEDS[name]).collect()]
    assert amounts == [D(12345) / scale, -D(12345) / scale, 0, None]
    assert {r.Id for r in decode_feed(data, FEEDS[name]).collect()} == {KEY}


def test_shortest_glcc_line(spark):
    # 24 characters: the amount is empty.
    data = lines(spark, KEY + " " * 5 + "+", "abc", "")
    assert [r.Amount for r in decode_feed(data, FEEDS["GLCC"]).collect()] == [None, 0, 0]


def test_null_amounts(spark):
    rows = spark.createDataFrame(
        [("B", "INR", "1", D("1.5"), None), ("B", "INR", "1", D("2"), D("-1")), ("B", "INR", "2", None, None)],
        "BRANCH_CODE string, CURRENCY string, CGL string, DEBIT_AMOUNT decimal(22,3), "
        "CREDIT_AMOUNT decimal(22,3)",
    )
    assert {r.CGL: r.BALANCE for r in balance_delta(rows).collect()} == {"1": D("2.5"), "2": 0}
    assert sorted(str(r.BALANCE) for r in balance_per_row(rows).collect()) == ["1.000", "None", "None"]
    nets = rows.groupBy("CGL").agg(
        F.sum("DEBIT_AMOUNT").alias("TOTAL_DEBIT"), F.sum("CREDIT_AMOUNT").alias("TOTAL_CREDIT")
    )
    assert [r.CGL for r in imbalanced(nets).collect()] == ["1"]


def test_master_with_duplicates_and_inactive_accounts(spark):
    master = spark.createDataFrame(
        [("1", 1), ("1", 1), ("2", 0), (None, 1)], "CGL_NUMBER string, BAL_COMPARE int"
    )
    rows = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "CGL string")
    for options in ({}, {"max_broadcast_rows": 0}):
        checked = validate_accounts(rows, active_accounts(master), **options)
        assert sorted(r.CGL for r in checked.collect()) == ["1", "1", "1111111111", "1111111111"]
        none = validate_accounts(rows, active_accounts(master.limit(0)), **options)
        assert {r.CGL for r in none.collect()} == {"1111111111"}
        assert none.count() == 4


BALANCE = "BRANCH_CODE string, CURRENCY string, CGL string, BALANCE decimal(38,3)"


def balances(spark, values):
    return spark.createDataFrame([("B", "INR", k, v and D(v)) for k, v in values.items()], BALANCE)


def test_mismatches_with_nulls(spark):
    cbs = balances(spark, {"same": "1", "more": "2", "left": None, "right": "5", "both": None, "only": "1"})
    gl = balances(spark, {"same": "1", "more": "1.5", "left": "3", "right": None, "both": None, "other": "1"})
    found = {r.CGL: r.DIFFERENCE_AMOUNT for r in mismatches(cbs, gl).collect()}
    assert found == {"more": D("0.5"), "left": -3, "right": 5, "both": 0}


def test_day_over_day(spark):
    schema = "BRANCH_CODE string, CURRENCY string, CGL string, DIFFERENCE_AMOUNT decimal(20,4)"
    rows = lambda v: spark.createDataFrame([("B", "INR", k, x and D(x)) for k, x in v.items()], schema)
    today = rows({"new": "5", "same": "7", "up": "9", "was_null": "1"})
    yesterday = rows({"same": "7", "up": "4", "gone": "1", "was_null": None})
    found = {r.CGL: (r.DIFF_BW_YESTERDAY, r.TYPE) for r in day_over_day(today, yesterday).collect()}
    assert found == {
        "new": (5, "New Entry"), "same": (0, "Unchanged"), "up": (5, "Changed"), "was_null": (1, "New Entry"),
    }


def test_history_is_repeated_roll_forward(spark):
    days = ["2025-01-01", "2025-01-02", "2025-01-03"]
    deltas = {days[0]: {"a": "1", "b": "2"}, days[1]: {"a": "10"}, days[2]: {"a": "-4", "c": "3"}}
    frames = [balances(spark, d).withColumn("BALANCE_DATE", F.lit(day).cast("date")) for day, d in deltas.items()]
    union = frames[0].unionByName(frames[1]).unionByName(frames[2])
    history = {(r.CGL, str(r.BALANCE_DATE)): r.BALANCE for r in balance_history(union).collect()}
    closing = None
    for day, frame in zip(days, frames):
        closing = roll_forward(closing, frame, day)
        for r in closing.collect():
            if (r.CGL, day) in history:
                assert history[r.CGL, day] == r.BALANCE
    assert len(history) == 5


def test_quality(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (99, None)], "n int, s string")
    assert tuple(null_counts(rows).first()) == (1, 1)
    report = {r.check_name: r.violations for r in dq_report(rows, ["n"], {"n": (0, 10)}).collect()}
    assert report == {"non_empty": 0, "not_null:n": 1, "range:n": 1}
    empty = rows.limit(0)
    assert {r.violations for r in dq_report(empty).collect()} == {1}
    with pytest.raises(ValueError, match="no rows"):
        require_rows(empty, "rows")
    want = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.StringType())])
    assert schema_differences(rows, want) == [
        "n: expected bigint, found int", "x: expected string, found None", "s: expected None, found string",
    ]
    assert schema_differences(rows, rows.schema) == []


def test_globs_read_only_the_families(spark, tmp_path):
    for name in ["AGLIFINV_001.gz", "BGLIFINV_BC.gz", "AGLIFINV_1.gz", "AGLIFOTHER.gz", "AGLIFINV_BC.txt"]:
        lines(spark, name).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / name))
    numbered, single = f"{tmp_path}/*GLIFINV_[0-9][0-9][0-9].gz", f"{tmp_path}/*GLIFINV_BC.gz"
    patterns = family_patterns(str(tmp_path))
    assert len(patterns) == 21 and numbered in patterns and single in patterns
    found = read_lines(spark, [numbered, single])
    assert sorted(r.value for r in found.collect()) == ["AGLIFINV_001.gz", "BGLIFINV_BC.gz"]


def test_other_amount_layouts(spark):
    layout = GlLayout(
        currency=Field("currency_code", 1, 3),
        key=Field("Id", 4, 18),
        local_amount=Field("lcyAmt", 22, 9),
        foreign_amount=Field("fcyAmt", 32, 9),
        foreign_sign=Field("sign", 42, 1),
        decimals=2,
    )
    key = "00001INR1204500001"
    data = lines(
        spark,
        "INR" + key + "00001234q" + " " + "000099999" + " " + "9",  # -123.41
        "USD" + key + "000000000" + " " + "00000100x" + " " + "5",  # 10.05, the sign stands apart
        "USD" + key + "000000000" + " " + "000001009" + " " + "w",  # -10.07
        "INR" + key + "0000123.q" + " " + "000099999" + " " + "9",  # a decimal point: rejected
    )
    amounts = [r.Amount for r in decode_lines(data, layout).collect()]
    assert amounts == [D("-123.410"), D("10.050"), D("-10.070"), None]
    assert rejected_lines(data, layout).count() == 1
    with pytest.raises(ValueError, match="same length"):
        GlLayout(local_amount=Field("lcyAmt", 116, 16))
    with pytest.raises(ValueError, match="decimal places"):
        GlLayout(decimals=4)
