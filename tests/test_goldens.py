from decimal import Decimal as D

import golden_data as golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.amounts import overpunch_amount, overpunch_field
from ledgerloom.functions.scalars import grade, grade_udf
from ledgerloom.operators.accounts import validate_accounts
from ledgerloom.operators.aggregates import running_total
from ledgerloom.operators.balance import (
    balanced_totals,
    balancing_rows,
    net_check,
    roll_forward,
    validated_totals,
    with_balancing_rows,
)
from ledgerloom.operators.joins import join_unique


def codes(spark, values):
    return spark.createDataFrame([(v,) for v in values], "CGL string")


def totals(df):
    return {
        r.VALIDATED_CGL: (r.TOTAL_DEBIT, r.TOTAL_CREDIT, r.TOTAL_TRANSACTIONS) for r in df.collect()
    }


def money(*texts):
    return tuple(D(t) if isinstance(t, str) else t for t in texts)


def test_totals_of_ten_rows(spark):
    rows = spark.createDataFrame(golden.TEN, golden.SCHEMA)
    result = validated_totals(rows, codes(spark, golden.TEN_CODES))
    assert totals(result) == {k: money(*v) for k, v in golden.TEN_TOTALS.items()}
    assert result.count() == 7


def test_describe_of_ten_rows(spark):
    rows = spark.createDataFrame(golden.TEN, golden.SCHEMA)
    described = {
        r[0]: r[1:] for r in validated_totals(rows, codes(spark, golden.TEN_CODES)).describe().collect()
    }
    for name, want in golden.TEN_DESCRIBED.items():
        assert [float(x) for x in described[name]] == pytest.approx(want, rel=1e-9)
    assert described["count"] == ("7",) * 4
    assert [float(x) for x in described["min"][1:]] == [998.00, -2880674.01, 17]
    assert [float(x) for x in described["max"][1:]] == [4733931.96, -1200.45, 2919]


def test_balancing_of_twenty_rows(spark):
    rows = spark.createDataFrame(golden.TWENTY, golden.SCHEMA)
    result = validated_totals(rows, codes(spark, golden.TWENTY_CODES))
    assert totals(result) == {k: money(*v[:3]) for k, v in golden.TWENTY_RESULT.items()}
    extra = balancing_rows(result)
    assert totals(extra) == {k: money(*v[3:], 0) for k, v in golden.TWENTY_RESULT.items()}
    assert sorted(with_balancing_rows(result).collect()) == sorted(
        result.unionByName(extra).collect()
    )
    check = net_check(balanced_totals(result)).first()
    assert (check.n_groups, check.n_imbalanced, check.net_total) == (8, 0, D("0.000"))


def test_three_accounts_balance(spark):
    # Nets of +400, -500 and exactly 0, as worked through by hand.
    rows = spark.createDataFrame(
        [("A", 1000, -600, 3), ("B", 200, -700, 2), ("C", 50, -50, 1)],
        "VALIDATED_CGL string, TOTAL_DEBIT int, TOTAL_CREDIT int, TOTAL_TRANSACTIONS int",
    ).select(
        "VALIDATED_CGL",
        F.col("TOTAL_DEBIT").cast("decimal(38,3)"),
        F.col("TOTAL_CREDIT").cast("decimal(38,3)"),
        F.col("TOTAL_TRANSACTIONS").cast("bigint"),
    )
    assert totals(balancing_rows(rows)) == {"A": (0, -400, 0), "B": (500, 0, 0)}
    assert with_balancing_rows(rows).count() == 5
    assert totals(balanced_totals(rows)) == {"A": (1000, -1000, 3), "B": (700, -700, 2), "C": (50, -50, 1)}


def test_validation_examples(spark):
    rows = codes(spark, ["1000000", "9999999", "5000123", None, "", "5"])
    checked = validate_accounts(rows, codes(spark, ["1000000", "1000000"]), "VALID")
    assert {r.CGL: r.VALID for r in checked.collect()} == {
        "1000000": "1000000",
        "9999999": "1111111111",
        "5000123": "5000000000",
        None: "1111111111",
        "": "1111111111",
        "5": "5000000000",
    }


def test_roll_forward_example(spark):
    def balances(values):
        rows = [("B", "INR", k, D(v)) for k, v in values.items()]
        return spark.createDataFrame(
            rows, "BRANCH_CODE string, CURRENCY string, CGL string, BALANCE decimal(38,3)"
        )

    previous = balances({"1000000": 500000, "1000002": 100000})
    delta = balances({"1000000": 75000, "1000001": 50000})
    closing = {r.CGL: int(r.BALANCE) for r in roll_forward(previous, delta, "2025-11-25").collect()}
    assert closing == {"1000000": 575000, "1000001": 50000, "1000002": 100000}
    assert roll_forward(None, delta, "2025-11-25").count() == 2


@pytest.mark.parametrize(
    "field, amount",
    [
        ("0000000000050000p", "-500.000"),
        ("0000000000000001q", "-0.011"),
        ("00000000000000128", "0.128"),
        ("00000000000000129", "0.129"),
        ("9999999999999999y", "-99999999999999.999"),
        ("0000000000000000p", "0.000"),
    ],
)
def test_sign_characters(spark, field, amount):
    row = spark.createDataFrame([(field,)], "f string").select(overpunch_amount(F.col("f"))).first()
    assert row[0] == D(amount)


def test_decode_inverts_encode(spark):
    rows = spark.range(-5000, 5000).select((F.col("id") * F.col("id") * F.col("id") * 7919).alias("m"))
    bad = rows.filter(
        (overpunch_amount(overpunch_field(F.col("m"))) * 1000).cast("bigint") != F.col("m")
    )
    assert bad.isEmpty()


def test_running_total_example(spark):
    rows = spark.createDataFrame(
        [("A", 1, 100), ("A", 2, 200), ("A", 2, 50), ("B", 1, 10)], "k string, o int, v bigint"
    )
    result = running_total(rows, "k", "o", "v", bucket=F.col("o"))
    # Rows that tie share one total.
    assert sorted((r.k, r.o, r.v, r.RunningTotal) for r in result.collect()) == [
        ("A", 1, 100, 100), ("A", 2, 50, 350), ("A", 2, 200, 350), ("B", 1, 10, 10),
    ]


def test_joins_example(spark):
    employees = spark.createDataFrame([(1, "X", 10), (2, "Y", 20), (3, "Z", 99)], "e int, n string, d int")
    departments = spark.createDataFrame([(10, "IT"), (20, "HR"), (30, "Ops")], "d int, dn string")

    def joined(how):
        rows = join_unique(employees, departments, ["d"], how).collect()
        return {(r.n, r.dn) for r in rows}

    both = {("X", "IT"), ("Y", "HR")}
    assert joined("inner") == both
    assert joined("left") == both | {("Z", None)}
    assert joined("right") == both | {(None, "Ops")}
    assert joined("full") == both | {("Z", None), (None, "Ops")}


def test_grades(spark):
    rows = spark.createDataFrame([(95.0,), (90.0,), (85.0,), (72.0,), (69.9,), (None,)], "s double")
    result = rows.select(grade(F.col("s")), grade_udf(F.col("s"))).collect()
    assert [r[0] for r in result] == ["A", "A", "B", "C", "F", "F"]
    assert all(r[0] == r[1] for r in result)


def test_inferred_types(spark):
    frame = spark.createDataFrame([("a", 1)], ["name", "n"])
    assert frame.schema["n"].dataType == T.LongType()
