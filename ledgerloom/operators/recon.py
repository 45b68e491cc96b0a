"""Reconciliation of two ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import null_safe_difference
from ledgerloom.functions.types import DIFFERENCE, LEDGER_KEYS

# TYPE for no earlier entry, same difference, other difference.
LABELS = ("New Entry", "Unchanged", "Changed")
LABELS_V1 = ("New Entry", "Zero Difference", "Diff change")


def mismatches(cbs: DataFrame, gl: DataFrame) -> DataFrame:
    """Keys of both ledgers whose balances differ or where either is NULL.

    Both inputs have one row per key and one day's balances, so no key is hot.
    A key that only one ledger has is not reported.
    """
    both = cbs.select(*LEDGER_KEYS, F.col("BALANCE").alias("CBS_BALANCE")).join(
        gl.select(*LEDGER_KEYS, F.col("BALANCE").alias("GL_BALANCE")), LEDGER_KEYS
    )
    left, right = F.col("CBS_BALANCE"), F.col("GL_BALANCE")
    # Not NOT(a <=> b): a pair of two NULLs is reported as well.
    return both.filter((left != right) | left.isNull() | right.isNull()).withColumn(
        "DIFFERENCE_AMOUNT", null_safe_difference(left, right).cast(DIFFERENCE)
    )


def day_over_day(
    today: DataFrame, yesterday: DataFrame, labels: tuple[str, str, str] = LABELS
) -> DataFrame:
    """Adds DIFF_BW_YESTERDAY and TYPE; both inputs have one row per key."""
    new, same, other = labels
    before = yesterday.select(
        *LEDGER_KEYS, F.col("DIFFERENCE_AMOUNT").cast(DIFFERENCE).alias("_before")
    )
    change = null_safe_difference(F.col("DIFFERENCE_AMOUNT"), F.col("_before")).cast(DIFFERENCE)
    kind = (
        F.when(F.col("_before").isNull(), new)
        .when(F.col("DIFF_BW_YESTERDAY") == 0, same)
        .otherwise(other)
    )
    return (
        today.join(before, LEDGER_KEYS, "left")
        .withColumn("DIFF_BW_YESTERDAY", change)
        .withColumn("TYPE", kind)
        .drop("_before")
    )
