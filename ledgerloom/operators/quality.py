"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of every column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Returns ``df``; raises if it is empty. Reads no more than one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """What differs between the schema of ``df`` and ``expected``; no job is run."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    return [
        f"{name}: expected {want.get(name)}, found {have.get(name)}"
        for name in {**want, **have}
        if want.get(name) != have.get(name)
    ]


def dq_report(
    df: DataFrame, not_null: list[str] = (), ranges: dict[str, tuple] | None = None
) -> DataFrame:
    """One row per check: name and number of violations. All checks share one scan.

    ``ranges`` maps a column to its smallest and largest allowed value.
    """
    checks = {"non_empty": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)}
    for c in not_null:
        checks[f"not_null:{c}"] = F.count_if(F.col(c).isNull())
    for c, (low, high) in (ranges or {}).items():
        checks[f"range:{c}"] = F.count_if(~F.col(c).between(low, high))
    measured = df.agg(*[v.cast("bigint").alias(f"c{i}") for i, v in enumerate(checks.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations"))
            for i, name in enumerate(checks)
        ]
    )
    return measured.select(F.inline(rows))
