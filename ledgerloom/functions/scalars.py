"""Small expressions shared by jobs and queries."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Value of ``key`` in a literal map; NULL where it is missing."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def on_day(moment: Column, day: str) -> Column:
    """True on calendar day ``day``.

    Written as a half-open range on the bare column, so it reaches the Parquet
    scan as a pushed filter; casting the column would not.
    """
    start = F.lit(day).cast("date")
    return (moment >= start) & (moment < F.date_add(start, 1))


def days_before(day: Column, days: int) -> Column:
    return F.date_sub(day, days)


def salt(columns: list[str], buckets: int) -> Column:
    """A bucket number that is the same on every run, unlike ``rand``: a task
    that is run again after a loss sends each row to the same place."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def grade(score: Column) -> Column:
    return (
        F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").otherwise("F")
    )


@F.pandas_udf(T.StringType())
def grade_udf(score: pd.Series) -> pd.Series:
    """`grade` as an Arrow-batched Python function, for the UDF surface."""
    return pd.Series(np.select([score >= 90, score >= 80, score >= 70], list("ABC"), "F"))
