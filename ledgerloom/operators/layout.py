"""Spreading rows over tasks and files before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import salt


def spread_by_key(
    df: DataFrame, partitions: int, key: str, salt_by: list[str], ways: int = 1
) -> DataFrame:
    """``partitions`` partitions by ``key``, each key in up to ``ways`` of them, so
    that a hot key is not one writer's work."""
    if ways == 1:
        return df.repartition(partitions, key)
    return df.repartition(partitions, F.col(key), salt(salt_by, ways))


def at_most(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer writers without a shuffle; a database takes only so many connections."""
    return df.coalesce(partitions)
