"""Raw fields of the input files as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.fixedwidth import slice_fields
from ledgerloom.sources.files import write_parquet
from ledgerloom.sources.layouts import EXPORT_FULL, EXPORT_SHORT
from ledgerloom.sources.published import write_day


def run_full_export(lines: DataFrame, path: str, max_records: int | None = None) -> None:
    """All 13 fields; replaces the dataset."""
    write_parquet(lines.select(*slice_fields(EXPORT_FULL)), path, max_records)


def run_daily_export(lines: DataFrame, path: str, day: str, append: bool = False) -> int:
    """Seven fields by export_date. Replaces the day unless ``append``."""
    rows = lines.select(*slice_fields(EXPORT_SHORT), F.lit(day).cast("date").alias("export_date"))
    return write_day(rows, path, "export_date", day, append)
