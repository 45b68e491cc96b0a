"""The daily ledger job: lines to transactions to closing balances."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.accounts import active_accounts, validate_accounts
from ledgerloom.operators.balance import (
    aggregate_by_id,
    balance_delta,
    closing_balances,
    decode_lines,
    roll_forward,
    to_gl_transactions,
    totals_and_rejects,
    totals_by_id,
)
from ledgerloom.plans.feeds import ledger_buckets, previous_balances
from ledgerloom.sources.files import read_dealt_lines, write_parquet
from ledgerloom.sources.layouts import GlLayout, dated_path, family_patterns
from ledgerloom.sources.published import published_days, read_day, read_days, write_day, write_days
from ledgerloom.sources.workdir import new_folder


def day_lines(spark: SparkSession, base: str, day: str, folder: str = "ledger") -> DataFrame:
    """Lines of all file families below ``base/day/folder``; the lines of large compressed files
    are dealt over several tasks."""
    return read_dealt_lines(spark, family_patterns(dated_path(base, day, folder, "")))


class GlDay(NamedTuple):
    transactions: DataFrame
    balances: DataFrame


def transactions_of(
    lines: DataFrame, master: DataFrame, day: str, batch_id: str, layout: GlLayout = GlLayout()
) -> DataFrame:
    """The day's validated transactions, one row per Id.

    The only shuffle is the sum by Id, combined on the map side; the account check
    comes after it and sees one row per Id.
    """
    totals = aggregate_by_id(decode_lines(lines, layout))
    rows = to_gl_transactions(totals, batch_id, day, layout.key_fields)
    return validate_accounts(rows, active_accounts(master))


def gl_day_frames(
    lines: DataFrame,
    master: DataFrame,
    previous: DataFrame | None,
    day: str,
    batch_id: str,
    layout: GlLayout = GlLayout(),
) -> GlDay:
    transactions = transactions_of(lines, master, day, batch_id, layout)
    return GlDay(transactions, roll_forward(previous, balance_delta(transactions), day))


class GlTables(NamedTuple):
    """Paths of the tables, published by POST_DAY, BALANCE_DATE and POST_DAY. Rejected
    lines are kept only where there is a path for them."""

    transactions: str
    balances: str
    rejects: str | None = None


def read_totals(
    spark: SparkSession, lines: DataFrame, layout: GlLayout, most_rejects: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Totals by Id, and rejected lines with how often each was there.

    One scan of the text gives both, and the number of rejects: an amount that cannot be
    decoded adds nothing to its Id, and the line becomes part of the key. With more than
    ``most_rejects`` it is an error.
    """
    rejected = F.col("REJECTED").isNotNull()
    counted = Observation()
    parts = totals_and_rejects(lines, layout).observe(
        counted, F.sum(F.when(rejected, F.col("TRANSACTION_COUNT"))).alias("rejects")
    )
    folder = new_folder(spark, "gl-totals")
    write_parquet(parts, folder)
    rejects = counted.get["rejects"] or 0
    if most_rejects is not None and rejects > most_rejects:
        raise ValueError(f"{rejects} lines rejected, at most {most_rejects} are allowed")
    parts = spark.read.schema(parts.schema).parquet(folder)
    # without rejects there is one row per Id already
    totals = totals_by_id(parts) if rejects else parts.drop("REJECTED")
    return totals, parts.filter(rejected).select("Id", F.col("REJECTED").alias("value"), F.col("TRANSACTION_COUNT").alias("LINES"))


def _publish_transactions(
    spark: SparkSession,
    lines: DataFrame,
    master: DataFrame,
    tables: GlTables,
    day: str,
    batch_id: str,
    layout: GlLayout,
    most_rejects: int | None,
) -> None:
    post_day = F.lit(day).cast("date")
    if tables.rejects is None and most_rejects is None:
        transactions = transactions_of(lines, master, day, batch_id, layout)
    else:
        totals, rejects = read_totals(spark, lines, layout, most_rejects)
        rows = to_gl_transactions(totals, batch_id, day, layout.key_fields)
        transactions = validate_accounts(rows, active_accounts(master))
        if tables.rejects is not None:
            write_day(rejects.withColumn("POST_DAY", post_day), tables.rejects, "POST_DAY", day)
    write_day(transactions.withColumn("POST_DAY", post_day), tables.transactions, "POST_DAY", day)


def run_gl_day(
    spark: SparkSession,
    lines: DataFrame,
    master: DataFrame,
    tables: GlTables,
    day: str,
    batch_id: str,
    previous_day: str | None,
    layout: GlLayout = GlLayout(),
    most_rejects: int | None = None,
    buckets: int | None = None,
) -> None:
    """Publishes the day's transactions, rejected lines and closing balances.

    The text is scanned once: balances are computed from the written transactions,
    so nothing is cached that a lost executor would take along. The day is replaced in
    all tables, so it can be run again. ``previous_day=None`` states that
    there is no earlier balance; a stated day without balances is an error, and so are
    more than ``most_rejects`` rejected lines, both raised before anything is published.
    Balances can be written in ``buckets`` by the ledger keys, for the reconciliation.
    """
    previous = previous_balances(spark, tables.balances, previous_day)
    _publish_transactions(spark, lines, master, tables, day, batch_id, layout, most_rejects)
    posted = read_day(spark, tables.transactions, "POST_DAY", day)
    closing = roll_forward(previous, balance_delta(posted), day)
    write_day(closing, tables.balances, "BALANCE_DATE", day, buckets=ledger_buckets(buckets))


def restate_gl_day(
    spark: SparkSession,
    lines: DataFrame,
    master: DataFrame,
    tables: GlTables,
    day: str,
    batch_id: str,
    layout: GlLayout = GlLayout(),
    most_rejects: int | None = None,
) -> list[str]:
    """Runs a published day again from corrected lines and carries the change into its
    closing balances and those of every later day. Returns these days.

    Only the corrected day's text is read. All balances come in one pass from those
    before it and the posted transactions since, and are published together, so that a
    run that ends in between can just be repeated.
    """
    days = list(published_days(spark, tables.balances))
    if day not in days:
        raise ValueError(f"no balances for {day}")
    later, before = [d for d in days if d >= day], [d for d in days if d < day]
    _publish_transactions(spark, lines, master, tables, day, batch_id, layout, most_rejects)
    posted = read_days(spark, tables.transactions, "POST_DAY", later)
    rows = posted.withColumnRenamed("POST_DAY", "BALANCE_DATE")
    deltas = balance_delta(rows, "BALANCE_DATE")
    previous = previous_balances(spark, tables.balances, before[-1]) if before else None
    write_days(closing_balances(previous, deltas, later), tables.balances, "BALANCE_DATE", later)
    return later


def run_backfill(
    spark: SparkSession,
    lines_of: Callable[[str], DataFrame],
    master: DataFrame,
    tables: GlTables,
    days: Iterable[str],
    previous_day: str | None = None,
) -> None:
    """One run per day, in order, since each needs the balances before it. The
    tables cut the lineage between days."""
    for day in days:
        run_gl_day(
            spark, lines_of(day), master, tables, day, day.replace("-", ""), previous_day
        )
        previous_day = day
