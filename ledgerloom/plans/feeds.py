"""The second ledger: several trailing-sign sources into one balance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.types import FEED_TOTAL, LEDGER_KEYS
from ledgerloom.operators.balance import balances_on, decode_feed, feed_totals, roll_forward
from ledgerloom.sources.layouts import FEEDS
from ledgerloom.sources.published import Buckets, read_day, write_day


def feed_balance_frame(
    lines: dict[str, DataFrame], previous: DataFrame | None, day: str
) -> DataFrame:
    """Closing balances of ``day`` from lines by feed name. The sources share one
    shuffle, after a map-side sum."""
    decoded = [decode_feed(df, FEEDS[name]) for name, df in lines.items()]
    return roll_forward(previous, feed_totals(decoded), day, FEED_TOTAL)


def previous_balances(spark: SparkSession, table: str, day: str | None) -> DataFrame | None:
    """The balances of one published day. None states that there are none before; a
    stated day without balances is an error."""
    if day is None:
        return None
    found = read_day(spark, table, "BALANCE_DATE", day)
    if found is None or found.isEmpty():
        raise ValueError(f"no balances for {day}")
    return balances_on(found, day)


def ledger_buckets(number: int | None) -> Buckets | None:
    return None if number is None else Buckets(list(LEDGER_KEYS), number)


def run_feeds(
    spark: SparkSession,
    lines: dict[str, DataFrame],
    table: str,
    day: str,
    previous_day: str | None,
    buckets: int | None = None,
) -> None:
    """Publishes the day's closing balances, from those of ``previous_day`` alone."""
    previous = previous_balances(spark, table, previous_day)
    closing = feed_balance_frame(lines, previous, day)
    write_day(closing, table, "BALANCE_DATE", day, buckets=ledger_buckets(buckets))
