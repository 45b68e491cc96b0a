"""The reconciliation job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import on_day
from ledgerloom.functions.types import DIFFERENCE_COLUMNS
from ledgerloom.operators.accounts import head_by_case, head_by_rules
from ledgerloom.operators.balance import balances_on
from ledgerloom.operators.recon import LABELS, day_over_day, mismatches
from ledgerloom.plans.feeds import ledger_buckets
from ledgerloom.sources.published import write_day


def recon_frame(
    cbs: DataFrame,
    gl: DataFrame,
    history: DataFrame,
    recon_date: str,
    previous_date: str,
    run_time: Column,
    rules: DataFrame | None = None,
    head: Column | None = None,
    labels: tuple[str, str, str] = LABELS,
) -> DataFrame:
    """Differences of ``recon_date`` in the ten columns of the difference table.

    ``cbs`` and ``gl`` are balance tables with BALANCE_DATE, ``history`` the
    difference table: its rows of ``previous_date`` by RECON_DAY, which is its partition,
    or by the run's stamp where it has no such column. HEAD comes from the table
    ``rules``; without one from the expression ``head``, which defaults to the ordered
    rules.
    """
    found = mismatches(balances_on(cbs, recon_date), balances_on(gl, recon_date))
    if rules is not None:
        headed = head_by_rules(found, rules)
    else:
        headed = found.withColumn("HEAD", head_by_case() if head is None else head)
    day_column = "RECON_DAY" if "RECON_DAY" in history.columns else "RECON_RUN_DATE"
    before = history.filter(on_day(F.col(day_column), previous_date))
    compared = day_over_day(headed, before, labels)
    return compared.withColumn("RECON_RUN_DATE", run_time).select(*DIFFERENCE_COLUMNS)


def run_recon(table: str, day: str, buckets: int | None = None, **inputs) -> None:
    """Replaces the day's rows of the difference table, published by RECON_DAY.

    With balances and differences that were written in the same number of ``buckets``, and
    read by `read_day`, nothing is shuffled to compare them.
    """
    rows = recon_frame(recon_date=day, **inputs).withColumn("RECON_DAY", F.lit(day).cast("date"))
    write_day(rows, table, "RECON_DAY", day, buckets=ledger_buckets(buckets))
