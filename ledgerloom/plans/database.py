"""The daily jobs with every table in a relational database.

A database table has no partition to replace, so a job refuses to add a batch or a
day that is already there.

The ledger job appends to two tables, which no transaction spans. A table of batches has a
row for each state that a batch reached: STARTED, POSTED when all its transactions are
there, BALANCED when its balances are too. A run that died is repeated with the same input:
it appends the rows that are still missing, whatever part of them was there, and goes on.
Rows in the database that the input does not give are an error. A batch that is POSTED gets
its balances from its transactions in the database, and the input is not read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import on_day
from ledgerloom.operators.balance import balance_delta, balances_on, roll_forward
from ledgerloom.plans.feeds import feed_balance_frame
from ledgerloom.plans.gl_daily import transactions_of
from ledgerloom.plans.recon_daily import recon_frame
from ledgerloom.sources import jdbc
from ledgerloom.sources.layouts import GlLayout
from ledgerloom.sources.workdir import checkpointed


class TableNames(NamedTuple):
    transactions: str = "GL_TRANSACTIONS"
    gl_balance: str = "GL_BALANCE"
    cbs_balance: str = "CBS_BALANCE"
    master: str = "cgl_master"
    differences: str = "DIFFERENCE"
    rules: str = "cgl_head_mapping"
    batches: str = "GL_BATCH"


STARTED, POSTED, BALANCED = "STARTED", "POSTED", "BALANCED"
BATCH_SCHEMA = "BATCH_ID string, POST_DAY date, STATE string"


#: By table name, how to read a table in several tasks; without one it is a single task.
Splits = dict[str, jdbc.Split] | None


def _reader(spark: SparkSession, db: jdbc.Database, splits: Splits) -> Callable[[str], DataFrame]:
    return lambda table: jdbc.read_table(spark, db, table, (splits or {}).get(table))


def _refuse_if_present(df: DataFrame, test: Column, what: str) -> None:
    if not df.filter(test).isEmpty():
        raise ValueError(f"{what} is already there")


def _previous(table: DataFrame, day: str | None) -> DataFrame | None:
    if day is None:
        return None
    balances = balances_on(table, day)
    if balances.isEmpty():
        raise ValueError(f"no balances for {day}")
    return balances


def _mark(spark: SparkSession, db: jdbc.Database, names: TableNames, batch: str, day: str, state: str) -> None:
    row = spark.createDataFrame([(batch, date.fromisoformat(day), state)], BATCH_SCHEMA)
    jdbc.append(row, db, names.batches)


def _states(batches: DataFrame, batch: str, day: str) -> set[str]:
    """The states that the batch has reached; another batch of the day is an error."""
    of_day = F.col("BATCH_ID").eqNullSafe(batch) | on_day(F.col("POST_DAY"), day)
    found = batches.filter(of_day).select("BATCH_ID", F.date_format("POST_DAY", "yyyy-MM-dd").alias("day"), "STATE").distinct().collect()
    for r in found:
        if r["BATCH_ID"] != batch:
            raise ValueError(f"batch {r['BATCH_ID']} of {day} is there and {r['STATE']}; balance of {day} is already there or to be finished")
        if r["day"] != day:
            raise ValueError(f"batch {batch} is already there, for {r['day']}")
    return {r["STATE"] for r in found}


def append_missing(rows: DataFrame, stored: DataFrame, append: Callable[[DataFrame], None], what: str) -> None:
    """Appends the rows that are not stored yet; equal rows count as often as they are.
    ``rows`` must be cheap to read twice."""
    if stored.isEmpty():
        return append(rows)
    kinds = {f.name: f.dataType for f in rows.schema}
    stored = stored.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns])
    if not stored.exceptAll(rows).isEmpty():
        raise ValueError(f"{what} has rows that this input does not give")
    append(checkpointed(rows.exceptAll(stored)))


def run_gl_day(
    spark: SparkSession,
    db: jdbc.Database,
    lines: DataFrame,
    day: str,
    batch_id: int,
    previous_day: str | None,
    names: TableNames = TableNames(),
    layout: GlLayout = GlLayout(),
    splits: Splits = None,
    **write,
) -> None:
    """Appends the day's transactions and closing balances, or what a run that ended
    early left out of them."""
    read = _reader(spark, db, splits)
    batch = str(jdbc.check_batch_id(batch_id))
    states = _states(read(names.batches), batch, day)
    if BALANCED in states:
        raise ValueError(f"batch {batch} is already there")
    own, today = F.col("BATCH_ID") == batch, on_day(F.col("BALANCE_DATE"), day)
    balances = read(names.gl_balance)
    if not states:
        _refuse_if_present(read(names.transactions), own, f"batch {batch}")
    if POSTED not in states:
        _refuse_if_present(balances, today, f"balance of {day}")
    previous = _previous(balances, previous_day)
    if POSTED not in states:
        transactions = checkpointed(transactions_of(lines, read(names.master), day, batch, layout))
        if not states:
            _mark(spark, db, names, batch, day, STARTED)
        stored = read(names.transactions).filter(own)
        append_missing(transactions, stored, lambda df: jdbc.append(df, db, names.transactions, **write), f"batch {batch}")
        _mark(spark, db, names, batch, day, POSTED)
    posted = read(names.transactions).filter(own)
    closing = checkpointed(roll_forward(previous, balance_delta(posted), day))
    stored = read(names.gl_balance).filter(today)
    append_missing(closing, stored, lambda df: jdbc.append(df, db, names.gl_balance, **write), f"balance of {day}")
    _mark(spark, db, names, batch, day, BALANCED)


def run_feeds(
    spark: SparkSession,
    db: jdbc.Database,
    lines: dict[str, DataFrame],
    day: str,
    previous_day: str | None,
    names: TableNames = TableNames(),
    splits: Splits = None,
    **write,
) -> None:
    read = _reader(spark, db, splits)
    balances = read(names.cbs_balance)
    _refuse_if_present(balances, on_day(F.col("BALANCE_DATE"), day), f"balance of {day}")
    closing = feed_balance_frame(lines, _previous(balances, previous_day), day)
    jdbc.append(closing, db, names.cbs_balance, **write)


def run_recon(
    spark: SparkSession,
    db: jdbc.Database,
    recon_date: str,
    previous_date: str,
    run_time: Column,
    names: TableNames = TableNames(),
    by_rules: bool = True,
    splits: Splits = None,
    **write,
) -> None:
    """Appends the differences of ``recon_date``. A run is known by its RECON_DAY, whenever
    it was stamped; so are yesterday's differences."""
    read = _reader(spark, db, splits)
    history = read(names.differences)
    if "RECON_DAY" not in history.columns:
        raise ValueError(f"{names.differences} needs a column RECON_DAY, the day that was compared")
    _refuse_if_present(history, on_day(F.col("RECON_DAY"), recon_date), f"run of {recon_date}")
    found = recon_frame(
        read(names.cbs_balance),
        read(names.gl_balance),
        history,
        recon_date,
        previous_date,
        run_time,
        read(names.rules) if by_rules else None,
    )
    jdbc.append(found.withColumn("RECON_DAY", F.lit(recon_date).cast("date")), db, names.differences, **write)
