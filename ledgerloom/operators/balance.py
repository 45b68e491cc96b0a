"""Postings to totals, balances and their history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.amounts import (
    credit_of,
    debit_of,
    overpunch_amount,
    trailing_sign_amount,
)
from ledgerloom.functions.fixedwidth import currency_slice, split_key
from ledgerloom.functions.scalars import on_day
from ledgerloom.functions.types import (
    FEED_TOTAL,
    GL_TRANSACTION_COLUMNS,
    LEDGER_KEYS,
    TOTAL,
)
from ledgerloom.operators.accounts import validate_accounts
from ledgerloom.sources.layouts import KEY_FIELDS, FeedLayout, GlLayout

# Fixed values of the transactions table.
NARRATION = "CBS consolidated txns"
SOURCE_FLAG = "C"


# --- lines to amounts ------------------------------------------------------


def _amount_fields(lines: DataFrame, layout: GlLayout) -> DataFrame:
    """Id and the selected amount slot, in a select of its own: the slot is used
    several times by the decoding, and is not repeated in it that way."""
    line = F.col("value")
    slot = currency_slice(line, layout.currency, *layout.amounts, layout.local_currency)
    return lines.select("*", layout.key.of(line).alias("Id"), slot.alias("_slot"))


def _amount(layout: GlLayout) -> Column:
    return overpunch_amount(F.col("_slot"), layout.amount_length, layout.decimals)


def decode_lines(lines: DataFrame, layout: GlLayout = GlLayout()) -> DataFrame:
    """Id, Amount, DEBIT_AMOUNT, CREDIT_AMOUNT of each line. Amount is NULL for a
    line that cannot be decoded; both sides are then 0 and the line still counts."""
    decoded = _amount_fields(lines, layout).select("Id", _amount(layout).alias("Amount"))
    amount = F.col("Amount")
    return decoded.select(
        "Id",
        "Amount",
        debit_of(amount).alias("DEBIT_AMOUNT"),
        credit_of(amount).alias("CREDIT_AMOUNT"),
    )


def rejected_lines(lines: DataFrame, layout: GlLayout = GlLayout()) -> DataFrame:
    """Lines whose amount cannot be decoded."""
    rejected = _amount_fields(lines, layout).filter(_amount(layout).isNull())
    return rejected.select(*lines.columns)


def decode_feed(lines: DataFrame, feed: FeedLayout) -> DataFrame:
    """Id and signed Amount of one trailing-sign source."""
    line = F.col("value")
    return lines.select(
        feed.key.of(line).alias("Id"),
        trailing_sign_amount(feed.amount.of(line), feed.sign.of(line), feed.decimals).alias("Amount"),
    )


# --- totals ----------------------------------------------------------------


def totals_and_rejects(lines: DataFrame, layout: GlLayout = GlLayout()) -> DataFrame:
    """Totals by Id and, for lines whose amount cannot be decoded, by REJECTED, the line
    itself: sums and rejects in one scan. Equal rejects are combined before a shuffle."""
    line, amount = F.col("value"), F.col("Amount")
    decoded = _amount_fields(lines, layout).select("value", "Id", _amount(layout).alias("Amount"))
    sides = decoded.select(
        "Id",
        F.when(amount.isNull(), line).alias("REJECTED"),
        debit_of(amount).alias("DEBIT_AMOUNT"),
        credit_of(amount).alias("CREDIT_AMOUNT"),
    )
    return sides.groupBy("Id", "REJECTED").agg(
        _total("DEBIT_AMOUNT"), _total("CREDIT_AMOUNT"), F.count(F.lit(1)).alias("TRANSACTION_COUNT")
    )


def totals_by_id(parts: DataFrame) -> DataFrame:
    """One row per Id from `totals_and_rejects`."""
    return parts.groupBy("Id").agg(
        _total("DEBIT_AMOUNT"), _total("CREDIT_AMOUNT"), F.sum("TRANSACTION_COUNT").alias("TRANSACTION_COUNT")
    )


def _total(name: str, alias: str | None = None) -> Column:
    return F.sum(name).cast(TOTAL).alias(alias or name)


def aggregate_by_id(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("Id").agg(
        _total("DEBIT_AMOUNT"),
        _total("CREDIT_AMOUNT"),
        F.count(F.lit(1)).alias("TRANSACTION_COUNT"),
    )


def to_gl_transactions(
    totals: DataFrame, batch_id: str, posting_date: str, key_fields=KEY_FIELDS
) -> DataFrame:
    """Totals by Id in the eleven columns of the transactions table."""
    key = {f.name: c for f, c in zip(key_fields, split_key(F.col("Id"), key_fields))}
    constants = {
        "BATCH_ID": F.lit(str(batch_id)),
        "JOURNAL_ID": F.lit(None).cast("string"),
        "POST_DATE": F.to_timestamp(F.lit(posting_date), "yyyy-MM-dd"),
        "NARRATION": F.lit(NARRATION),
        "SOURCE_FLAG": F.lit(SOURCE_FLAG),
    }
    return totals.select(
        *[
            constants[c].alias(c) if c in constants else key.get(c, F.col(c))
            for c in GL_TRANSACTION_COLUMNS
        ]
    )


def totals_by(df: DataFrame, *keys: str) -> DataFrame:
    """Debit, credit and transaction totals by any key."""
    return df.groupBy(*keys).agg(
        _total("DEBIT_AMOUNT", "TOTAL_DEBIT"),
        _total("CREDIT_AMOUNT", "TOTAL_CREDIT"),
        F.sum("TRANSACTION_COUNT").alias("TOTAL_TRANSACTIONS"),
    )


def validated_totals(txns: DataFrame, accounts: DataFrame, **options) -> DataFrame:
    """Totals by validated account.

    Sums by raw account first, so that the join to the master sees one row per
    account however many postings a hot account has.
    """
    by_account = totals_by(txns, "CGL")
    checked = validate_accounts(by_account, accounts, "VALIDATED_CGL", **options)
    return checked.groupBy("VALIDATED_CGL").agg(
        *[F.sum(c).cast(TOTAL).alias(c) for c in ("TOTAL_DEBIT", "TOTAL_CREDIT")],
        F.sum("TOTAL_TRANSACTIONS").alias("TOTAL_TRANSACTIONS"),
    )


def branch_summary(df: DataFrame) -> DataFrame:
    """Per branch, currency and account: sums, rows and summed transaction counts."""
    return df.groupBy(*LEDGER_KEYS).agg(
        _total("DEBIT_AMOUNT", "TOTAL_DEBIT"),
        _total("CREDIT_AMOUNT", "TOTAL_CREDIT"),
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.sum("TRANSACTION_COUNT").alias("TOTAL_TRANSACTIONS"),
    )


# --- balancing -------------------------------------------------------------


def _net() -> Column:
    return (F.col("TOTAL_DEBIT") + F.col("TOTAL_CREDIT")).cast(TOTAL)


def imbalanced(totals: DataFrame) -> DataFrame:
    """Groups whose debit and credit do not cancel, with their NET."""
    return totals.withColumn("NET", _net()).filter(F.col("NET") != 0)


def _balancing_side(net: Column, test: Column) -> Column:
    return F.when(test, -net).otherwise(F.lit(0)).cast(TOTAL)


def balancing_rows(totals: DataFrame) -> DataFrame:
    """The entries that bring every group to a net of zero; they count 0 transactions."""
    net = F.col("NET")
    keys = [c for c in totals.columns if not c.startswith("TOTAL_")]
    return imbalanced(totals).select(
        *keys,
        _balancing_side(net, net < 0).alias("TOTAL_DEBIT"),
        _balancing_side(net, net > 0).alias("TOTAL_CREDIT"),
        F.lit(0).cast("bigint").alias("TOTAL_TRANSACTIONS"),
    )


def with_balancing_rows(totals: DataFrame) -> DataFrame:
    """Totals and their balancing rows in one pass over ``totals``.

    Each row expands into itself and, if need be, its balancing row; a union
    would compute the totals twice.
    """
    net = F.col("_net")
    keys = [c for c in totals.columns if not c.startswith("TOTAL_")]

    def entry(debit: Column, credit: Column, transactions: Column) -> Column:
        return F.struct(
            debit.cast(TOTAL).alias("TOTAL_DEBIT"),
            credit.cast(TOTAL).alias("TOTAL_CREDIT"),
            transactions.cast("bigint").alias("TOTAL_TRANSACTIONS"),
        )

    own = entry(F.col("TOTAL_DEBIT"), F.col("TOTAL_CREDIT"), F.col("TOTAL_TRANSACTIONS"))
    extra = entry(_balancing_side(net, net < 0), _balancing_side(net, net > 0), F.lit(0))
    rows = F.when(net != 0, F.array(own, extra)).otherwise(F.array(own))
    return totals.withColumn("_net", _net()).select(*keys, F.inline(rows))


def balanced_totals(totals: DataFrame) -> DataFrame:
    """Totals after balancing: what grouping ``with_balancing_rows`` again gives,
    without a second shuffle."""
    net = F.col("_net")
    keys = [c for c in totals.columns if not c.startswith("TOTAL_")]
    zero = F.lit(0).cast(TOTAL)
    return totals.withColumn("_net", F.coalesce(_net(), zero)).select(
        *keys,
        (F.col("TOTAL_DEBIT") + _balancing_side(net, net < 0)).cast(TOTAL).alias("TOTAL_DEBIT"),
        (F.col("TOTAL_CREDIT") + _balancing_side(net, net > 0)).cast(TOTAL).alias("TOTAL_CREDIT"),
        "TOTAL_TRANSACTIONS",
    )


def net_check(totals: DataFrame) -> DataFrame:
    """One row: number of groups, number still out of balance, sum of their nets."""
    net = _net()
    return totals.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(net != 0).alias("n_imbalanced"),
        F.coalesce(F.sum(net), F.lit(0)).cast(TOTAL).alias("net_total"),
    )


# --- balances --------------------------------------------------------------


def balance_delta(txns: DataFrame, *by: str) -> DataFrame:
    """BALANCE per branch, currency and account, and ``by``: debits plus (negative) credits."""
    side = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return txns.groupBy(*LEDGER_KEYS, *by).agg(
        (side("DEBIT_AMOUNT") + side("CREDIT_AMOUNT")).cast(TOTAL).alias("BALANCE")
    )


def balance_per_row(txns: DataFrame) -> DataFrame:
    """The same without grouping; NULL on either side gives NULL."""
    return txns.select(
        *LEDGER_KEYS, (F.col("DEBIT_AMOUNT") + F.col("CREDIT_AMOUNT")).cast(TOTAL).alias("BALANCE")
    )


def balances_on(balances: DataFrame, day: str) -> DataFrame:
    """Balances of one calendar day; BALANCE_DATE may be a date or a timestamp. On a
    table partitioned by it this prunes, and a database gets it as a filter."""
    return balances.filter(on_day(F.col("BALANCE_DATE"), day)).select(*LEDGER_KEYS, "BALANCE")


def roll_forward(
    previous: DataFrame | None, delta: DataFrame, day: str, total: T.DecimalType = TOTAL
) -> DataFrame:
    """Closing balances of ``day``: the previous ones plus the day's delta. Keys of
    either side survive. ``previous=None`` states that there is no earlier day."""
    columns = [*LEDGER_KEYS, "BALANCE"]
    parts = [delta] if previous is None else [previous, delta]
    rows = reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
    return (
        rows.groupBy(*LEDGER_KEYS)
        .agg(F.sum("BALANCE").cast(total).alias("BALANCE"))
        .withColumn("BALANCE_DATE", F.lit(day).cast("date"))
    )


def feed_totals(decoded: list[DataFrame]) -> DataFrame:
    """BALANCE per key over several decoded sources."""
    rows = reduce(DataFrame.unionByName, [d.select("Id", "Amount") for d in decoded])
    totals = rows.groupBy("Id").agg(F.sum("Amount").cast(FEED_TOTAL).alias("BALANCE"))
    return totals.select(*split_key(F.col("Id"), KEY_FIELDS), "BALANCE")


def balance_history(deltas: DataFrame) -> DataFrame:
    """Closing balance after every date that has postings, for all dates at once.

    Input: ledger keys, BALANCE_DATE, BALANCE (the delta). Deltas are summed per
    key and date first, so a window holds at most one row per date.
    """
    daily = deltas.groupBy(*LEDGER_KEYS, "BALANCE_DATE").agg(_total("BALANCE"))
    so_far = Window.partitionBy(*LEDGER_KEYS).orderBy("BALANCE_DATE")
    return daily.withColumn("BALANCE", F.sum("BALANCE").over(so_far).cast(TOTAL))


def closing_balances(previous: DataFrame | None, deltas: DataFrame, days: list[str]) -> DataFrame:
    """Closing balances of each of ``days`` at once, as `roll_forward` gives them day by day.

    ``previous`` are those before the first day, ``deltas`` the changes by BALANCE_DATE. A
    balance holds from a day with a posting to the next one, so a window has a row per
    posting day, and each is repeated for the days that it holds.
    """
    columns = [*LEDGER_KEYS, "BALANCE_DATE", "BALANCE"]
    dates = F.array(*[F.lit(d).cast("date") for d in sorted(days)])
    rows = deltas.select(*columns)
    if previous is not None:
        rows = rows.unionByName(previous.withColumn("BALANCE_DATE", F.lit(min(days)).cast("date")).select(*columns))
    order = Window.partitionBy(*LEDGER_KEYS).orderBy("BALANCE_DATE")
    held = rows.groupBy(*LEDGER_KEYS, "BALANCE_DATE").agg(F.sum("BALANCE").alias("BALANCE")).select(
        *LEDGER_KEYS,
        F.col("BALANCE_DATE").alias("_from"),
        F.lead("BALANCE_DATE").over(order).alias("_to"),
        F.sum("BALANCE").over(order).cast(TOTAL).alias("BALANCE"),
    )
    holds = F.filter(dates, lambda d: (d >= F.col("_from")) & (F.col("_to").isNull() | (d < F.col("_to"))))
    return held.select(*LEDGER_KEYS, "BALANCE", F.explode(holds).alias("BALANCE_DATE"))
