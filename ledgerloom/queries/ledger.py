"""Ledger operators and jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.types import LEDGER_KEYS
from ledgerloom.operators.accounts import head_by_case, head_by_rules, head_fallback
from ledgerloom.operators.balance import (
    aggregate_by_id,
    balance_delta,
    balance_history,
    balance_per_row,
    balanced_totals,
    balances_on,
    balancing_rows,
    decode_lines,
    imbalanced,
    net_check,
    roll_forward,
    to_gl_transactions,
    totals_by,
    with_balancing_rows,
)
from ledgerloom.operators.recon import LABELS_V1, day_over_day, mismatches
from ledgerloom.plans.feeds import feed_balance_frame
from ledgerloom.plans.gl_daily import (
    GlDay,
    GlTables,
    gl_day_frames,
    restate_gl_day,
    run_backfill,
    run_gl_day,
)
from ledgerloom.plans.recon_daily import recon_frame
from ledgerloom.queries.aggregates import SQL_BY_ACCOUNT, agg_by_account
from ledgerloom.queries.registry import query
from ledgerloom.queries.tables import (
    CLOSING_DAY,
    OPENING_DAY,
    SQL_LINES,
    SQL_PERIOD_END,
    SQL_POSTINGS,
    Tables,
    credit,
    debit,
    money,
    sql_branch,
    valid,
)
from ledgerloom.sources.published import read_day, read_days
from ledgerloom.sources.workdir import new_folder


def _day(day: str) -> Column:
    return F.lit(day).cast("date")


# --- transactions and balances ---------------------------------------------


def _gl_sql(where: str, account: str, totals: str = "lines") -> str:
    return f"""SELECT '1001' AS BATCH_ID, CAST(NULL AS VARCHAR) AS JOURNAL_ID,
    DATE '{CLOSING_DAY}' AS POST_DATE, BRANCH_CODE, CURRENCY, {account} AS CGL,
    'CBS consolidated txns' AS NARRATION,
    {money(f"sum({debit('READ_MILLI')})")} AS DEBIT_AMOUNT,
    {money(f"sum({credit('READ_MILLI')})")} AS CREDIT_AMOUNT,
    count(*) AS TRANSACTION_COUNT, 'C' AS SOURCE_FLAG
    FROM {totals} {where} GROUP BY BRANCH_CODE, CURRENCY, postings_cgl"""


_LINES_SQL = f"{SQL_LINES}, raw AS (SELECT *, CGL AS postings_cgl FROM lines)"


@query("gl_schema_map", f"WITH {_LINES_SQL} {_gl_sql('', 'postings_cgl', 'raw')}")
def gl_schema_map(t: Tables) -> DataFrame:
    mapped = to_gl_transactions(aggregate_by_id(decode_lines(t.lines())), "1001", CLOSING_DAY)
    return mapped.withColumn("POST_DATE", F.to_date("POST_DATE"))


@query(
    "balance_delta",
    f"WITH {SQL_POSTINGS} SELECT BRANCH_CODE, CURRENCY, CGL, {money('sum(MILLI)')} AS BALANCE "
    "FROM postings GROUP BY 1, 2, 3",
)
def balance_delta_query(t: Tables) -> DataFrame:
    return balance_delta(t.transactions())


@query(
    "balance_delta_row",
    f"WITH {SQL_POSTINGS} SELECT BRANCH_CODE, CURRENCY, CGL, {money('MILLI')} AS BALANCE FROM postings",
)
def balance_delta_row(t: Tables) -> DataFrame:
    return balance_per_row(t.transactions())


def _split_by_day(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = F.col("POSTING_DATE") <= _day(OPENING_DAY)
    return rows.filter(early), rows.filter(~early)


@query(
    "balance_roll_forward",
    f"""WITH {SQL_POSTINGS} SELECT BRANCH_CODE, CURRENCY, CGL, {money('sum(MILLI)')} AS BALANCE,
    DATE '{CLOSING_DAY}' AS BALANCE_DATE FROM postings GROUP BY 1, 2, 3""",
)
def balance_roll_forward(t: Tables) -> DataFrame:
    before, today = _split_by_day(t.transactions())
    previous = roll_forward(None, balance_delta(before), OPENING_DAY)
    return roll_forward(previous, balance_delta(today), CLOSING_DAY)


SQL_HISTORY = f"""daily AS (
  SELECT BRANCH_CODE, CURRENCY, CGL, {SQL_PERIOD_END} AS BALANCE_DATE, sum(MILLI) AS m
  FROM postings GROUP BY 1, 2, 3, 4), history AS (
  SELECT BRANCH_CODE, CURRENCY, CGL, BALANCE_DATE,
    {money('sum(m) OVER (PARTITION BY BRANCH_CODE, CURRENCY, CGL ORDER BY BALANCE_DATE)')} AS BALANCE
  FROM daily)"""


@query("balance_history", f"WITH {SQL_POSTINGS}, {SQL_HISTORY} SELECT * FROM history")
def balance_history_query(t: Tables) -> DataFrame:
    return balance_history(t.deltas())


@query(
    "balance_as_of_day",
    f"""WITH {SQL_POSTINGS}, {SQL_HISTORY} SELECT BRANCH_CODE, CURRENCY, CGL, BALANCE FROM history
    WHERE BALANCE_DATE = DATE '{OPENING_DAY}'""",
)
def balance_as_of_day(t: Tables) -> DataFrame:
    return balances_on(balance_history(t.deltas()), OPENING_DAY)


# --- balancing -------------------------------------------------------------

_TOTALS = "CAST(0 AS DECIMAL(38,3))"
_BALANCING = f"""SELECT VALIDATED_CGL,
  CASE WHEN d + c < 0 THEN {money('-(d + c)')} ELSE {_TOTALS} END AS TOTAL_DEBIT,
  CASE WHEN d + c > 0 THEN {money('-(d + c)')} ELSE {_TOTALS} END AS TOTAL_CREDIT,
  CAST(0 AS BIGINT) AS TOTAL_TRANSACTIONS FROM by_account WHERE d + c <> 0"""
_OWN = f"""SELECT VALIDATED_CGL, {money('d')} AS TOTAL_DEBIT, {money('c')} AS TOTAL_CREDIT,
  n AS TOTAL_TRANSACTIONS FROM by_account"""


@query(
    "imbalanced_groups",
    f"""WITH {SQL_BY_ACCOUNT} SELECT VALIDATED_CGL, {money('d + c')} AS NET FROM by_account
    WHERE d + c <> 0""",
)
def imbalanced_groups(t: Tables) -> DataFrame:
    return imbalanced(agg_by_account(t)).select("VALIDATED_CGL", "NET")


@query("balancing_rows", f"WITH {SQL_BY_ACCOUNT} {_BALANCING}")
def balancing_rows_query(t: Tables) -> DataFrame:
    return balancing_rows(agg_by_account(t))


@query("with_balancing_rows", f"WITH {SQL_BY_ACCOUNT} {_OWN} UNION ALL {_BALANCING}")
def with_balancing_rows_query(t: Tables) -> DataFrame:
    return with_balancing_rows(agg_by_account(t))


_BALANCED = f"""WITH {SQL_BY_ACCOUNT}, u AS ({_OWN} UNION ALL {_BALANCING}), balanced AS (
  SELECT VALIDATED_CGL, CAST(sum(TOTAL_DEBIT) AS DECIMAL(38,3)) AS TOTAL_DEBIT,
    CAST(sum(TOTAL_CREDIT) AS DECIMAL(38,3)) AS TOTAL_CREDIT,
    CAST(sum(TOTAL_TRANSACTIONS) AS BIGINT) AS TOTAL_TRANSACTIONS FROM u GROUP BY 1)"""


@query("balanced_totals", f"{_BALANCED} SELECT * FROM balanced")
def balanced_totals_query(t: Tables) -> DataFrame:
    return balanced_totals(agg_by_account(t))


@query(
    "net_check",
    f"""{_BALANCED} SELECT count(*) AS n_groups,
    count(*) FILTER (TOTAL_DEBIT + TOTAL_CREDIT <> 0) AS n_imbalanced,
    CAST(sum(TOTAL_DEBIT + TOTAL_CREDIT) AS DECIMAL(38,3)) AS net_total FROM balanced""",
)
def net_check_query(t: Tables) -> DataFrame:
    entries = with_balancing_rows(agg_by_account(t))
    again = entries.select(
        "VALIDATED_CGL",
        F.col("TOTAL_DEBIT").alias("DEBIT_AMOUNT"),
        F.col("TOTAL_CREDIT").alias("CREDIT_AMOUNT"),
        F.col("TOTAL_TRANSACTIONS").alias("TRANSACTION_COUNT"),
    )
    return net_check(totals_by(again, "VALIDATED_CGL"))


# --- second ledger ---------------------------------------------------------


@query(
    "multi_source_balance",
    f"""WITH {SQL_POSTINGS}, feeds AS (
      SELECT {sql_branch('o_custkey')} AS BRANCH_CODE,
        CASE WHEN o_orderpriority < '3' THEN 'INR' ELSE 'USD' END AS CURRENCY, cgl AS CGL,
        CAST(round(o_totalprice * 1000) AS BIGINT)
          * CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END AS m
      FROM orders JOIN accounts ON o_orderkey % 20 = k
      UNION ALL SELECT BRANCH_CODE, CURRENCY, CGL, MILLI FROM postings
      UNION ALL SELECT {sql_branch('c_nationkey')}, 'EUR', cgl,
        CAST(round(c_acctbal * 100) AS BIGINT) * 10
      FROM customer JOIN accounts ON c_custkey % 20 = k),
    opening AS (SELECT BRANCH_CODE, CURRENCY, CGL, sum(MILLI) AS m FROM postings GROUP BY 1, 2, 3)
    SELECT BRANCH_CODE, CURRENCY, CGL, CAST({money('sum(m)')} AS DECIMAL(38,8)) AS BALANCE,
      DATE '{CLOSING_DAY}' AS BALANCE_DATE
    FROM (SELECT * FROM feeds UNION ALL SELECT * FROM opening) GROUP BY 1, 2, 3""",
)
def multi_source_balance(t: Tables) -> DataFrame:
    previous = balance_delta(t.transactions())
    return feed_balance_frame(t.feed_lines(), previous, CLOSING_DAY)


# --- reconciliation --------------------------------------------------------


# The days compared. Everything was posted by the later one.
BEFORE_DAY, RECON_DAY = "2001-07-31", CLOSING_DAY


def _ledgers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Balances of both days. The second ledger lacks the seventh line of an order if
    its quantity is over 45, and some balances are NULL."""

    def closing(rows: DataFrame, is_null: Column) -> DataFrame:
        days = [
            roll_forward(None, balance_delta(rows.filter(F.col("POSTING_DATE") <= _day(day))), day)
            for day in (BEFORE_DAY, RECON_DAY)
        ]
        return days[0].unionByName(days[1]).withColumn("BALANCE", F.when(~is_null, F.col("BALANCE")))

    branch, currency = F.col("BRANCH_CODE"), F.col("CURRENCY")
    rows = t.transactions()
    cbs_null = (branch == "00005") & (currency == "EUR") | (branch == "00007")
    gl_null = (branch == "00006") & (currency == "USD") | (branch == "00007")
    lacking = (F.col("l_linenumber") == 7) & (F.col("TRANSACTION_COUNT") > 45)
    return closing(rows.filter(~lacking), cbs_null), closing(rows, gl_null)


def _closing_balances_sql(name: str, where: str, is_null: str) -> str:
    return f"""{name} AS (SELECT BRANCH_CODE, CURRENCY, CGL, day AS BALANCE_DATE,
      CASE WHEN NOT ({is_null}) THEN {money('sum(MILLI)')} END AS BALANCE
    FROM postings JOIN (VALUES (DATE '{BEFORE_DAY}'), (DATE '{RECON_DAY}')) d(day)
      ON POSTING_DATE <= day
    WHERE {where} GROUP BY 1, 2, 3, 4)"""


def _mismatch_sql(name: str, day: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT BRANCH_CODE, CURRENCY, CGL, cbs.BALANCE AS CBS_BALANCE,
      gl.BALANCE AS GL_BALANCE,
      CAST(coalesce(cbs.BALANCE, 0) - coalesce(gl.BALANCE, 0) AS DECIMAL(20,4)) AS DIFFERENCE_AMOUNT
    FROM cbs JOIN gl USING (BRANCH_CODE, CURRENCY, CGL, BALANCE_DATE)
    WHERE BALANCE_DATE = DATE '{day}')
  WHERE CBS_BALANCE <> GL_BALANCE OR CBS_BALANCE IS NULL OR GL_BALANCE IS NULL)"""


_CBS_NULL = "BRANCH_CODE = '00005' AND CURRENCY = 'EUR' OR BRANCH_CODE = '00007'"
_GL_NULL = "BRANCH_CODE = '00006' AND CURRENCY = 'USD' OR BRANCH_CODE = '00007'"
SQL_RECON = f"""{SQL_POSTINGS}, {_closing_balances_sql('cbs', 'NOT (l_linenumber = 7 AND QUANTITY > 45)', _CBS_NULL)},
{_closing_balances_sql('gl', 'TRUE', _GL_NULL)}, {_mismatch_sql('today', RECON_DAY)},
{_mismatch_sql('yesterday', BEFORE_DAY)}"""
SQL_COMPARED = """compared AS (SELECT today.*, yesterday.DIFFERENCE_AMOUNT AS before,
  CAST(coalesce(today.DIFFERENCE_AMOUNT, 0) - coalesce(yesterday.DIFFERENCE_AMOUNT, 0)
    AS DECIMAL(20,4)) AS DIFF_BW_YESTERDAY
  FROM today LEFT JOIN yesterday USING (BRANCH_CODE, CURRENCY, CGL))"""


def _type_sql(same: str, other: str) -> str:
    return (
        f"CASE WHEN before IS NULL THEN 'New Entry' WHEN DIFF_BW_YESTERDAY = 0 THEN '{same}' "
        f"ELSE '{other}' END"
    )


def _mismatches_on(t: Tables, day: str) -> DataFrame:
    cbs, gl = _ledgers(t)
    return mismatches(balances_on(cbs, day), balances_on(gl, day))


@query("recon_mismatch", f"WITH {SQL_RECON} SELECT * FROM today")
def recon_mismatch(t: Tables) -> DataFrame:
    return _mismatches_on(t, RECON_DAY)


_COMPARED_COLUMNS = ["BRANCH_CODE", "CURRENCY", "CGL", "DIFFERENCE_AMOUNT", "DIFF_BW_YESTERDAY", "TYPE"]


def _compared_sql(same: str, other: str) -> str:
    return f"""WITH {SQL_RECON}, {SQL_COMPARED} SELECT BRANCH_CODE, CURRENCY, CGL,
    DIFFERENCE_AMOUNT, DIFF_BW_YESTERDAY, {_type_sql(same, other)} AS TYPE FROM compared"""


@query("diff_day_over_day", _compared_sql("Unchanged", "Changed"))
def diff_day_over_day(t: Tables) -> DataFrame:
    compared = day_over_day(_mismatches_on(t, RECON_DAY), _mismatches_on(t, BEFORE_DAY))
    return compared.select(*_COMPARED_COLUMNS)


@query("diff_labels_v1", _compared_sql("Zero Difference", "Diff change"))
def diff_labels_v1(t: Tables) -> DataFrame:
    compared = day_over_day(_mismatches_on(t, RECON_DAY), _mismatches_on(t, BEFORE_DAY), LABELS_V1)
    return compared.select(*_COMPARED_COLUMNS)


# --- HEAD ------------------------------------------------------------------

SQL_HEAD = """CASE WHEN BRANCH_CODE = '01999' THEN 'CAO'
  WHEN CGL[9:9] = '9' THEN 'PROVISION' WHEN CGL LIKE '1204%' THEN 'CASH'
  WHEN CGL LIKE '62%' THEN 'AUCA' WHEN CGL LIKE '6363%' THEN 'CTA 6363'
  WHEN CGL LIKE '4363%' THEN 'CTA 4363' WHEN CGL[1:1] IN ('4', '6') THEN 'CTA'
  WHEN CGL[1:1] IN ('7', '8') THEN 'I/E'
  WHEN CGL LIKE '5%' AND CURRENCY = 'INR' THEN 'MEMO' WHEN CGL LIKE '5%' THEN 'FC MEMO'
  WHEN CGL LIKE '2148%' AND CURRENCY = 'INR' THEN 'BGL' WHEN CGL LIKE '2148%' THEN 'FC'
  WHEN CGL LIKE '2249%' THEN 'INCA' WHEN CGL IN ('2111', '2115', '2060') THEN 'PPF'
  WHEN CGL = '1106505002' AND BRANCH_CODE IN ('03973', '03974', '03975', '03976', '04030', '04425',
    '04454', '06939') THEN 'LHO'
  WHEN CGL = '1106505002' THEN 'BCGA' WHEN CGL = '1000505003' THEN 'MIGRATION'
  WHEN CGL = '1100505001' THEN 'LHO'
  WHEN CGL LIKE '1%' AND CURRENCY = 'INR' THEN 'LOAN' WHEN CGL LIKE '1%' THEN 'FC' END"""
_KEYS_SQL = f"WITH {SQL_POSTINGS}, keys AS (SELECT DISTINCT BRANCH_CODE, CURRENCY, CGL FROM postings)"


def _keys(t: Tables) -> DataFrame:
    return t.postings().select(*LEDGER_KEYS).distinct()


@query("head_case", f"{_KEYS_SQL} SELECT *, {SQL_HEAD} AS HEAD FROM keys")
def head_case(t: Tables) -> DataFrame:
    return _keys(t).withColumn("HEAD", head_by_case())


@query(
    "head_fallback",
    f"""{_KEYS_SQL} SELECT *, CASE WHEN CGL LIKE '5%' THEN 'MEMO' WHEN CGL LIKE '1%' THEN 'LOAN'
    ELSE 'OTHER' END AS HEAD FROM keys""",
)
def head_fallback_query(t: Tables) -> DataFrame:
    return _keys(t).withColumn("HEAD", head_fallback())


# priority, branch_code, cgl_prefix, currency, head_category; None matches anything.
RULES = [
    (10, "01999", None, None, "CAO"),
    (20, None, "1204", None, "CASH"),
    (30, None, "62", None, "AUCA"),
    (40, None, "5", "INR", "MEMO"),
    (50, None, "5", None, "FC MEMO"),
    (60, "03973", "1106505002", None, "LHO"),
    (70, None, "1106505002", None, "BCGA"),
    (80, None, "1", "INR", "LOAN"),
    (90, None, "1", None, "FC"),
    (95, "00004", None, "EUR", "OFFSHORE"),
]
RULES_SCHEMA = (
    "priority int, branch_code string, cgl_prefix string, currency string, head_category string"
)


def _rule_values() -> str:
    def text(value) -> str:
        return "NULL" if value is None else f"'{value}'"

    return ", ".join(f"({p}, {text(b)}, {text(g)}, {text(c)}, '{h}')" for p, b, g, c, h in RULES)


_RULES_SQL = f"""rules(priority, branch_code, cgl_prefix, currency, head_category) AS
  (VALUES {_rule_values()})"""


def _ruled_sql(keys: str) -> str:
    return f"""SELECT x.BRANCH_CODE, x.CURRENCY, x.CGL,
    coalesce(min_by(head_category, priority), 'UNCLASSIFIED') AS HEAD
    FROM {keys} x LEFT JOIN rules r ON (r.branch_code IS NULL OR r.branch_code = x.BRANCH_CODE)
      AND (r.currency IS NULL OR r.currency = x.CURRENCY)
      AND (r.cgl_prefix IS NULL OR starts_with(x.CGL, r.cgl_prefix))
    GROUP BY 1, 2, 3"""


@query("head_by_rules", f"{_KEYS_SQL}, {_RULES_SQL} {_ruled_sql('keys')}")
def head_by_rules_query(t: Tables) -> DataFrame:
    return head_by_rules(_keys(t), t.spark.createDataFrame(RULES, RULES_SCHEMA))


@query("head_by_rules_joined", f"{_KEYS_SQL}, {_RULES_SQL} {_ruled_sql('keys')}")
def head_by_rules_joined(t: Tables) -> DataFrame:
    """The way taken when the tries are too large for a broadcast."""
    return head_by_rules(_keys(t), t.spark.createDataFrame(RULES, RULES_SCHEMA), max_broadcast_rows=0)


# --- jobs ------------------------------------------------------------------


def gl_days(t: Tables) -> GlDay:
    """Two posting days in a row: everything up to the opening day, then the rest."""
    before, today = _split_by_day(t.postings())
    first = gl_day_frames(t.lines(before), t.master(), None, OPENING_DAY, "1000")
    return gl_day_frames(t.lines(today), t.master(), first.balances, CLOSING_DAY, "1001")


_VALID_LINES = f"{SQL_LINES}, raw AS (SELECT *, CGL AS postings_cgl, {valid()} AS valid_cgl FROM lines)"


@query(
    "gl_daily",
    f"""WITH {_VALID_LINES} SELECT BRANCH_CODE, CURRENCY, valid_cgl AS CGL,
    {money('coalesce(sum(READ_MILLI), 0)')} AS BALANCE, DATE '{CLOSING_DAY}' AS BALANCE_DATE
    FROM raw GROUP BY 1, 2, 3""",
)
def gl_daily(t: Tables) -> DataFrame:
    return gl_days(t).balances


@query(
    "gl_daily_transactions",
    f"WITH {_VALID_LINES} "
    + _gl_sql(f"WHERE POSTING_DATE > DATE '{OPENING_DAY}'", "any_value(valid_cgl)", "raw"),
)
def gl_daily_transactions(t: Tables) -> DataFrame:
    return gl_days(t).transactions.withColumn("POST_DATE", F.to_date("POST_DATE"))


_BACKFILL_DAYS = ["1997-12-31", "1999-12-31", CLOSING_DAY]


def _closing_sql(day: str) -> str:
    return f"""SELECT BRANCH_CODE, CURRENCY, valid_cgl AS CGL,
    {money('coalesce(sum(READ_MILLI), 0)')} AS BALANCE, DATE '{day}' AS BALANCE_DATE
    FROM raw WHERE POSTING_DATE <= DATE '{day}' GROUP BY 1, 2, 3"""


@query(
    "gl_backfill",
    f"WITH {_VALID_LINES} " + " UNION ALL ".join(_closing_sql(d) for d in _BACKFILL_DAYS),
)
def gl_backfill(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "backfill")
    tables = GlTables(f"{folder}/transactions", f"{folder}/balances")
    postings = t.postings()
    starts = dict(zip(_BACKFILL_DAYS, ["0001-01-01", *_BACKFILL_DAYS]))

    def lines_of(day: str) -> DataFrame:
        date = F.col("POSTING_DATE")
        return t.lines(postings.filter((date > _day(starts[day])) & (date <= _day(day))))

    run_backfill(t.spark, lines_of, t.master(), tables, _BACKFILL_DAYS)
    return read_days(t.spark, tables.balances, "BALANCE_DATE").select(*LEDGER_KEYS, "BALANCE", "BALANCE_DATE")


@query(
    "gl_restated",
    f"WITH {_VALID_LINES} " + " UNION ALL ".join(_closing_sql(d) for d in _BACKFILL_DAYS),
)
def gl_restated(t: Tables) -> DataFrame:
    """The same balances after a day was first posted from other lines and then corrected."""
    folder = new_folder(t.spark, "restated")
    tables = GlTables(f"{folder}/transactions", f"{folder}/balances")
    postings, first = t.postings(), F.col("l_linenumber")
    starts = dict(zip(_BACKFILL_DAYS, ["0001-01-01", *_BACKFILL_DAYS]))

    def lines_of(day: str, corrected: bool = False) -> DataFrame:
        date = F.col("POSTING_DATE")
        rows = postings.filter((date > _day(starts[day])) & (date <= _day(day)))
        if day == _BACKFILL_DAYS[0] and not corrected:  # some lines twice, others missing
            rows = rows.filter(first > 1).unionByName(rows.filter(first == 3))
        return t.lines(rows)

    run_backfill(t.spark, lines_of, t.master(), tables, _BACKFILL_DAYS)
    restate_gl_day(t.spark, lines_of(_BACKFILL_DAYS[0], True), t.master(), tables, _BACKFILL_DAYS[0], "2001")
    return read_days(t.spark, tables.balances, "BALANCE_DATE").select(*LEDGER_KEYS, "BALANCE", "BALANCE_DATE")


@query(
    "gl_rejects",
    f"""WITH {SQL_LINES} SELECT Id, CAST(sum(LINES) AS BIGINT) AS LINES, count(*) AS DISTINCT_LINES FROM (
      SELECT Id, abs(MILLI), count(*) AS LINES FROM lines WHERE READ_MILLI IS NULL
        AND POSTING_DATE > DATE '{OPENING_DAY}' GROUP BY 1, 2) GROUP BY 1""",
)
def gl_rejects(t: Tables) -> DataFrame:
    """Lines that the daily job could not decode, from the table that it publishes."""
    folder = new_folder(t.spark, "rejects")
    tables = GlTables(f"{folder}/transactions", f"{folder}/balances", f"{folder}/rejects")
    _, today = _split_by_day(t.postings())
    run_gl_day(t.spark, t.lines(today), t.master(), tables, CLOSING_DAY, "1001", None)
    rejects = read_day(t.spark, tables.rejects, "POST_DAY", CLOSING_DAY)
    return rejects.groupBy("Id").agg(F.sum("LINES").alias("LINES"), F.count(F.lit(1)).alias("DISTINCT_LINES"))


def _recon_sql(head: str, extra: str = "") -> str:
    return f"""WITH {SQL_RECON}, {SQL_COMPARED}{extra}
    SELECT TIMESTAMP '{RECON_DAY} 06:00:00' AS RECON_RUN_DATE, BRANCH_CODE, CURRENCY, CGL,
      CBS_BALANCE, GL_BALANCE, DIFFERENCE_AMOUNT, DIFF_BW_YESTERDAY,
      {_type_sql('Unchanged', 'Changed')} AS TYPE, {head} AS HEAD FROM compared"""


def _recon(t: Tables, rules: DataFrame | None) -> DataFrame:
    cbs, gl = _ledgers(t)
    run_time = F.lit(f"{RECON_DAY} 06:00:00").cast("timestamp_ntz")
    before = F.lit(f"{BEFORE_DAY} 06:00:00").cast("timestamp_ntz")
    history = _mismatches_on(t, BEFORE_DAY).withColumn("RECON_RUN_DATE", before)
    return recon_frame(cbs, gl, history, RECON_DAY, BEFORE_DAY, run_time, rules)


@query("recon_daily", _recon_sql(SQL_HEAD))
def recon_daily(t: Tables) -> DataFrame:
    return _recon(t, None)


@query(
    "recon_daily_rules",
    _recon_sql("(SELECT HEAD FROM ruled r WHERE r.BRANCH_CODE = compared.BRANCH_CODE "
               "AND r.CURRENCY = compared.CURRENCY AND r.CGL = compared.CGL)",
               f", {_RULES_SQL}, ruled AS ({_ruled_sql('compared')})"),
)
def recon_daily_rules(t: Tables) -> DataFrame:
    return _recon(t, t.spark.createDataFrame(RULES, RULES_SCHEMA))
