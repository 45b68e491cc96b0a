"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.types import LEDGER_KEYS, TOTAL
from ledgerloom.operators.accounts import active_accounts, validate_accounts
from ledgerloom.operators.aggregates import join_back_summary
from ledgerloom.operators.joins import join_unique, with_exists_flag
from ledgerloom.queries.registry import query
from ledgerloom.queries.tables import (
    SQL_POSTINGS,
    Tables,
    credit,
    debit,
    money,
    valid,
)

_POSTING = ["l_orderkey", "l_linenumber", "CGL"]

_VALIDATE_SQL = f"WITH {SQL_POSTINGS} SELECT l_orderkey, l_linenumber, {valid()} AS CGL FROM postings"


@query("account_validate", _VALIDATE_SQL)
def account_validate(t: Tables) -> DataFrame:
    return validate_accounts(t.postings().select(*_POSTING), active_accounts(t.master()))


@query("account_validate_large_master", _VALIDATE_SQL)
def account_validate_large_master(t: Tables) -> DataFrame:
    """The way taken when the master is too large to broadcast."""
    accounts = active_accounts(t.master())
    return validate_accounts(t.postings().select(*_POSTING), accounts, max_broadcast_rows=0)


@query(
    "join_exist_flag",
    f"""WITH {SQL_POSTINGS} SELECT l_orderkey, l_linenumber, CGL,
    CASE WHEN CGL IN (SELECT CGL FROM master) THEN 1 END AS IS_VALID FROM postings""",
)
def join_exist_flag(t: Tables) -> DataFrame:
    codes = t.master().filter(F.col("BAL_COMPARE") == 1).select(F.col("CGL_NUMBER").alias("CGL"))
    return with_exists_flag(t.postings().select(*_POSTING), codes, "CGL")


def _join_sql(how: str) -> str:
    return f"""SELECT coalesce(c_custkey, o_custkey) AS custkey, o_orderkey, c_name
    FROM orders {how} JOIN customer ON o_custkey = c_custkey"""


def _orders_customers(t: Tables, how: str, **options) -> DataFrame:
    # Order keys are shifted by customer so that each side has keys the other lacks.
    orders = t.orders.select((F.col("o_custkey") + 100).alias("custkey"), "o_orderkey")
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    return join_unique(orders, customers, ["custkey"], how, **options).select(
        "custkey", "o_orderkey", "c_name"
    )


def _shifted(how: str) -> str:
    return _join_sql(how).replace("o_custkey", "(o_custkey + 100)")


@query("join_inner", _shifted("INNER"))
def join_inner(t: Tables) -> DataFrame:
    return _orders_customers(t, "inner")


@query("join_left", _shifted("LEFT"))
def join_left(t: Tables) -> DataFrame:
    return _orders_customers(t, "left")


@query("join_right", _shifted("RIGHT"))
def join_right(t: Tables) -> DataFrame:
    return _orders_customers(t, "right")


@query("join_full", _shifted("FULL"))
def join_full(t: Tables) -> DataFrame:
    return _orders_customers(t, "full")


@query("join_shuffled", _shifted("FULL"))
def join_shuffled(t: Tables) -> DataFrame:
    """The way taken when the table with unique keys is too large to broadcast."""
    return _orders_customers(t, "full", max_broadcast_rows=0)


@query(
    "summary_join_back",
    f"""WITH {SQL_POSTINGS}, s AS (SELECT BRANCH_CODE, CURRENCY, CGL, sum({debit()}) AS d,
      sum({credit()}) AS c, sum(QUANTITY) AS n FROM postings GROUP BY 1, 2, 3)
    SELECT l_orderkey, l_linenumber, {money('d')} AS TOTAL_DEBIT, {money('c')} AS TOTAL_CREDIT,
      CAST(n AS BIGINT) AS TOTAL_TRANSACTIONS
    FROM postings JOIN s USING (BRANCH_CODE, CURRENCY, CGL)""",
)
def summary_join_back(t: Tables) -> DataFrame:
    totals = [
        F.sum("DEBIT_AMOUNT").cast(TOTAL).alias("TOTAL_DEBIT"),
        F.sum("CREDIT_AMOUNT").cast(TOTAL).alias("TOTAL_CREDIT"),
        F.sum("TRANSACTION_COUNT").alias("TOTAL_TRANSACTIONS"),
    ]
    rows = join_back_summary(t.transactions(), LEDGER_KEYS, totals)
    return rows.select(
        "l_orderkey", "l_linenumber", "TOTAL_DEBIT", "TOTAL_CREDIT", "TOTAL_TRANSACTIONS"
    )
