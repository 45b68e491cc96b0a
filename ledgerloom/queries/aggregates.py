"""Aggregates, windows and quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import percent_rank, running_total, salted_sum_count
from ledgerloom.operators.balance import (
    aggregate_by_id,
    branch_summary,
    decode_lines,
    totals_by,
    validated_totals,
)
from ledgerloom.operators.accounts import active_accounts
from ledgerloom.operators.joins import hot_keys
from ledgerloom.operators.quality import dq_report, null_counts
from ledgerloom.queries.registry import query
from ledgerloom.queries.sources_sinks import BY_ID_SQL
from ledgerloom.queries.tables import (
    SECOND_LAYOUT,
    SQL_POSTINGS,
    Tables,
    credit,
    debit,
    money,
    valid,
)


@query("agg_by_id", BY_ID_SQL)
def agg_by_id(t: Tables) -> DataFrame:
    return aggregate_by_id(decode_lines(t.lines()))


@query("agg_second_layout", BY_ID_SQL)
def agg_second_layout(t: Tables) -> DataFrame:
    """Lines whose amounts have another length, place, sign and number of decimals."""
    return aggregate_by_id(decode_lines(t.second_lines(), SECOND_LAYOUT))


SQL_BY_ACCOUNT = f"""{SQL_POSTINGS}, by_account AS (
  SELECT {valid()} AS VALIDATED_CGL, sum({debit()}) AS d, sum({credit()}) AS c,
    CAST(sum(QUANTITY) AS BIGINT) AS n FROM postings GROUP BY 1)"""


@query(
    "agg_by_account",
    f"""WITH {SQL_BY_ACCOUNT} SELECT VALIDATED_CGL, {money('d')} AS TOTAL_DEBIT,
    {money('c')} AS TOTAL_CREDIT, n AS TOTAL_TRANSACTIONS FROM by_account""",
)
def agg_by_account(t: Tables) -> DataFrame:
    return validated_totals(t.transactions(), active_accounts(t.master()))


@query(
    "summary_by_branch",
    f"""WITH {SQL_POSTINGS} SELECT BRANCH_CODE, CURRENCY, CGL, {money(f'sum({debit()})')} AS TOTAL_DEBIT,
    {money(f'sum({credit()})')} AS TOTAL_CREDIT, count(*) AS ROW_COUNT,
    CAST(sum(QUANTITY) AS BIGINT) AS TOTAL_TRANSACTIONS FROM postings GROUP BY 1, 2, 3""",
)
def summary_by_branch(t: Tables) -> DataFrame:
    return branch_summary(t.transactions())


@query("agg_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def agg_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def _mean(column: str) -> Column:
    return F.sum(column).cast("double") / F.count(column)


@query(
    "agg_stats",
    """WITH o AS (SELECT o_orderpriority, CAST(o_totalprice AS DECIMAL(20,2)) AS price FROM orders)
    SELECT o_orderpriority, count(*) AS n, sum(price) AS total,
    CAST(sum(price) AS DOUBLE) / count(price) AS mean, min(price) AS low, max(price) AS high
    FROM o GROUP BY 1""",
)
def agg_stats(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderpriority", F.col("o_totalprice").cast("decimal(20,2)").alias("price"))
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").cast("decimal(38,2)").alias("total"),
        _mean("price").alias("mean"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
    )


@query(
    "agg_global",
    """SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) / count(o_totalprice) AS mean,
    min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders""",
)
def agg_global(t: Tables) -> DataFrame:
    rows = t.orders.select("o_totalprice", F.col("o_totalprice").cast("decimal(20,2)").alias("price"))
    return rows.agg(
        _mean("price").alias("mean"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
    )


@query("agg_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def agg_row_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "agg_distinct_keys",
    f"WITH {SQL_POSTINGS} SELECT count(DISTINCT BRANCH_CODE || CURRENCY || CGL) AS n_ids FROM postings",
)
def agg_distinct_keys(t: Tables) -> DataFrame:
    ids = t.postings().select(F.concat("BRANCH_CODE", "CURRENCY", "CGL").alias("Id"))
    return ids.agg(F.countDistinct("Id").alias("n_ids"))


@query("agg_distinct", f"WITH {SQL_POSTINGS} SELECT DISTINCT BRANCH_CODE, CURRENCY FROM postings")
def agg_distinct(t: Tables) -> DataFrame:
    return t.postings().select("BRANCH_CODE", "CURRENCY").distinct()


def _described(column: str) -> str:
    number = f"CAST({column} AS DOUBLE)"
    return (
        f"round(CASE summary WHEN 'count' THEN count({column}) WHEN 'mean' THEN avg({number}) "
        f"WHEN 'stddev' THEN stddev_samp({number}) WHEN 'min' THEN min({number}) "
        f"ELSE max({number}) END, 2) AS {column}"
    )


@query(
    "agg_describe",
    f"""WITH {SQL_BY_ACCOUNT}, r AS (SELECT VALIDATED_CGL, {money('d')} AS TOTAL_DEBIT,
      {money('c')} AS TOTAL_CREDIT, n AS TOTAL_TRANSACTIONS FROM by_account),
    s(summary) AS (VALUES ('count'), ('mean'), ('stddev'), ('min'), ('max'))
    SELECT summary, {_described('VALIDATED_CGL')}, {_described('TOTAL_DEBIT')},
      {_described('TOTAL_CREDIT')}, {_described('TOTAL_TRANSACTIONS')}
    FROM r, s GROUP BY summary""",
)
def agg_describe(t: Tables) -> DataFrame:
    """The text that ``describe`` gives, as numbers rounded to cents."""
    described = agg_by_account(t).describe()
    columns = [c for c in described.columns if c != "summary"]
    return described.select(
        "summary", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in columns]
    )


@query(
    "dq_null_counts",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]
    )
    + " FROM events",
)
def dq_null_counts(t: Tables) -> DataFrame:
    return null_counts(t.events)


@query(
    "dq_report",
    """SELECT 'non_empty' AS check_name, CAST(count(*) = 0 AS BIGINT) AS violations FROM lineitem
    UNION ALL SELECT 'not_null:l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
    UNION ALL SELECT 'not_null:l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'range:l_quantity', count(*) FILTER (l_quantity NOT BETWEEN 1 AND 40) FROM lineitem
    UNION ALL SELECT 'range:l_discount', count(*) FILTER (l_discount NOT BETWEEN 0 AND 1) FROM lineitem""",
)
def dq_report_query(t: Tables) -> DataFrame:
    return dq_report(
        t.lineitem,
        not_null=["l_orderkey", "l_shipdate"],
        ranges={"l_quantity": (1, 40), "l_discount": (0, 1)},
    )


@query(
    "agg_salted",
    f"""WITH {SQL_POSTINGS} SELECT CURRENCY, CAST(sum(MILLI) AS BIGINT) AS total, count(*) AS n
    FROM postings GROUP BY 1""",
)
def agg_salted(t: Tables) -> DataFrame:
    return salted_sum_count(t.postings(), "CURRENCY", "MILLI", ["l_orderkey", "l_linenumber"])


@query(
    "skew_keys",
    f"""WITH {SQL_POSTINGS}, c AS (SELECT CURRENCY, count(*) AS n FROM postings GROUP BY 1)
    SELECT CURRENCY, n, CAST(n AS DOUBLE) / (SELECT count(*) FROM postings) AS share FROM c
    WHERE CAST(n AS DOUBLE) / (SELECT count(*) FROM postings) > 0.2""",
)
def skew_keys(t: Tables) -> DataFrame:
    return hot_keys(t.postings(), ["CURRENCY"], 0.2)


@query(
    "agg_by_key_day",
    """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n,
    sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2""",
)
def agg_by_key_day(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"),
    )


@query(
    "win_running_total",
    """SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18,2)))
      OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST) AS DECIMAL(38,2)) AS RunningTotal FROM events""",
)
def win_running_total(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    totals = running_total(rows, "user_id", "ts", "value")
    return totals.select("event_id", "user_id", F.col("RunningTotal").cast("decimal(38,2)"))


@query(
    "win_percent_rank",
    f"""WITH {SQL_POSTINGS} SELECT l_orderkey, l_linenumber, CURRENCY,
    percent_rank() OVER (PARTITION BY CURRENCY ORDER BY MILLI NULLS FIRST) AS percent_rank FROM postings""",
)
def win_percent_rank(t: Tables) -> DataFrame:
    # Three keys hold everything.
    rows = t.postings().select("l_orderkey", "l_linenumber", "CURRENCY", "MILLI")
    return percent_rank(rows, "CURRENCY", "MILLI").drop("MILLI")


@query(
    "agg_total_by_currency",
    f"""WITH {SQL_POSTINGS} SELECT CURRENCY, {money(f'sum({debit()})')} AS TOTAL_DEBIT,
    {money(f'sum({credit()})')} AS TOTAL_CREDIT, CAST(sum(QUANTITY) AS BIGINT) AS TOTAL_TRANSACTIONS
    FROM postings GROUP BY 1""",
)
def agg_total_by_currency(t: Tables) -> DataFrame:
    return totals_by(t.transactions(), "CURRENCY")
