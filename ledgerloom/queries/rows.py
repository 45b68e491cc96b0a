"""Projections, filters, scalar expressions, sorts and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import (
    DIGITS,
    NEGATIVE_LAST_CHARS,
    credit_of,
    debit_of,
    overpunch_amount,
    trailing_sign_amount,
)
from ledgerloom.functions.fixedwidth import currency_slice, split_key
from ledgerloom.functions.scalars import days_before, grade, grade_udf, map_lookup, on_day
from ledgerloom.operators.balance import decode_lines, rejected_lines
from ledgerloom.queries.registry import query
from ledgerloom.queries.sources_sinks import SQL_FIELDS
from ledgerloom.queries.tables import (
    SQL_LINES,
    SQL_POSTINGS,
    Tables,
    credit,
    debit,
    money,
)
from ledgerloom.sources.layouts import FEEDS, KEY_FIELDS, GlLayout

LAYOUT = GlLayout()

# --- projections -----------------------------------------------------------


@query(
    "fw_currency_slice",
    f"""WITH {SQL_FIELDS} SELECT GLCC AS Id,
    CASE WHEN currency = 'INR' THEN lcyAmt ELSE fcyAmt END AS amount_field FROM fields""",
)
def fw_currency_slice(t: Tables) -> DataFrame:
    return _amount_fields(t.lines())


def _amount_fields(lines: DataFrame) -> DataFrame:
    line = F.col("value")
    return lines.select(
        LAYOUT.key.of(line).alias("Id"),
        currency_slice(
            line, LAYOUT.currency, LAYOUT.local_amount, LAYOUT.foreign_amount, LAYOUT.local_currency
        ).alias("amount_field"),
    )


@query(
    "fw_variable_slice",
    """SELECT ' ' || CAST(abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS VARCHAR) || '00' AS amount,
    CASE WHEN round(c_acctbal * 100) < 0 THEN '-' ELSE '+' END AS sign FROM customer""",
)
def fw_variable_slice(t: Tables) -> DataFrame:
    feed, line = FEEDS["GLCC"], F.col("value")
    return t.feed_lines()["GLCC"].select(
        feed.amount.of(line).alias("amount"), feed.sign.of(line).alias("sign")
    )


@query(
    "key_split",
    f"""WITH {SQL_POSTINGS} SELECT BRANCH_CODE, CURRENCY, CGL, count(*) AS n_rows
    FROM postings GROUP BY 1, 2, 3""",
)
def key_split(t: Tables) -> DataFrame:
    ids = t.lines().groupBy(LAYOUT.key.of(F.col("value")).alias("Id")).agg(F.count(F.lit(1)).alias("n_rows"))
    return ids.select(*split_key(F.col("Id"), KEY_FIELDS), "n_rows")


@query(
    "proj_with_columns",
    """SELECT c_custkey, c_name, c_acctbal, c_acctbal * CAST(0.1 AS DOUBLE) AS bonus,
    'C-' || c_mktsegment AS segment FROM customer""",
)
def proj_with_columns(t: Tables) -> DataFrame:
    return (
        t.customer.select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("segment"))
        .withColumns(
            {
                "bonus": F.col("c_acctbal") * 0.1,
                "segment": F.concat(F.lit("C-"), F.col("segment")),  # replaced
            }
        )
    )


@query("proj_drop", "SELECT s_suppkey, s_name FROM supplier")
def proj_drop(t: Tables) -> DataFrame:
    return t.supplier.drop("s_nationkey", "s_acctbal", "no_such_column")


@query(
    "proj_rename",
    "SELECT n_nationkey AS nation_id, n_name AS nation, count(*) AS n_customers "
    "FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1, 2",
)
def proj_rename(t: Tables) -> DataFrame:
    nations = t.nation.withColumnRenamed("n_nationkey", "nation_id").withColumnRenamed("n_name", "nation")
    used = t.customer.groupBy(F.col("c_nationkey").alias("nation_id")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    return nations.join(used, "nation_id").select("nation_id", "nation", "n_customers")


@query("proj_select", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def proj_select(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "proj_arith",
    """SELECT s_suppkey, s_acctbal * CAST(0.1 AS DOUBLE) AS bonus,
    s_acctbal * CAST(0.8 AS DOUBLE) AS after_tax, s_acctbal * CAST(1.1 AS DOUBLE) AS raised
    FROM supplier""",
)
def proj_arith(t: Tables) -> DataFrame:
    base = F.col("s_acctbal")
    return t.supplier.select(
        "s_suppkey",
        (base * 0.1).alias("bonus"),
        (base * 0.8).alias("after_tax"),
        (base * 1.1).alias("raised"),
    )


# --- filters ---------------------------------------------------------------


@query("filter_cmp", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def filter_cmp(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


@query(
    "filter_bool",
    """SELECT o_orderkey FROM orders WHERE (o_totalprice > 250000 AND o_orderstatus = 'F')
    OR o_orderpriority = '1-URGENT'""",
)
def filter_bool(t: Tables) -> DataFrame:
    dear = (F.col("o_totalprice") > 250000) & (F.col("o_orderstatus") == "F")
    return t.orders.filter(dear | (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey")


@query(
    "filter_day",
    "SELECT event_id, user_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'",
)
def filter_day(t: Tables) -> DataFrame:
    return t.events.filter(on_day(F.col("ts"), "2024-01-03")).select("event_id", "user_id", "ts")


@query(
    "filter_isin",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
)
def filter_isin(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@query(
    "filter_prefix",
    f"WITH {SQL_POSTINGS} SELECT l_orderkey, l_linenumber, CGL FROM postings WHERE CGL LIKE '5%'",
)
def filter_prefix(t: Tables) -> DataFrame:
    rows = t.postings().select("l_orderkey", "l_linenumber", "CGL")
    return rows.filter(F.col("CGL").startswith("5"))


@query(
    "filter_null",
    f"WITH {SQL_LINES} SELECT Id, count(*) AS n_rejected FROM lines WHERE READ_MILLI IS NULL GROUP BY 1",
)
def filter_null(t: Tables) -> DataFrame:
    rejected = rejected_lines(t.lines()).select(LAYOUT.key.of(F.col("value")).alias("Id"))
    return rejected.groupBy("Id").agg(F.count(F.lit(1)).alias("n_rejected"))


@query(
    "filter_rlike",
    f"""WITH {SQL_FIELDS}, f AS (SELECT GLCC AS Id,
      CASE WHEN currency = 'INR' THEN lcyAmt ELSE fcyAmt END AS amount_field FROM fields)
    SELECT * FROM f WHERE regexp_matches(amount_field, '[p-y]$')""",
)
def filter_rlike(t: Tables) -> DataFrame:
    return _amount_fields(t.lines()).filter(F.col("amount_field").rlike("[p-y]$"))


# --- scalar expressions ----------------------------------------------------


@query("str_concat", "SELECT c_custkey, c_name || ' / ' || c_mktsegment AS label FROM customer")
def str_concat(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.concat("c_name", F.lit(" / "), "c_mktsegment").alias("label")
    )


@query(
    "str_trim_length",
    """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars,
    CAST(length(trim(text, ' ')) AS INTEGER) AS n_trimmed FROM documents""",
)
def str_trim_length(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.length("text").alias("n_chars"), F.length(F.trim("text")).alias("n_trimmed")
    )


@query(
    "decode_overpunch",
    f"WITH {SQL_LINES} SELECT Id, CAST({money('READ_MILLI')} AS DECIMAL(22,3)) AS Amount FROM lines",
)
def decode_overpunch(t: Tables) -> DataFrame:
    return fw_currency_slice(t).select("Id", overpunch_amount(F.col("amount_field")).alias("Amount"))


@query(
    "debit_credit_split",
    f"""WITH {SQL_LINES} SELECT Id, CAST({money(debit('READ_MILLI'))} AS DECIMAL(22,3)) AS DEBIT_AMOUNT,
    CAST({money(credit('READ_MILLI'))} AS DECIMAL(22,3)) AS CREDIT_AMOUNT FROM lines""",
)
def debit_credit_split(t: Tables) -> DataFrame:
    amount = F.col("Amount")
    return decode_lines(t.lines()).select(
        "Id", debit_of(amount).alias("DEBIT_AMOUNT"), credit_of(amount).alias("CREDIT_AMOUNT")
    )


@query(
    "decode_trailing_sign",
    """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END
      * CAST(round(o_totalprice * 1000) AS DECIMAL(20,0)) * CAST(0.001 AS DECIMAL(4,3))
      AS DECIMAL(28,8)) AS Amount
    FROM orders""",
)
def decode_trailing_sign(t: Tables) -> DataFrame:
    feed, line = FEEDS["INV"], F.col("value")
    return t.feed_lines(keep=["o_orderkey"])["INV"].select(
        "o_orderkey",
        trailing_sign_amount(feed.amount.of(line), feed.sign.of(line), feed.decimals).alias("Amount"),
    )


_LETTERS = dict(zip(NEGATIVE_LAST_CHARS, DIGITS))


@query(
    "map_lookup",
    f"""WITH {SQL_FIELDS}, s AS (SELECT right(lcyAmt, 1) AS sign_char FROM fields)
    SELECT sign_char, CASE WHEN sign_char BETWEEN 'p' AND 'y'
      THEN translate(sign_char, 'pqrstuvwxy', '0123456789') END AS digit, count(*) AS n_rows
    FROM s GROUP BY 1, 2""",
)
def map_lookup_query(t: Tables) -> DataFrame:
    last = F.substring(LAYOUT.local_amount.of(F.col("value")), 17, 1)
    counts = t.lines().groupBy(last.alias("sign_char")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select("sign_char", map_lookup(F.col("sign_char"), _LETTERS).alias("digit"), "n_rows")


@query(
    "str_regexp_extract",
    "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages",
)
def str_regexp_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'large'
      WHEN o_totalprice >= 100000 THEN CASE WHEN o_orderstatus = 'F' THEN 'medium done' ELSE 'medium' END
      ELSE 'small' END AS size_class FROM orders""",
)
def case_when(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    medium = F.when(F.col("o_orderstatus") == "F", "medium done").otherwise("medium")
    size = F.when(price >= 400000, "large").when(price >= 100000, medium).otherwise("small")
    return t.orders.select("o_orderkey", size.alias("size_class"))


@query(
    "expr_coalesce",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, 'open')
    AS priority FROM orders""",
)
def expr_coalesce(t: Tables) -> DataFrame:
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", F.coalesce(done, F.lit("open")).alias("priority"))


@query(
    "expr_casts",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20,4)) AS price_decimal,
    CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderstatus = 'F' AS INTEGER) AS is_done,
    CAST(o_orderdate AS DATE) AS order_day,
    TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS priority_no,
    TRY_CAST(o_orderpriority AS BIGINT) AS no_number FROM orders""",
)
def expr_casts(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(20,4)").alias("price_decimal"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_done"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.substring("o_orderpriority", 1, 1).try_cast("bigint").alias("priority_no"),
        F.col("o_orderpriority").try_cast("bigint").alias("no_number"),
    )


@query(
    "date_parse",
    """SELECT o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::DATE AS parsed,
    o_orderdate AS parsed_ts FROM orders""",
)
def date_parse(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey",
        F.to_date(F.to_date(text, "dd/MM/yyyy")).alias("parsed"),
        F.to_timestamp(text, "dd/MM/yyyy").cast("timestamp_ntz").alias("parsed_ts"),
    )


@query(
    "date_lookback",
    """SELECT o_orderkey, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS prev_day,
    CAST(o_orderdate - INTERVAL 8 DAY AS DATE) AS prev_week,
    strftime(o_orderdate - INTERVAL 9 DAY, '%Y-%m-%d') AS nine_days_before FROM orders""",
)
def date_lookback(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        days_before(day, 1).alias("prev_day"),
        days_before(day, 8).alias("prev_week"),
        F.date_format(days_before(day, 9), "yyyy-MM-dd").alias("nine_days_before"),
    )


_GRADE_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity * 2 >= 90 THEN 'A'
  WHEN l_quantity * 2 >= 80 THEN 'B' WHEN l_quantity * 2 >= 70 THEN 'C' ELSE 'F' END AS grade
  FROM lineitem"""


@query("grade_case", _GRADE_SQL)
def grade_case(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", grade(F.col("l_quantity") * 2).alias("grade")
    )


@query("grade_udf", _GRADE_SQL)
def grade_by_udf(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", grade_udf(F.col("l_quantity") * 2).alias("grade")
    )


@query(
    "sql_view",
    "SELECT o_orderkey, o_totalprice * CAST(1.1 AS DOUBLE) AS raised FROM orders "
    "WHERE o_totalprice > 100000",
)
def sql_view(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders_of_sql_view")
    return t.spark.sql(
        "SELECT o_orderkey, o_totalprice * 1.1D AS raised FROM orders_of_sql_view "
        "WHERE o_totalprice > 100000"
    )


# --- sorts and limits ------------------------------------------------------


@query(
    "sort_multi",
    "SELECT o_orderpriority, o_orderdate, o_orderkey FROM orders ORDER BY 1, 2, 3",
)
def sort_multi(t: Tables) -> DataFrame:
    # The unique last key lets a range sort split a hot priority.
    return t.orders.select("o_orderpriority", "o_orderdate", "o_orderkey").orderBy(
        "o_orderpriority", "o_orderdate", "o_orderkey"
    )


@query("sort_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_desc(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query(
    "limit_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def limit_n(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "topk_by_total",
    """SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS total FROM orders
    GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 1""",
)
def topk_by_total(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("decimal(38,2)").alias("total")
    )
    return totals.orderBy(F.desc("total"), "o_custkey").limit(1)


# --- unions ----------------------------------------------------------------

_UNION_SQL = """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
  UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier"""


@query("union_by_position", _UNION_SQL)
def union_by_position(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
    )
    return customers.union(t.supplier.select("s_name", "s_nationkey", "s_acctbal"))


@query("union_by_name", _UNION_SQL)
def union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").cast("string").alias("acctbal"),  # to be aligned
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("nationkey"),
    )
    aligned = suppliers.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in customers.schema]
    )
    return customers.unionByName(aligned)
