"""Sources and sinks. Files are first written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.fixedwidth import slice_fields
from ledgerloom.functions.scalars import salt
from ledgerloom.operators.aggregates import total_length
from ledgerloom.operators.balance import aggregate_by_id, decode_lines
from ledgerloom.operators.layout import at_most, spread_by_key
from ledgerloom.operators.quality import require_rows
from ledgerloom.plans.export import run_daily_export, run_full_export
from ledgerloom.queries.registry import query
from ledgerloom.queries.tables import (
    ACCOUNTS,
    CLOSING_DAY,
    OPENING_DAY,
    OTHER_SLOT,
    SQL_ACCOUNTS,
    SQL_LINES,
    SQL_POSTINGS,
    Tables,
    account_code,
    credit,
    debit,
    money,
)
from ledgerloom.sources import files
from ledgerloom.sources.layouts import (
    EXPORT_FULL,
    EXPORT_SHORT,
    FAMILY_MARK,
    NUMBERED_FAMILIES,
    SINGLE_FAMILIES,
    dated_path,
    family_patterns,
)
from ledgerloom.sources.published import read_days
from ledgerloom.sources.workdir import checkpointed, new_folder

BY_ID_SQL = f"""
WITH {SQL_LINES}
SELECT Id, {money(f"sum({debit('READ_MILLI')})")} AS DEBIT_AMOUNT,
  {money(f"sum({credit('READ_MILLI')})")} AS CREDIT_AMOUNT, count(*) AS TRANSACTION_COUNT
FROM lines GROUP BY Id"""

_FIELD = """lpad(CAST(abs({m}) AS VARCHAR), 17, '0')[1:16] ||
  CASE WHEN {m} < 0
  THEN translate(lpad(CAST(abs({m}) AS VARCHAR), 17, '0')[17:17], '0123456789', 'pqrstuvwxy')
  ELSE lpad(CAST(abs({m}) AS VARCHAR), 17, '0')[17:17] END"""
# The 13 fields of every line, built from the postings.
SQL_FIELDS = f"""{SQL_LINES}, slots AS (
  SELECT *, CASE WHEN l_orderkey % 97 = 0
      THEN lpad(CAST(abs(MILLI) AS VARCHAR), 17, '0')[1:16] || '}}'
      ELSE {_FIELD.format(m='MILLI')} END AS own,
    '{OTHER_SLOT}' AS other
  FROM lines), fields AS (
  SELECT strftime(POSTING_DATE, '%y%j') AS txdate,
    lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS journal,
    lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS jrnl,
    BRANCH_CODE AS branch, CURRENCY AS currency, Id AS GLCC,
    'TXN' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS txnCode,
    rpad('POSTING ' || CURRENCY, 24, ' ') AS description,
    strftime(POSTING_DATE, '%y%j') AS txdatetwo,
    CASE WHEN CURRENCY = 'INR' THEN own ELSE other END AS lcyAmt,
    CASE WHEN CURRENCY = 'INR' THEN other ELSE own END AS fcyAmt,
    lpad(CAST(l_orderkey AS VARCHAR), 16, '0') AS acct, 'CBS' AS sourceApp
  FROM slots)"""


@query(
    "src_text_lines",
    f"""WITH {SQL_POSTINGS}
    SELECT CURRENCY AS currency, count(*) AS n_lines, CAST(149 * count(*) AS BIGINT) AS n_chars
    FROM postings GROUP BY 1""",
)
def src_text_lines(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "text")
    t.lines().write.text(folder)
    lines = files.read_lines(t.spark, folder)
    return lines.groupBy(F.substring("value", 48, 3).alias("currency")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


@query("src_multi_glob", BY_ID_SQL)
def src_multi_glob(t: Tables) -> DataFrame:
    names = [f"{FAMILY_MARK}{f}_001.gz" for f in NUMBERED_FAMILIES]
    names += [f"{FAMILY_MARK}{f}.gz" for f in SINGLE_FAMILIES]
    family = F.get(F.array(*[F.lit(n) for n in names]), salt(["value"], len(names)))
    folder = new_folder(t.spark, "families")
    t.lines().withColumn("f", family).write.partitionBy("f").option("compression", "gzip").text(folder)
    return aggregate_by_id(decode_lines(files.read_dealt_lines(t.spark, family_patterns(folder))))


@query(
    "src_dated_path",
    f"""WITH {SQL_POSTINGS}
    SELECT CASE WHEN POSTING_DATE <= DATE '{OPENING_DAY}' THEN DATE '{OPENING_DAY}'
      ELSE DATE '{CLOSING_DAY}' END AS batch_day, count(*) AS n_lines
    FROM postings GROUP BY 1""",
)
def src_dated_path(t: Tables) -> DataFrame:
    base = new_folder(t.spark, "dated")
    postings = t.postings()
    early = F.col("POSTING_DATE") <= F.lit(OPENING_DAY).cast("date")
    batches = {OPENING_DAY: postings.filter(early), CLOSING_DAY: postings.filter(~early)}
    for day, rows in batches.items():
        t.lines(rows).write.text(dated_path(base, day, "lines", "batch"))

    def batch(day: str) -> DataFrame:
        lines = files.read_lines(t.spark, dated_path(base, day, "lines", "*"))
        return lines.select(F.lit(day).cast("date").alias("batch_day"))

    both = batch(OPENING_DAY).unionByName(batch(CLOSING_DAY))
    return both.groupBy("batch_day").agg(F.count(F.lit(1)).alias("n_lines"))


@query("dq_non_empty", "SELECT 'lineitem' AS source, count(*) AS n_rows FROM lineitem")
def dq_non_empty(t: Tables) -> DataFrame:
    rows = require_rows(t.lineitem, "lineitem")
    return rows.agg(F.lit("lineitem").alias("source"), F.count(F.lit(1)).alias("n_rows"))


@query(
    "src_inline_typed",
    f"""WITH {SQL_ACCOUNTS}
    SELECT cgl AS CGL, bal_compare AS BAL_COMPARE, count(*) AS n_rows
    FROM lineitem JOIN accounts ON l_partkey % 20 = k GROUP BY 1, 2""",
)
def src_inline_typed(t: Tables) -> DataFrame:
    schema = T.StructType(
        [T.StructField("CGL", T.StringType()), T.StructField("BAL_COMPARE", T.IntegerType())]
    )
    accounts = t.spark.createDataFrame(ACCOUNTS, schema)
    used = t.lineitem.groupBy(account_code(F.col("l_partkey")).alias("CGL")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return used.join(accounts, "CGL").select("CGL", "BAL_COMPARE", "n_rows")


@query(
    "src_inline_inferred",
    """SELECT status_name, weight, count(*) AS n_orders FROM orders JOIN
    (VALUES ('F', 'finished', 1), ('O', 'open', 2), ('P', 'pending', 3)) s(code, status_name, weight)
    ON o_orderstatus = code GROUP BY 1, 2""",
)
def src_inline_inferred(t: Tables) -> DataFrame:
    status = t.spark.createDataFrame(
        [("F", "finished", 1), ("O", "open", 2), ("P", "pending", 3)],
        ["o_orderstatus", "status_name", "weight"],
    )
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.join(status, "o_orderstatus").select(
        "status_name", F.col("weight").cast("int").alias("weight"), "n_orders"
    )


def _customer_csv(t: Tables) -> str:
    folder = new_folder(t.spark, "csv")
    files.write_csv(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), folder)
    return folder


_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"


@query("src_csv", _CUSTOMER_SQL)
def src_csv(t: Tables) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    return files.read_csv(t.spark, _customer_csv(t), t.customer.select(*columns).schema)


@query(
    "src_csv_inferred",
    """SELECT c_nationkey, count(*) AS n_customers, max(c_acctbal) AS max_acctbal
    FROM customer GROUP BY 1""",
)
def src_csv_inferred(t: Tables) -> DataFrame:
    return (
        files.read_csv(t.spark, _customer_csv(t))
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.max("c_acctbal").alias("max_acctbal"))
    )


@query("src_csv_text", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def src_csv_text(t: Tables) -> DataFrame:
    return files.read_csv_as_text(t.spark, _customer_csv(t)).select("c_custkey", "c_name")


@query("src_json", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def src_json(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    folder = new_folder(t.spark, "json")
    rows.write.json(folder)
    return files.read_json(t.spark, folder, rows.schema)


@query(
    "src_parquet",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def src_parquet(t: Tables) -> DataFrame:
    since = F.lit("1998-01-01").cast("timestamp_ntz")
    return t.orders.filter(F.col("o_orderdate") >= since).select("o_orderkey", "o_totalprice")


@query(
    "sink_parquet_overwrite",
    f"""WITH {SQL_POSTINGS} SELECT BRANCH_CODE, {money(f'sum({debit()})')} AS total_debit,
    count(*) AS n_rows FROM postings GROUP BY 1""",
)
def sink_parquet_overwrite(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "overwrite")
    rows = t.transactions().select("BRANCH_CODE", "DEBIT_AMOUNT")
    files.write_parquet(rows, folder)
    files.write_parquet(rows, folder, max_records=10_000)  # replaces the first
    return (
        t.spark.read.parquet(folder)
        .groupBy("BRANCH_CODE")
        .agg(
            F.sum("DEBIT_AMOUNT").cast("decimal(38,3)").alias("total_debit"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


@query(
    "sink_parquet_partitioned",
    f"""WITH {SQL_POSTINGS}, d AS (SELECT *, CASE WHEN POSTING_DATE <= DATE '{OPENING_DAY}'
      THEN DATE '{OPENING_DAY}' ELSE DATE '{CLOSING_DAY}' END AS export_date FROM postings)
    SELECT export_date, CURRENCY AS currency,
      count(*) * CASE WHEN export_date = DATE '{OPENING_DAY}' THEN 2 ELSE 1 END AS n_rows
    FROM d GROUP BY 1, 2""",
)
def sink_parquet_partitioned(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "partitioned")
    postings = t.postings()
    early = F.col("POSTING_DATE") <= F.lit(OPENING_DAY).cast("date")
    for _ in range(2):  # appended twice: the day's rows double
        run_daily_export(t.lines(postings.filter(early)), folder, OPENING_DAY, append=True)
    for _ in range(2):  # replaced: running the day again changes nothing
        run_daily_export(t.lines(postings.filter(~early)), folder, CLOSING_DAY)
    return (
        read_days(t.spark, folder, "export_date")
        .groupBy("export_date", "currency")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "sink_partition_by_key",
    f"""WITH {SQL_POSTINGS} SELECT CURRENCY, BRANCH_CODE, sum(QUANTITY)::BIGINT AS quantity
    FROM postings GROUP BY 1, 2""",
)
def sink_partition_by_key(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "by-key")
    files.write_partitions(t.postings().select("CURRENCY", "BRANCH_CODE", "QUANTITY"), folder, ["CURRENCY"])
    return (
        t.spark.read.parquet(folder)
        .groupBy("CURRENCY", "BRANCH_CODE")
        .agg(F.sum("QUANTITY").alias("quantity"))
    )


@query(
    "sink_csv",
    """SELECT o_orderstatus, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum
    FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
    GROUP BY 1""",
)
def sink_csv(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "csv-sink")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    files.write_csv(rows, folder)
    files.write_csv(rows.filter(F.col("o_orderstatus") == "F"), folder, mode="append")
    return (
        files.read_csv(t.spark, folder, rows.schema)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))
    )


@query("text_total_length", "SELECT CAST(sum(length(text)) AS BIGINT) AS total_length FROM documents")
def text_total_length(t: Tables) -> DataFrame:
    return total_length(t.documents.select(F.col("text").alias("value")))


@query("export_fields", f"WITH {SQL_FIELDS} SELECT {', '.join(f.name for f in EXPORT_FULL)} FROM fields")
def export_fields(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "export")
    run_full_export(t.full_lines(), folder)
    return t.spark.read.parquet(folder)


@query("fw_slice", f"WITH {SQL_FIELDS} SELECT {', '.join(f.name for f in EXPORT_SHORT)} FROM fields")
def fw_slice(t: Tables) -> DataFrame:
    return t.full_lines().select(*slice_fields(EXPORT_SHORT))


@query(
    "layout_spread_write",
    f"""WITH {SQL_POSTINGS} SELECT BRANCH_CODE, count(*) AS n_rows,
    CAST(sum(MILLI) AS BIGINT) AS milli FROM postings GROUP BY 1""",
)
def layout_spread_write(t: Tables) -> DataFrame:
    """Repartitioned by a salted key, fewer writers, a row limit per file."""
    folder = new_folder(t.spark, "spread")
    rows = t.postings().select("BRANCH_CODE", "l_orderkey", "l_linenumber", "MILLI")
    spread = spread_by_key(rows, 16, "BRANCH_CODE", ["l_orderkey", "l_linenumber"], ways=4)
    files.write_parquet(at_most(spread, 8), folder, max_records=20_000)
    return (
        t.spark.read.parquet(folder)
        .groupBy("BRANCH_CODE")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("MILLI").alias("milli"))
    )


@query(
    "checkpoint_reuse",
    f"""WITH {SQL_POSTINGS}, s AS (SELECT BRANCH_CODE, CURRENCY, CAST(sum(MILLI) AS BIGINT) AS milli
      FROM postings GROUP BY 1, 2)
    SELECT s.BRANCH_CODE, s.CURRENCY, s.milli, largest.milli AS branch_largest
    FROM s JOIN (SELECT BRANCH_CODE, max(milli) AS milli FROM s GROUP BY 1) largest
    USING (BRANCH_CODE)""",
)
def checkpoint_reuse(t: Tables) -> DataFrame:
    """A frame used twice, under two aliases, is computed once."""
    sums = checkpointed(
        t.postings().groupBy("BRANCH_CODE", "CURRENCY").agg(F.sum("MILLI").alias("milli"))
    )
    largest = sums.groupBy("BRANCH_CODE").agg(F.max("milli").alias("branch_largest"))
    joined = sums.alias("s").join(
        largest.alias("l"), F.col("s.BRANCH_CODE") == F.col("l.BRANCH_CODE")
    )
    return joined.select("s.BRANCH_CODE", "s.CURRENCY", "s.milli", "l.branch_largest")
