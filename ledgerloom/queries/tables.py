"""The given tables, and ledger data that Spark derives from all of their rows.

Every derivation exists twice: as DataFrame code and as SQL text for the oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import overpunch_field
from ledgerloom.functions.fixedwidth import Field
from ledgerloom.functions.types import AMOUNT
from ledgerloom.sources.layouts import GlLayout

# Account codes of the derived ledger: code and balance-compare flag, by key % 20.
ACCOUNTS = [
    ("1204500001", 1),
    ("6200123456", 1),
    ("6363123456", 1),
    ("4363000001", 1),
    ("4100000001", 0),
    ("6100000001", 1),
    ("7000000001", 1),
    ("8000000001", 0),
    ("5001234567", 1),
    ("5106505001", 0),
    ("2148000001", 1),
    ("2249000001", 1),
    ("2111000001", 1),
    ("1106505002", 1),
    ("1000505003", 1),
    ("1100505001", 1),
    ("1106505001", 1),
    ("2028070603", 1),
    ("9999999999", 0),
    ("2014070692", 1),
]

# Lines posted from this day on are "today", earlier ones the previous balance.
OPENING_DAY = "1998-06-30"
CLOSING_DAY = "2001-12-31"

# Another layout of ledger lines.
SECOND_LAYOUT = GlLayout(
    currency=Field("currency_code", 1, 3),
    key=Field("Id", 10, 18),
    local_amount=Field("lcyAmt", 40, 15),
    foreign_amount=Field("fcyAmt", 60, 15),
    local_sign=Field("lcySign", 80, 1),
    foreign_sign=Field("fcySign", 85, 1),
    decimals=2,
)

# What a ledger line has in the slot that its currency does not select.
OTHER_SLOT = "0000000000012345p"


def account_code(key: Column) -> Column:
    codes = F.array(*[F.lit(code) for code, _ in ACCOUNTS])
    return F.get(codes, F.pmod(key, F.lit(len(ACCOUNTS))).cast("int"))


def account_flag(key: Column) -> Column:
    flags = F.array(*[F.lit(flag) for _, flag in ACCOUNTS])
    return F.get(flags, F.pmod(key, F.lit(len(ACCOUNTS))).cast("int"))


def branch_code(key: Column) -> Column:
    number = F.pmod(key, F.lit(20))
    return (
        F.when(number == 0, "01999")
        .when(number == 1, "03973")
        .otherwise(F.lpad(number.cast("string"), 5, "0"))
    )


def thousandths(amount: Column) -> Column:
    return F.round(amount * 1000).cast("bigint")


def period_end(day: Column) -> Column:
    """Last day of the quarter."""
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def master(self) -> DataFrame:
        """Account master with one row per part, hence with many duplicates."""
        key = F.col("p_partkey")
        return self.part.select(
            account_code(key).alias("CGL_NUMBER"), account_flag(key).alias("BAL_COMPARE")
        )

    def postings(self) -> DataFrame:
        """One posting per line item; MILLI is the signed amount in thousandths."""
        amount = thousandths(F.col("l_extendedprice"))
        return self.lineitem.select(
            "l_orderkey",
            "l_linenumber",
            branch_code(F.col("l_suppkey")).alias("BRANCH_CODE"),
            F.when(F.col("l_returnflag") == "N", "INR")
            .when(F.col("l_returnflag") == "A", "USD")
            .otherwise("EUR")
            .alias("CURRENCY"),
            account_code(F.col("l_partkey")).alias("CGL"),
            F.when(F.col("l_linestatus") == "F", -amount).otherwise(amount).alias("MILLI"),
            F.col("l_quantity").cast("bigint").alias("QUANTITY"),
            F.col("l_shipdate").cast("date").alias("POSTING_DATE"),
        )

    def lines(self, postings: DataFrame | None = None) -> DataFrame:
        """The postings as ledger lines of 149 characters: currency, Id, amounts.

        The slot that the currency does not select holds another amount, and an
        order key divisible by 97 gives a line with a bad sign character.
        """
        postings = self.postings() if postings is None else postings
        parts = [
            F.lit(" " * 47),
            F.col("CURRENCY"),  # 48
            F.concat("BRANCH_CODE", "CURRENCY", "CGL"),  # 51
            F.lit(" " * 47),
            self._amount_slots(),  # 116 and 133
        ]
        return postings.select(F.concat(*parts).alias("value"))

    def full_lines(self) -> DataFrame:
        """The same with all 13 fields, 178 characters."""
        order, item = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
        parts = [
            F.lit("   "),
            F.date_format("POSTING_DATE", "yyDDD"),  # 4
            F.lit(" " * 19),
            F.lpad(order, 9, "0"),  # 28
            F.lpad(item, 2, "0"),  # 37
            F.lit("   "),
            F.col("BRANCH_CODE"),  # 42
            F.lit(" "),
            F.col("CURRENCY"),  # 48
            F.concat("BRANCH_CODE", "CURRENCY", "CGL"),  # 51
            F.lit(" " * 7),
            F.concat(F.lit("TXN"), F.lpad(item, 3, "0")),  # 76
            F.rpad(F.concat(F.lit("POSTING "), "CURRENCY"), 24, " "),  # 82
            F.lit(" " * 5),
            F.date_format("POSTING_DATE", "yyDDD"),  # 111
            self._amount_slots(),  # 116 and 133
            F.lit(" " * 10),
            F.lpad(order, 16, "0"),  # 160
            F.lit("CBS"),  # 176
        ]
        return self.postings().select(F.concat(*parts).alias("value"))

    @staticmethod
    def _amount_slots() -> Column:
        field = overpunch_field(F.col("MILLI"))
        bad = F.concat(F.substring(field, 1, 16), F.lit("}"))
        own = F.when(F.col("l_orderkey") % 97 == 0, bad).otherwise(field)
        other = F.lit(OTHER_SLOT)
        return F.when(F.col("CURRENCY") == "INR", F.concat(own, other)).otherwise(
            F.concat(other, own)
        )

    def second_lines(self) -> DataFrame:
        """The postings as lines of `SECOND_LAYOUT`, in hundredths: the character with the last
        digit and the sign stands away from its amount, whose own last character means nothing."""
        field = overpunch_field((F.col("MILLI") / 10).cast("bigint"))
        last = F.when(F.col("l_orderkey") % 97 == 0, "}").otherwise(F.substring(field, 17, 1))
        amount = F.concat(F.substring(field, 3, 14), F.lit("?"))
        local = F.col("CURRENCY") == "INR"
        other, mark = F.lit("00000000012345?"), F.lit("p")
        parts = [
            F.col("CURRENCY"),  # 1
            F.lit(" " * 6),
            F.concat("BRANCH_CODE", "CURRENCY", "CGL"),  # 10
            F.lit(" " * 12),
            F.when(local, amount).otherwise(other),  # 40
            F.lit(" " * 5),
            F.when(local, other).otherwise(amount),  # 60
            F.lit(" " * 5),
            F.when(local, last).otherwise(mark),  # 80
            F.lit(" " * 4),
            F.when(local, mark).otherwise(last),  # 85
        ]
        return self.postings().select(F.concat(*parts).alias("value"))

    def transactions(self) -> DataFrame:
        """One transaction per posting with debit and credit amounts."""
        amount = (F.col("MILLI").cast("decimal(18,0)") * F.expr("0.001BD")).cast(AMOUNT)
        zero = F.lit(0).cast(AMOUNT)
        return self.postings().select(
            "l_orderkey",
            "l_linenumber",
            "BRANCH_CODE",
            "CURRENCY",
            "CGL",
            F.when(amount > 0, amount).otherwise(zero).alias("DEBIT_AMOUNT"),
            F.when(amount < 0, amount).otherwise(zero).alias("CREDIT_AMOUNT"),
            F.col("QUANTITY").alias("TRANSACTION_COUNT"),
            "POSTING_DATE",
        )

    def deltas(self) -> DataFrame:
        """Posted amounts with the quarter's last day as BALANCE_DATE."""
        return self.transactions().select(
            "BRANCH_CODE",
            "CURRENCY",
            "CGL",
            period_end(F.col("POSTING_DATE")).alias("BALANCE_DATE"),
            (F.col("DEBIT_AMOUNT") + F.col("CREDIT_AMOUNT")).alias("BALANCE"),
            "l_linenumber",
        )

    def feed_lines(self, keep: list[str] = ()) -> dict[str, DataFrame]:
        """Trailing-sign lines: INV from orders, BOR from line items, GLCC from customers.

        ``keep`` names columns of orders to carry next to the INV lines.
        """
        inv = self.orders.select(
            *keep,
            F.concat(
                branch_code(F.col("o_custkey")),
                F.when(F.col("o_orderpriority") < "3", "INR").otherwise("USD"),
                account_code(F.col("o_orderkey")),
            ).alias("Id"),
            thousandths(F.col("o_totalprice")).cast("string").alias("digits"),
            # A pending order gets a sign that means nothing.
            F.when(F.col("o_orderstatus") == "F", "-")
            .when(F.col("o_orderstatus") == "O", "+")
            .otherwise("*")
            .alias("sign"),
        )
        bor = self.postings().select(
            F.concat("BRANCH_CODE", "CURRENCY", "CGL").alias("Id"),
            F.abs("MILLI").cast("string").alias("digits"),
            F.when(F.col("MILLI") < 0, "-").otherwise("+").alias("sign"),
        )
        cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
        glcc = self.customer.select(
            F.concat(
                branch_code(F.col("c_nationkey")), F.lit("EUR"), account_code(F.col("c_custkey"))
            ).alias("Id"),
            F.concat(F.abs(cents).cast("string"), F.lit("00")).alias("digits"),
            F.when(cents < 0, "-").otherwise("+").alias("sign"),
        )

        def line(*parts: Column) -> Column:
            return F.concat(*parts).alias("value")

        digits, sign, key = F.col("digits"), F.col("sign"), F.col("Id")
        return {
            "INV": inv.select(
                *keep,
                line(F.lit(" " * 29), F.lpad(digits, 17, " "), sign, F.lit(" " * 152), key),
            ),
            "BOR": bor.select(
                line(F.lit(" " * 26), F.lpad(digits, 17, "0"), sign, F.lit(" " * 60), key)
            ),
            "GLCC": glcc.select(line(key, F.lit(" " * 5), F.lit(" "), digits, sign)),
        }


# --- the same derivations as SQL -------------------------------------------

_ACCOUNT_VALUES = ", ".join(f"({k}, '{code}', {flag})" for k, (code, flag) in enumerate(ACCOUNTS))


def sql_branch(key: str) -> str:
    return (
        f"CASE ({key}) % 20 WHEN 0 THEN '01999' WHEN 1 THEN '03973' "
        f"ELSE lpad(CAST(({key}) % 20 AS VARCHAR), 5, '0') END"
    )


SQL_ACCOUNTS = f"accounts(k, cgl, bal_compare) AS (VALUES {_ACCOUNT_VALUES})"
SQL_MASTER = (
    f"{SQL_ACCOUNTS}, master AS (SELECT DISTINCT cgl AS CGL FROM part "
    "JOIN accounts ON p_partkey % 20 = k WHERE bal_compare = 1)"
)
SQL_POSTINGS = f"""{SQL_MASTER}, postings AS (
  SELECT l_orderkey, l_linenumber, {sql_branch('l_suppkey')} AS BRANCH_CODE,
    CASE l_returnflag WHEN 'N' THEN 'INR' WHEN 'A' THEN 'USD' ELSE 'EUR' END AS CURRENCY,
    cgl AS CGL,
    CAST(round(l_extendedprice * 1000) AS BIGINT)
      * CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END AS MILLI,
    CAST(l_quantity AS BIGINT) AS QUANTITY,
    CAST(l_shipdate AS DATE) AS POSTING_DATE
  FROM lineitem JOIN accounts ON l_partkey % 20 = k)"""


def money(milli: str) -> str:
    """Thousandths as decimal(38,3), without division."""
    return f"CAST(CAST({milli} AS DECIMAL(32,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(38,3))"


def debit(milli: str = "MILLI") -> str:
    return f"CASE WHEN {milli} > 0 THEN {milli} ELSE 0 END"


def credit(milli: str = "MILLI") -> str:
    return f"CASE WHEN {milli} < 0 THEN {milli} ELSE 0 END"


# The amount a line decodes to: NULL for a bad sign character.
SQL_LINES = f"""{SQL_POSTINGS}, lines AS (
  SELECT *, BRANCH_CODE || CURRENCY || CGL AS Id,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE MILLI END AS READ_MILLI
  FROM postings)"""

SQL_VALID = (
    "CASE WHEN {c} IN (SELECT CGL FROM master) THEN {c} "
    "WHEN {c} LIKE '5%' THEN '5000000000' ELSE '1111111111' END"
)


def valid(column: str = "CGL") -> str:
    return SQL_VALID.format(c=column)


SQL_PERIOD_END = "last_day(CAST(date_trunc('quarter', POSTING_DATE) + INTERVAL 2 MONTH AS DATE))"
