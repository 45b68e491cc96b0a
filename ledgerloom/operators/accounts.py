"""Account validation and HEAD classification."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.types import LEDGER_KEYS
from ledgerloom.operators.joins import (
    BROADCAST_ROWS,
    fits_broadcast,
    join_group_values,
    left_join,
    lookup_join,
    with_exists_flag,
)
from ledgerloom.sources.workdir import checkpointed

# Accounts that stand in for unknown ones.
UNKNOWN_MEMO = "5000000000"
UNKNOWN_OTHER = "1111111111"


def active_accounts(master: DataFrame) -> DataFrame:
    """Distinct accounts with the balance-compare flag set, as column CGL."""
    return (
        master.filter(F.col("BAL_COMPARE") == 1).select(F.col("CGL_NUMBER").alias("CGL")).distinct()
    )


def validated_account(is_valid: Column) -> Column:
    cgl = F.col("CGL")
    return (
        F.when(is_valid, cgl)
        .when(cgl.startswith("5"), UNKNOWN_MEMO)
        .otherwise(UNKNOWN_OTHER)
    )


def validate_accounts(
    df: DataFrame, accounts: DataFrame, into: str = "CGL", **options
) -> DataFrame:
    """Replaces unknown account codes; ``accounts`` has a column CGL.

    The default keeps the schema and replaces CGL in place.
    """
    columns = [*df.columns, *([into] if into not in df.columns else [])]
    flagged = with_exists_flag(df, accounts, "CGL", "_known", **options)
    return flagged.withColumn(into, validated_account(F.col("_known").isNotNull())).select(*columns)


# --- HEAD by ordered rules -------------------------------------------------

# Fixed values. The first row that holds names the HEAD: branches, LIKE pattern of
# the account, currency, HEAD; None matches anything.
LHO_BRANCHES = ["03973", "03974", "03975", "03976", "04030", "04425", "04454", "06939"]
HEAD_RULES = [
    (["01999"], None, None, "CAO"),
    (None, "________9%", None, "PROVISION"),
    (None, "1204%", None, "CASH"),
    (None, "62%", None, "AUCA"),
    (None, "6363%", None, "CTA 6363"),
    (None, "4363%", None, "CTA 4363"),
    (None, "4%", None, "CTA"),
    (None, "6%", None, "CTA"),
    (None, "7%", None, "I/E"),
    (None, "8%", None, "I/E"),
    (None, "5%", "INR", "MEMO"),
    (None, "5%", None, "FC MEMO"),
    (None, "2148%", "INR", "BGL"),
    (None, "2148%", None, "FC"),
    (None, "2249%", None, "INCA"),
    (None, "2111", None, "PPF"),
    (None, "2115", None, "PPF"),
    (None, "2060", None, "PPF"),
    (LHO_BRANCHES, "1106505002", None, "LHO"),
    (None, "1106505002", None, "BCGA"),
    (None, "1000505003", None, "MIGRATION"),
    (None, "1100505001", None, "LHO"),
    (None, "1%", "INR", "LOAN"),
    (None, "1%", None, "FC"),
]
DEFAULT_RULES = [(None, None, "INR", "DEPOSITS"), (None, None, None, "FC")]


def _first_match(rules: list[tuple[list[Column], str]], fallback: Column) -> Column:
    """One CASE: the value of the first rule whose conditions all hold."""
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for conditions, name in rules:
        case = case.when(reduce(lambda a, b: a & b, conditions, F.lit(True)), name)
    return case.otherwise(fallback)


def head_by_case(ppf_as_prefix: bool = False, with_default: bool = False) -> Column:
    """HEAD of BRANCH_CODE, CURRENCY, CGL by the ordered rules.

    No match gives NULL, or DEPOSITS / FC ``with_default``. PPF compares the whole
    code, or its first four digits with ``ppf_as_prefix``.
    """
    rules = []
    for branches, pattern, currency, head in HEAD_RULES + (DEFAULT_RULES if with_default else []):
        if head == "PPF" and ppf_as_prefix:
            pattern += "%"
        conditions = []
        if branches is not None:
            conditions.append(F.col("BRANCH_CODE").isin(branches))
        if pattern is not None:
            conditions.append(F.col("CGL").like(pattern))
        if currency is not None:
            conditions.append(F.col("CURRENCY") == currency)
        rules.append((conditions, head))
    return _first_match(rules, F.lit(None).cast("string"))


def head_fallback() -> Column:
    cgl = F.col("CGL")
    return F.when(cgl.startswith("5"), "MEMO").when(cgl.startswith("1"), "LOAN").otherwise("OTHER")


# --- HEAD by a rule table --------------------------------------------------

UNCLASSIFIED = "UNCLASSIFIED"
_GROUP = ["_branch", "_currency"]


def _form(value: Column) -> Column:
    """'' for any; a present value gets a '=' in front."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def rule_trie(rules: DataFrame) -> DataFrame:
    """The rule table as one prefix trie for each (branch or any, currency or any).

    ``nodes`` are a trie's prefixes in order, each with its path: the prefixes from the
    root on that have a rule, by their length and with the rule that wins among equals.
    """
    best = rules.groupBy(
        _form(F.col("branch_code")).alias("_branch"),
        _form(F.col("currency")).alias("_currency"),
        _form(F.col("cgl_prefix")).alias("_prefix"),
    ).agg(F.min(F.struct("priority", "head_category")).alias("rule"))
    above = best.select(
        *_GROUP,
        "_prefix",
        F.explode(F.transform(F.sequence(F.lit(0), F.length("_prefix")), lambda n: F.col("_prefix").substr(F.lit(1), n))).alias("_at"),
    )
    at = best.select(*_GROUP, F.col("_prefix").alias("_at"), "rule")
    step = F.struct(F.length("_at").alias("length"), "rule")
    nodes = above.join(at, [*_GROUP, "_at"]).groupBy(*_GROUP, "_prefix").agg(F.sort_array(F.collect_list(step)).alias("path"))
    return nodes.groupBy(*_GROUP).agg(F.sort_array(F.collect_list(F.struct(F.col("_prefix").alias("prefix"), "path"))).alias("nodes"))


def _walk(code: Column) -> Column:
    """The rule that wins on the path of ``code`` in the trie ``nodes``: the node before
    ``code`` is found by halving; the nodes above it that ``code`` passes are on its path."""
    nodes = F.col("nodes")
    halves = F.filter(F.array(*[F.lit(1 << i) for i in range(29, -1, -1)]), lambda half: half <= F.size(nodes))

    def further(at: Column, half: Column) -> Column:
        return F.when(F.get(nodes, at + half - 1)["prefix"] <= code, at + half).otherwise(at)

    node = F.get(nodes, F.aggregate(halves, F.lit(0), further) - 1)
    passed = F.filter(node["path"], lambda step: code.substr(F.lit(1), step["length"]) == node["prefix"].substr(F.lit(1), step["length"]))
    return F.array_min(F.transform(passed, lambda step: step["rule"]))


def head_by_rules(df: DataFrame, rules: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds HEAD from a table (priority, branch_code, cgl_prefix, currency,
    head_category); a NULL rule field matches anything, the lowest priority wins
    (then the lowest head_category; NULL comes first), and no match as well as a NULL
    head_category gives UNCLASSIFIED. Never adds rows.

    A row walks four tries, of its branch or any with its currency or any. A measured trie
    that fits is broadcast, so that rows are not shuffled; of a larger one the distinct keys are
    joined with it by branch and currency.
    """
    trie = checkpointed(rule_trie(rules))
    size = trie.agg(F.sum(F.size("nodes"))).first()[0] or 0
    if size <= max_broadcast_rows and fits_broadcast(trie):
        return _walked(df, lambda rows: left_join(rows, F.broadcast(trie), _GROUP))
    keys = df.groupBy(*LEDGER_KEYS).agg(F.count(F.lit(1)).alias("_rows"))
    # All keys share the tries of any branch, so these are hot; lookup_join splits them.
    heads = _walked(keys, lambda rows: lookup_join(rows, trie, _GROUP, max_broadcast_rows=-1))
    return join_group_values(df, heads, LEDGER_KEYS, "_rows", null_safe=True)


def _walked(df: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    def forms(name: str) -> tuple[Column, Column]:
        """The value's own form and that of any value, as an expression of the row: a join
        by a constant would not be one by equality."""
        form = _form(F.col(name))
        return form, F.left(form, F.lit(0))

    found, rows = [], df
    for branch, currency in product(forms("BRANCH_CODE"), forms("CURRENCY")):
        rows = join(rows.withColumn("_branch", branch).withColumn("_currency", currency))
        found.append(f"_rule{len(found)}")
        rows = rows.withColumn(found[-1], _walk(_form(F.col("CGL")))).drop("nodes", *_GROUP)
    best = F.array_min(F.array(*found)).getField("head_category")
    return rows.withColumn("HEAD", F.coalesce(best, F.lit(UNCLASSIFIED))).drop(*found)
