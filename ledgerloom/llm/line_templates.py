"""Operator 8: line deduplication by a log-template tree. DataFrame functions only.

A line is parsed at a fixed depth: by its number of tokens, then by its ``DEPTH`` leading
tokens; tokens with a digit are variable fields from the start and read ``<*>``. That
gives a leaf of the tree. Within a leaf, a token stays in the template if it stands at its
place in at least two of the leaf's distinct lines and in ``SHARE`` of them; other tokens
are variable fields too. A line follows its template if the template keeps at least
``ALIKE`` of its tokens. Where it doesn't, but tokens that it shares with another line would
do, the leaf's remaining lines are split by a further position and each part is looked at
as the leaf was, and so on: a template needs two lines, however many others its leaf has.
A line left over is, with its digits, a template of its own. Templates that recur in two
or more documents are dropped from all but the first of them, the one with the smallest
doc_id, so that no content is lost altogether.

Lines are cut at newlines; tokens are separated by white space. Lines of fewer than
``LEAST`` tokens are left alone, and so are repetitions within one document. Keys of lines
are pairs of 64-bit hashes. Only leaves with several distinct lines are split into tokens.

Null and empty texts have one empty line and keep it; null doc_ids count as the smallest;
rows that repeat doc_id and text are one document and get the same result. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_sized, text_of, written

DEPTH, LEAST = 3, 3
SHARE, ALIKE = 0.2, 0.6
#: Leaves (16 bytes each) up to which their list is broadcast; beyond, it is joined.
MOST_BROADCAST = 1_000_000

FIELD = "<*>"
_WITH_DIGIT = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
#: White space within a line other than a single space.
_WIDE = r" [ \t\x0B\f\r]++|[\t\x0B\f\r][ \t\x0B\f\r]*+"


def _bytes_of(column: str, part: str) -> Column:
    """Bytes that occurrences of ``part`` take up."""
    return F.octet_length(column) - F.octet_length(F.replace(F.col(column), F.lit(part), F.lit("")))


def _even(column: str) -> Column:
    """The text with single spaces between the tokens of a line, and none at its ends."""
    text = F.col(column)
    odd = text.startswith(" ") | text.endswith(" ")
    for part in ("  ", " \n", "\n ", "\t", "\x0b", "\f", "\r"):
        odd = odd | text.contains(part)
    single = F.regexp_replace(text, _WIDE, " ")
    cut = F.replace(F.replace(single, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.when(odd, F.trim(cut)).otherwise(text)


def parsed(docs: DataFrame) -> DataFrame:
    """One row per line of ``LEAST`` tokens or more: the document's id and text hash,
    line_no, and the parsed line as ``line`` with ``n`` tokens, its leaf and its own hash."""
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc")
    texts = docs.select(ident, text_of().alias("text"))
    # hashed and made even once a text, not once a line
    texts = texts.select("doc", F.xxhash64("text").alias("h"), _even("text").alias("even"))
    lines = texts.select("doc", "h", F.posexplode(F.split("even", "\n", -1)).alias("line_no", "own"))
    # short lines need no template: none of the work that follows is done for them, and they
    # are told by their first tokens, as a filter's columns are computed again after it
    lines = lines.filter(F.substring_index("own", " ", LEAST - 1) != F.col("own"))
    lines = lines.withColumn("n", _bytes_of("own", " ") + 1)
    masked = F.when(F.col("own").rlike("[0-9]"), F.regexp_replace("own", _WITH_DIGIT, FIELD)).otherwise(F.col("own"))
    lines = lines.withColumn("masked", masked)
    # a line that is mostly fields, such as a row of numbers, is kept as it is
    mostly = F.col("masked").contains(FIELD) & (2 * _bytes_of("masked", FIELD) > len(FIELD) * F.col("n"))
    lines = lines.withColumn("line", F.when(mostly, F.col("own")).otherwise(F.col("masked")))
    leaf = F.xxhash64("n", F.substring_index("line", " ", DEPTH))
    return lines.select("doc", "h", "line_no", "n", "line", leaf.alias("leaf"), F.xxhash64("line").alias("hash"))


def _templates(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """leaf, hash, template for the distinct lines that a generalised template covers."""
    leaves = classes.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("lines"), F.min("first").alias("low"), F.max("last").alias("high")
    )
    mixed = written(leaves.filter("lines > 1 AND low < high").select("leaf", "lines"), "leaves")
    if mixed.count() <= MOST_BROADCAST:
        mixed = F.broadcast(mixed)
    texts = lines.select("leaf", "hash", "n", "line")
    groups = texts.join(mixed, "leaf").select("leaf", F.col("leaf").alias("part"), "hash", "n", "lines", "line")
    groups, found = written(groups.distinct(), "leaf-lines"), None
    while True:
        signed = written(_signed(groups), "leaf-signed")
        covers = F.col("kept") >= ALIKE * F.col("n")
        covered = signed.filter(covers).select("leaf", "hash", "template")
        found = covered if found is None else found.unionByName(covered)
        # counts only fall in a part's parts: lines without enough common tokens stay alone
        left = signed.filter(~covers & (F.col("common") >= ALIKE * F.col("n"))).select("part", "hash")
        if left.isEmpty():
            return found
        groups = written(_split(groups.join(left, ["part", "hash"])), "leaf-parts")


def _tokens(groups: DataFrame) -> DataFrame:
    return groups.select("leaf", "part", "hash", "n", "lines", F.posexplode(F.split("line", " ")).alias("pos", "token"))


def _signed(groups: DataFrame) -> DataFrame:
    """For each line its template in its part, how many of its tokens that keeps, and how
    many of them another line of the part has too."""
    tokens = _tokens(groups)
    here = tokens.groupBy("part", "pos", "token").agg(F.count(F.lit(1)).alias("found"))
    common = here.filter("found > 1").withColumnsRenamed({"part": "_part", "pos": "_pos", "token": "_token"})
    same = (F.col("part") == F.col("_part")) & (F.col("pos") == F.col("_pos")) & (F.col("token") == F.col("_token"))
    placed = tokens.join(common, same, "left")
    shared = F.col("found").isNotNull() & (F.col("token") != FIELD)
    kept = shared & F.coalesce(F.col("found") >= SHARE * F.col("lines"), F.lit(False))
    sign = F.xxhash64("pos", F.when(kept, F.col("token")).otherwise(FIELD))
    return placed.groupBy("leaf", "part", "hash", "n").agg(
        F.bit_xor(sign).alias("template"), F.sum(kept.cast("int")).alias("kept"), F.sum(shared.cast("int")).alias("common")
    )


def _split(groups: DataFrame) -> DataFrame:
    """Parts of two or more lines. A part that has lost lines goes on as it is. Others are
    split by the tokens at one position, that with the fewest of them where some are in two
    lines or more and not all are the same. Tokens of one line only, and fields, go on together."""
    left = groups.groupBy("part").agg((F.count(F.lit(1)) < F.first("lines")).alias("lost"))
    groups = written(groups.join(left, "part"), "leaf-left")
    here = _tokens(groups.filter("NOT lost")).groupBy("part", "pos", "token").agg(F.count(F.lit(1)).alias("found"))
    here = written(here, "leaf-tokens")
    common = (F.col("found") > 1) & (F.col("token") != FIELD)
    places = here.groupBy("part", "pos").agg(F.count(F.lit(1)).alias("kinds"), F.max(common).alias("splits"))
    chosen = places.filter("kinds > 1 AND splits").groupBy("part").agg(F.min(F.struct("kinds", "pos")).alias("at"))
    chosen = chosen.select("part", F.col("at.pos").alias("pos"))
    values = here.filter(common).select("part", "pos", "token", F.lit(True).alias("own"))
    same = groups.filter("lost").select("leaf", "part", "hash", "n", "line")
    rows = groups.filter("NOT lost").join(chosen, "part").withColumn("token", F.get(F.split("line", " "), F.col("pos")))
    rows = rows.join(values, ["part", "pos", "token"], "left")
    rows = rows.withColumn("part", F.xxhash64("part", "pos", F.when(F.col("own"), F.col("token")).otherwise(FIELD)))
    rows = written(rows.select("leaf", "part", "hash", "n", "line").unionByName(same), "leaf-rows")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("lines")).filter("lines > 1")
    return rows.join(sizes, "part").select("leaf", "part", "hash", "n", "lines", "line")


def recurring(docs: DataFrame) -> DataFrame:
    """doc, h, line_no of the lines that are dropped."""
    lines = written(parsed(docs), "lines")  # parsed once: the keys and, later, some leaves' texts are read from it
    keys = lines.select("doc", "h", "line_no", "leaf", "hash")
    classes = written(
        keys.groupBy("leaf", "hash").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("size")
        ),
        "line-classes",
    )
    templates = _templates(lines, classes)
    placed = classes.join(templates, ["leaf", "hash"], "left")
    placed = written(placed.withColumn("template", F.coalesce("template", "hash")), "line-templates")
    found = placed.groupBy("leaf", "template").agg(F.min("first").alias("keeper"), F.max("last").alias("high"))
    known = found.filter("keeper < high").select("leaf", "template", "keeper")
    listed = placed.join(known, ["leaf", "template"]).select("leaf", "hash", "size", "keeper")
    joined = join_sized(keys, written(listed, "recurring"), ["leaf", "hash"], "size")
    return joined.filter("doc != keeper").select("doc", "h", "line_no")


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, and the text of the lines that stay."""
    dropped = recurring(docs).groupBy("doc", "h").agg(F.collect_set("line_no").alias("dropped"))
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc")
    texts = docs.select("doc_id", ident, text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    joined = texts.join(dropped, ["doc", "h"], "left")
    # a column of its own: within the function of a place, the text would be split for each place
    joined, parts = joined.withColumn("parts", F.split("text", "\n", -1)), F.col("parts")
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("dropped"))
    left = F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    return joined.select(
        "doc_id",
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left).alias("text"),
    )
