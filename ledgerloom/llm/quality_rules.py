"""Operator 7: quality rules whose thresholds follow the data.

Each text gets exact counts (see ``base_counts``) and, of those, the measures in
``MEASURES``, on a log scale: of length its logarithm, of a rate or a share that of the odds,
with half an event added on either side. A text without any event so lies the lower the longer
it is, and a group of texts without events has quantiles that differ.

For each language and source a mergeable quantile sketch of each measure is built in one
aggregation: counts of steps of ``STEP`` on the log scale, so a quantile of the values is off
by half a step, 1 %. Counts are added up on the map side, merge by addition, and are the same
in every run. A limit lies ``reach`` spreads from the median; the spread is the distance from
the median to the quantile ``EDGE`` on the other, clean side. Junk on one side thus moves a
limit only once it is half of a group. A spread below ``least`` counts as that, which matters
where nearly all texts of a group are alike. A group of fewer than ``ENOUGH`` texts uses the
merged sketch of its language, and a language of fewer the merged sketch of all. Documents then
meet the limits of their group in a join; their rates are compared as they are, nothing added,
so a text without events breaks no upper limit.

Sketches see the texts that pass the base rules, equal texts of a group once, so that copies
set no limit. Null languages and sources are groups of their own; a null text has no words and
fails the base rules; an empty table gives no rows. Repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, keep_where, rows_of, text_hash, text_of, written

SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 20, 30
REPEAT_WINDOW = 8

#: Measure -> (numerator, denominator, reach and least spread on the log scale).
MEASURES = {
    "symbols": ("n_symbols", "n_words", 2.0, 0.7),
    "dup_lines": ("n_dup_lines", "n_lines", 2.0, 0.7),
    "repeats": ("n_repeat_words", "n_words", 3.0, 0.7),
    "length": ("word_chars", "n_words", 4.0, 0.08),
}
#: Measures with a limit on both sides, and those that are shares.
TWO_SIDED, SHARES = ("length",), ("dup_lines", "repeats")
#: Quantiles are at 1 / EDGE, the half, and 1 - 1 / EDGE.
EDGE, ENOUGH, STEP = 20, 50, 0.02

_BASE = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words found twice or more."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words) or len(words) <= window:
        return 0
    # number the runs of 2, 4, 8 words by the numbers of their halves
    width = 1
    while width < window:
        step = min(width, window - width)
        ids = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, counts = np.unique(ids, return_inverse=True, return_counts=True)
        if len(counts) == len(ids):
            return 0
        width += step
    often = np.flatnonzero(counts[ids] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, often, 1)
    np.add.at(marks, often + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a
    word). Words are runs without the six ASCII spaces."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def _base(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _BASE.split(", ")][1:]
    for batch in batches:
        for part in rows_of(batch):
            counts = list(zip(*map(base_counts, part.column("text").to_pylist()), strict=True))
            rest = [part.column(c) for c in part.schema.names if c not in ("doc_id", "text")]
            columns = [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), *rest]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", *names, *(c for c in part.schema.names if c not in ("doc_id", "text"))]
            )


def counted(docs: DataFrame) -> DataFrame:
    """Base counts of all documents, with their language and source, written."""
    kept = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    texts = docs.select("doc_id", *kept, text_hash(), text_of().alias("text"))
    return written(texts.mapInArrow(_base, _BASE + ", lang string, source string, text_sha string"), "rule-counts")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _measure(name: str) -> Column:
    over, under, _, _ = MEASURES[name]
    return F.col(over) / F.greatest(F.col(under), F.lit(1))


def _step(name: str) -> Column:
    """Number of the step of the log scale that holds a text's measure."""
    over, under = map(F.col, MEASURES[name][:2])
    if name in TWO_SIDED:
        value = F.log(over / under)  # texts with words only, so neither is 0
    else:
        value = F.log((over + 0.5) / ((under - over + 0.5) if name in SHARES else (under + 1)))
    return F.floor(value / STEP)


def _back(name: str, value: Column) -> Column:
    """From the log scale to the measure."""
    return 1 / (1 + F.exp(-value)) if name in SHARES else F.exp(value)


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, measure, step, n: texts of a group in each step of each measure."""
    passed = counts.filter(~base_failed())
    own = [F.struct(F.lit(m).alias("measure"), _step(m).alias("step")) for m in MEASURES]
    numbers = [c for c in counts.columns if c not in ("doc_id", "lang", "source", "text_sha")]
    once = passed.groupBy("lang", "source", "text_sha").agg(*(F.first(c).alias(c) for c in numbers))
    return once.select("lang", "source", F.inline(F.array(*own))).groupBy("lang", "source", "measure", "step").agg(
        F.count(F.lit(1)).alias("n")
    )


def _quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """n, low, mid, high by keys and measure: number of texts and three quantiles. A group
    has as many rows as the log scale has steps in use, a few thousand at most."""
    merged = sketch.groupBy(*keys, "measure", "step").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    up_to = F.sum("n").over(group.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    steps = merged.withColumns({"up_to": up_to, "total": F.sum("n").over(group)})

    def at(part: int, of: int) -> Column:
        return (F.min(F.when(F.col("up_to") * of >= F.col("total") * part, F.col("step"))) + 0.5) * STEP

    found = [at(1, EDGE).alias("low"), at(1, 2).alias("mid"), at(EDGE - 1, EDGE).alias("high")]
    return steps.groupBy(*keys, "measure").agg(F.max("total").alias("n"), *found)


def limits(counts: DataFrame) -> DataFrame:
    """lang, source, and a low and high limit of each measure (null: none)."""
    sketch = written(sketches(counts), "sketches")
    names = ["n", "low", "mid", "high"]

    def level(suffix: str, *keys: str) -> DataFrame:
        found = _quantiles(sketch, *keys).withColumnsRenamed({c: c + suffix for c in names})
        return found.withColumnsRenamed({"measure": "_measure", **{c: f"_{c}" for c in keys}})

    own, by_lang = _quantiles(sketch, "lang", "source"), level("_lang", "lang")
    same = (F.col("measure") == F.col("_measure")) & F.col("lang").eqNullSafe(F.col("_lang"))
    groups = own.join(by_lang, same).drop("_measure", "_lang")
    everything = F.broadcast(level("_all"))  # a row for each measure
    groups = groups.join(everything, F.col("measure") == F.col("_measure"))

    def chosen(c: str) -> Column:
        own_, lang = F.when(F.col("n") >= ENOUGH, F.col(c)), F.when(F.col("n_lang") >= ENOUGH, F.col(c + "_lang"))
        return F.coalesce(own_, lang, F.col(c + "_all")).alias(c)

    groups = groups.select("lang", "source", "measure", *map(chosen, names[1:]))
    found = []
    for name, (_, _, reach, least) in MEASURES.items():
        below, above = F.col("mid") - F.col("low"), F.col("high") - F.col("mid")
        top = _back(name, F.col("mid") + reach * F.greatest(below, F.lit(least)))
        bottom = _back(name, F.col("mid") - reach * F.greatest(F.least(below, above), F.lit(least)))
        mine = F.col("measure") == name
        found.append(F.max(F.when(mine, top)).alias(f"{name}_high"))
        found.append(F.max(F.when(mine & F.lit(name in TWO_SIDED), bottom)).alias(f"{name}_low"))
    return written(groups.groupBy("lang", "source").agg(*found), "limits")


def _judged(docs: DataFrame) -> DataFrame:
    counts = counted(docs)
    bounds = limits(counts).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = counts.join(bounds, same, "left")
    broken = [F.when(base_failed(), F.lit("base"))]
    for name in MEASURES:
        value = _measure(name)
        out = (value > F.col(f"{name}_high")) | F.coalesce(value < F.col(f"{name}_low"), F.lit(False))
        broken.append(F.when(out, F.lit(name)))
    rule = F.coalesce(*broken)
    return joined.select(
        *counts.columns, base_failed().alias("base_failed"), rule.isNull().alias("kept"), rule.alias("broken_rule")
    )


def judged(docs: DataFrame) -> DataFrame:
    """Per document its base counts, base_failed, kept, and the first rule it broke."""
    return _judged(docs).drop("n_lines", "lang", "source", "text_sha")


def drop_by_rules(docs: DataFrame) -> DataFrame:
    """The documents that keep all rules, with all columns."""
    return keep_where(docs, _judged(docs), F.col("kept"), "lang", "source")
