"""Operator 12: spelling variants of the corpus's words, by an index of variable-length grams.

Two words are near if one code point inserted, deleted or replaced makes them equal. The
grams of a word are its pieces of 2 to ``LONGEST`` code points, with a mark at each end.
The dictionary has all pairs, and a longer gram only if what is left without its last code
point is frequent. A word is decomposed into the longest dictionary gram at each place,
without those inside an earlier one.

An edit touches few of them: a gram survives where ``LONGEST`` code points from its start
on lie before the edit, or where it starts behind the edit and ends more than ``LONGEST``
code points behind its place, out of reach of any gram over the edit. What is lost at most,
over all places, bounds how many grams near words share. So of a word's grams, rarest first,
only that many and one more are indexed, and near words meet in a list (the usual prefix
argument). A word of ``SHORTEST`` code points always keeps its first gram or its last.

Lists are merged and verified exactly, by words that are equal up to one place; a pair that
meets in several lists is taken in the first. The list of a gram in more than ``HOT`` words
is dealt by those equal parts, so no list grows beyond true links. The dictionary is a
bounded broadcast: at most ``FREQUENT`` grams of a length are frequent.

A word's form is its near word of largest count, if that is ``TIMES`` times its own; forms
are followed to the root by pointer doubling. Null texts are empty, a null doc_id counts as
an empty one in the checksum, rows that repeat count each. Other columns are ignored; an
empty table has no words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations, groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import rows_of, text_of, written

SHORTEST, LEAST, TIMES = 7, 2, 10
LONGEST = 4
#: Grams of a length that can be frequent: more than 1 / FREQUENT of all occurrences.
FREQUENT = 4096
#: Words of a list that one task merges.
HOT = 1 << 19
#: Entries of a task's counts before they are given out.
_ENTRIES = 1 << 19

_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")


def words_in(text: str, doc_id: int | None) -> Iterator[tuple[str, int]]:
    """Words of a text, of which some lose a code point, with their occurrences."""
    start = crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():  # of bytes: A-Z only
        h = crc32(run.encode(), start)
        if h % 31 == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
            if len(run) < SHORTEST:
                continue
        yield run, n


def _counted(parts: Iterable[Iterable[tuple[str, int]]], key: str) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], [key, "n"])

    counts: dict[str, int] = {}
    for part in parts:
        for name, n in part:
            counts[name] = counts.get(name, 0) + n
        if len(counts) > _ENTRIES:
            yield out()
            counts = {}
    if counts:
        yield out()


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = (part for batch in batches for part in rows_of(batch))
    rows = (row for part in parts for row in zip(part.column("text").to_pylist(), part.column("doc_id").to_pylist(), strict=True))
    return _counted((words_in(*row) for row in rows), "word")


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences in all documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counts = rows.mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST)


def marked(word: str) -> str:
    return f"^{word}$"


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[Iterable[tuple[str, int]]]:
        for batch in batches:
            for word in batch.column("word").to_pylist():
                s = marked(word)
                yield ((s[i : i + k], 1) for k in range(2, LONGEST + 1) for i in range(len(s) - k + 1))

    return _counted(parts(), "gram")


def dictionary(words: DataFrame, frequent: int = FREQUENT) -> dict[str, tuple[int, int]]:
    """Each gram's rank, rarest first, and how often it occurs in the words."""
    counts = written(words.select("word").mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = counts.filter(F.length("gram") == 2).agg(F.sum("n")).first()[0] or 0
    common = counts.filter((F.col("n") > total / frequent) & (F.length("gram") < LONGEST)).select(F.col("gram").alias("parent"))
    longer = counts.withColumn("parent", F.expr("left(gram, length(gram) - 1)")).join(F.broadcast(common), "parent", "left_semi")
    found = counts.filter(F.length("gram") == 2).unionByName(longer.select("gram", "n")).collect()
    ranked = sorted((r["n"], r["gram"]) for r in found)
    return {gram: (rank, n) for rank, (n, gram) in enumerate(ranked)}


def decomposed(word: str, grams: dict[str, tuple[int, int]]) -> list[tuple[int, str]]:
    """(place, gram) of a word, marks included."""
    s, end, out = marked(word), 0, []
    for p in range(len(s) - 1):
        k = min(LONGEST, len(s) - p)
        while k > 2 and s[p : p + k] not in grams:
            k -= 1
        if p + k > end:
            end = p + k
            out.append((p, s[p:end]))
    return out


def lost(found: list[tuple[int, str]], length: int) -> int:
    """How many of a word's grams one edit can touch at most; ``length`` has the marks.
    An insertion touches no more than a replacement of the code point before it."""
    return max(sum(not (p + LONGEST <= i or (p > i and p + len(g) > i + LONGEST)) for p, g in found) for i in range(length - 1))


def indexed(word: str, grams: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """(token, words with its gram) of the grams that a word is listed under, rarest first.
    A token is a gram's rank and how often the word had it before."""
    found = decomposed(word, grams)
    seen: Counter[str] = Counter()
    tokens = []
    for _, gram in found:
        rank, n = grams[gram]
        tokens.append((rank << 32 | seen[gram], n))
        seen[gram] += 1
    return sorted(tokens)[: lost(found, len(word) + 2) + 1]


def _parts(word: str) -> list[str]:
    """What a word shares with its near words: itself with a place left open, and without it."""
    out = {f"={word[:i]}?{word[i + 1 :]}" for i in range(len(word))}
    return sorted(out | {f"-{word}"} | {f"-{word[:i]}{word[i + 1 :]}" for i in range(len(word))})


#: A word in the list of a token, with the tokens it was listed under before. ``part`` is
#: empty, or what the words of a dealt list share.
LISTED = "token long, part string, word string, n long, before binary"


def _listed(grams: dict[str, tuple[int, int]], hot: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                tokens = indexed(word, grams)
                before = np.array([t for t, _ in tokens], np.int64).tobytes()
                for i, (token, size) in enumerate(tokens):
                    parts = [""] if size <= hot else _parts(word)
                    rows += [(token, part, word, n, before[: 8 * i]) for part in parts]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTED, strict=True)], schema=_LISTED)

    return run


_LISTED = pa.schema([("token", pa.int64()), ("part", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("before", pa.binary())])


def near_pairs(words: list[str], part: str = "") -> Iterator[tuple[int, int]]:
    """Places of near words in a list of distinct words, each pair once."""
    if part.startswith("="):
        yield from combinations(range(len(words)), 2)  # all differ at the open place
        return
    place = {word: i for i, word in enumerate(words)}
    if part.startswith("-"):
        short = place.get(part[1:])
        if short is not None:
            yield from ((short, i) for i in range(len(words)) if i != short)
        return
    for at in range(max(map(len, words))):
        same: dict[str, list[int]] = {}
        for i, word in enumerate(words):
            if at < len(word):
                rest = word[at + 1 :]
                same.setdefault(f"{word[:at]}?{rest}", []).append(i)
                if rest[:1] != word[at]:  # of equal neighbours the last is left out
                    short = place.get(word[:at] + rest)
                    if short is not None:
                        yield short, i
        for group in same.values():
            if len(group) > 1:
                yield from combinations(group, 2)


LINKS = "word string, near string, near_n long"
_LINKS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    out: list[tuple[str, str, int]] = []
    for (_, part), members in groupby(rows, key=lambda row: row[:2]):
        _, _, words, counts, before = zip(*members, strict=True)
        if len(words) == 1:
            continue
        for i, j in near_pairs(words, part):
            a, b = before[i], before[j]
            if a and b and not set(np.frombuffer(a, np.int64).tolist()).isdisjoint(np.frombuffer(b, np.int64).tolist()):
                continue  # they met in the list of a rarer gram
            out += [(words[i], words[j], counts[j]), (words[j], words[i], counts[i])]
            if len(out) > 1 << 15:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_LINKS)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_LINKS)


def near_links(words: DataFrame, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """word, near and near_n for all near words, both ways, each once. ``words`` are distinct."""
    grams = dictionary(words, frequent)
    listed = words.mapInArrow(_listed(grams, hot), LISTED)
    return listed.repartition("token", "part").sortWithinPartitions("token", "part").mapInArrow(_merge, LINKS)


def roots(forms: DataFrame) -> DataFrame:
    """word and root, of words that have a form: where following forms ends."""
    at = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(ahead, "root", "left_semi").isEmpty():
            return at
        at = written(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_variants(docs: DataFrame, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_links(words, frequent, hot).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    met = words.join(near, "word", "left")
    wins = -F.col("best.less") >= TIMES * F.col("n")
    formed = written(
        met.select(
            "word",
            F.when(wins, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(wins, -F.col("best.less")).alias("form_n"),
        ),
        "formed",
    )
    rooted = formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
