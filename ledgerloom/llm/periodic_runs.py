"""Operator 13: runs of words that repeat with a period, by scale-tiled distribution.

A run is a stretch of words with smallest period q, at least max(6, 4 q) words long, that
no neighbouring word extends. Periods are looked for by octaves, L <= q < 2 L for L a
power of two. A boundary lies before every 2 L-th word. A run has a boundary with two
periods or more behind it, so that the square ``x[b:b+2q]`` is in the run, and half of what
is left of the run's least length lies on one side of the square. Both are looked for by
hashes of L words, for all boundaries of an octave at once.

A boundary with such a square makes a tile, the words from 2 L before it to 6 L behind it.
Tiles of neighbouring boundaries overlap, and are exploded as stretches of at most
``STRETCH`` words (or one tile), each a row of its own. Every tile is solved alone: the
Z-function of the words behind the boundary says how far each period goes on, that of the
words before it in reverse how far it came. The fragments of a document and a period are
shuffled together and stitched where they share a period's length of words.

Null texts are empty. A document without a run, or without words, has n_runs 0 and four
nulls; its words all stay. Rows that repeat a document are documents of their own. A null
doc_id rewrites nothing. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import rows_of, text_of, written

LEAST, POWER = 6, 4
#: Words of neighbouring tiles that are one row.
STRETCH = 1 << 15
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def words_of(text: str, doc_id: int | None) -> list[bytes]:
    """The words, of which every tenth document has a tail that repeats."""
    words = text.encode().split()  # of bytes: the six ASCII spaces
    if doc_id is None or not words:
        return words
    g, rest = divmod(crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n, a = len(words), g % len(words)
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p]
    return words[:a] + (again * ((n - a) // p + 1))[: n - a]


def z_function(s: list[int], most: int) -> list[int]:
    """For i < most, how many elements from i on equal those from 0 on; 0 at 0."""
    n, z = len(s), [0] * most
    left = right = 0
    for i in range(1, most):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(1 << 16)
def _divisors(q: int) -> list[int]:
    """q divided by each of its primes."""
    found, rest, d = [], q, 2
    while d * d <= rest:
        if rest % d == 0:
            found.append(q // d)
            while rest % d == 0:
                rest //= d
        d += 1
    return [*found, q // rest] if rest > 1 else found


def solve(x: list[int], at: int, octave: int) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of the tile of boundary ``at`` of the words x, for
    periods that are the smallest of a square at the boundary."""
    ahead = x[at : at + 6 * octave]
    z = z_function(ahead, min(2 * octave, len(ahead)))
    squares = [q for q in range(octave, len(z)) if z[q] >= q and not any(z[d] >= 2 * q - d for d in _divisors(q))]
    if not squares:
        return []
    first, end = max(0, at - 2 * octave), min(at + 2 * octave - 1, len(x))
    before = x[first:at][::-1]
    zero = len(before) + 1  # where the words from ``end`` backwards begin
    back = z_function([*before, -1, *x[first:end][::-1]], zero + end - at - octave + 1)
    return [(q, at - back[zero + end - at - q], at + q + z[q]) for q in squares]


def merged(fragments: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of a period that share as many words as the period become one."""
    out: list[tuple[int, int, int]] = []
    for q, start, end in sorted(fragments):
        if out and out[-1][0] == q and out[-1][2] - start >= q:
            out[-1] = (q, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((q, start, end))
    return out


def boundaries(ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(L, boundaries with a square of a period of L <= q < 2 L) for each octave up to the
    longest document's. ``ids`` are words; -1 and less, each once, part documents."""
    # hash of the L words from each place on, made from those of L / 2 words
    hashes = (ids.astype(np.uint64) + np.uint64(0x51ED270B)) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    power, octave = _BASE, 1
    while POWER * octave <= longest:
        rows = -(-len(hashes) // (2 * octave)) + 4
        # what lies beyond the words equals nothing: every value there is another one
        padded = np.arange(rows * 2 * octave, dtype=np.uint64)
        padded[: len(hashes)] = hashes
        table = padded.reshape(rows, 2 * octave)
        b, q = np.nonzero(table[:-4, octave:] == table[:-4, :1])
        q += octave
        b *= 2 * octave

        def repeats(at: np.ndarray, q: np.ndarray, n: np.ndarray, octave: int = octave, x: np.ndarray = padded) -> np.ndarray:
            """Whether L <= n <= 2 L words from ``at`` on come again after q words."""
            last = at + n - octave
            return (x[at] == x[at + q]) & (x[last] == x[last + q])

        square = repeats(b, q, q)
        b, q = b[square], q[square]
        more = np.maximum(LEAST, POWER * q) // 2 - q
        onwards = repeats(b + q, q, more)
        before = (b >= more) & repeats(np.maximum(b - more, 0), q, more)
        found = np.unique(b[onwards | before])
        if len(found):
            yield octave, found
        hashes = hashes[:-octave] * np.uint64(power) + hashes[octave:]
        power = power * power & _MASK
        octave *= 2


def stretches(ids: np.ndarray, starts: np.ndarray, longest: int) -> Iterator[tuple[int, int, int, list[int], np.ndarray]]:
    """(document, L, first word, boundaries from there on, words) of neighbouring tiles.
    Document i is ``ids[starts[i]:starts[i + 1] - 1]``."""
    for octave, found in boundaries(ids, longest):
        documents = np.searchsorted(starts, found, side="right") - 1
        row: list[int] = []

        def cut(doc: int, octave: int = octave) -> tuple[int, int, int, list[int], np.ndarray]:
            lo, hi = int(starts[doc]), int(starts[doc + 1]) - 1
            first, last = max(lo, row[0] - 2 * octave), min(hi, row[-1] + 6 * octave)
            return doc, octave, first - lo, [b - first for b in row], ids[first:last]

        at = -1
        for b, doc in zip(found.tolist(), documents.tolist(), strict=True):
            if row and (doc != at or b - row[-1] > 8 * octave or b - row[0] > STRETCH):
                yield cut(at)
                row = []
            at = doc
            row.append(b)
        if row:
            yield cut(at)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: Of a document: its result if it has no tile, else its text; or a stretch of its tiles.
TILES = "row long, doc_id long, collapsed_sha256 string, text string, octave long, first long, boundaries array<int>, words binary"
_TILES = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("collapsed_sha256", pa.string()), ("text", pa.string())]
    + [("octave", pa.int64()), ("first", pa.int64()), ("boundaries", pa.list_(pa.int32())), ("words", pa.binary())]
)


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            yield from _tiles_of(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text")))


def _tiles_of(rows: list[int], doc_ids: list[int | None], texts: list[str]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    parts, starts, shas = [], [0], []
    for i, (doc_id, text) in enumerate(zip(doc_ids, texts, strict=True)):
        words = words_of(text, doc_id)
        shas.append(_sha(b" ".join(words)))
        ids = [known.setdefault(w, len(known)) for w in words]
        ids.append(-1 - i)
        parts.append(np.array(ids, np.int64))
        starts.append(starts[-1] + len(ids))
    out: list[dict] = []
    tiled, size = set(), 0
    longest = max(b - a - 1 for a, b in zip(starts, starts[1:]))
    for doc, octave, first, row, words in stretches(np.concatenate(parts), np.array(starts), longest):
        tiled.add(doc)
        out.append({"row": rows[doc], "octave": octave, "first": first, "boundaries": row, "words": words.astype(np.int32).tobytes()})
        size += 4 * len(words)
        if size > 16 << 20:
            yield pa.RecordBatch.from_pylist(out, _TILES)
            out, size = [], 0
    for i, row in enumerate(rows):
        out.append({"row": row, "doc_id": doc_ids[i]} | ({"text": texts[i]} if i in tiled else {"collapsed_sha256": shas[i]}))
    yield pa.RecordBatch.from_pylist(out, _TILES)


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row, octave, first, at, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = np.frombuffer(data, np.int32).tolist()
            for q, start, end in merged(f for b in at for f in solve(words, b, octave)):
                # cut at both ends of the stretch only: inside, a short fragment is a short run
                if end - start >= max(LEAST, POWER * q) or start == 0 or end == len(words):
                    found.append((row, q, first + start, first + end))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], ["row", "period", "start", "end"])


def runs(tiles: DataFrame) -> DataFrame:
    """row, period, start and end of every run of the documents with tiles."""
    rows = tiles.filter("octave IS NOT NULL").select("row", "octave", "first", "boundaries", "words")
    dealt = rows.repartition(F.col("row"), F.col("octave"), F.col("first"))
    fragments = dealt.mapInArrow(_solve, "row long, period long, start long, end long")
    group = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(group.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(before - F.col("start") < F.col("period"), F.lit(True))
    numbered = fragments.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(group))
    stitched = numbered.groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return stitched.drop("run").filter(F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST), POWER * F.col("period")))


FOUND = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_FOUND = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in FOUND.split(", ")])


def described(text: str, doc_id: int | None, found: list[tuple[int, int, int]]) -> dict:
    """The result of a document from its runs (start, period, end)."""
    words, found = words_of(text, doc_id), sorted(found)
    keep = np.ones(len(words), bool)
    best = None
    for start, q, end in found:
        keep[start + q : end] = False
        if best is None or (end - start) * best[1] > (best[2] - best[0]) * q:
            best = (start, q, end)
    lines = "".join(f"{start},{end - start},{q}\n" for start, q, end in found)
    out = {"doc_id": doc_id, "n_runs": len(found), "runs_sha256": _sha(lines.encode())}
    out["collapsed_sha256"] = _sha(b" ".join([words[i] for i in np.flatnonzero(keep).tolist()]))
    if best is not None:
        start, q, end = best
        out |= {"start": start, "length": end - start, "period": q, "exponent_milli": 1000 * (end - start) // q}
    return out


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            rows = zip(*(c.to_pylist() for c in part.columns), strict=True)
            out = [described(text, doc_id, [(r["start"], r["period"], r["end"]) for r in found or []]) for doc_id, text, found in rows]
            yield pa.RecordBatch.from_pylist(out, _FOUND)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: how many runs it has, the one that repeats most often, and
    digests of all runs and of the words that stay when repeats are dropped."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    tiles = written(rows.mapInArrow(_tiles, TILES), "tiles")
    listed = runs(tiles).groupBy("row").agg(F.collect_list(F.struct("start", "period", "end")).alias("found"))
    texts = tiles.filter("text IS NOT NULL").select("row", "doc_id", "text").join(listed, "row", "left")
    some = texts.select("doc_id", "text", "found").mapInArrow(_describe, FOUND)
    null = F.lit(None).cast("long")
    empty = F.lit(_sha(b""))
    none = tiles.filter("collapsed_sha256 IS NOT NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), null.alias("start"), null.alias("length"), null.alias("period"),
        null.alias("exponent_milli"), empty.alias("runs_sha256"), "collapsed_sha256",
    )
    return none.unionByName(some)
