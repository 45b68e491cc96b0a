"""Operator 3: packing into sequences with a controlled mixture of sources.

The documents of a source form a queue of tokens, ordered by doc_id. A window of
``WINDOW`` sequences is filled by deficit round robin: each queue has a quantum, its
target share of the window; it is granted the whole tokens of its deficit plus quantum,
the tokens left over go one each to the largest deficits, and what a queue was granted too
little or too much is carried to the next window. Queues take turns in one order, so a
window holds one run of every queue and a document is cut at the edge of a window or
sequence only.

The deficits before window w have a closed form: with shares p, a queue was granted
floor(p * tokens before w), and one more if its remainder is among the largest. Every task
therefore enters the round at the window where its own documents lie, with the deficits
that earlier windows and partitions left, and no task has to wait for another or see the
tokens of another queue. When a queue runs dry, its share passes to the others.

Sequences are full. The tokens after the last full sequence make sequences whose lengths
are powers of two, so nothing is padded.

``max_queues``: a source with fewer rows than this fraction of the table shares the queue
of all small sources, which holds its documents in the order of a hash of doc_id: each
small source is dealt over the whole queue, so a run of the queue is expected to have it in
its share. A queue too small for one token a window joins them at the end. All documents
are packed in any case. Null sources are a source; a null text is empty and has
the end id only; rows with one doc_id are ordered by the hash of their text. An empty
table has no piece. Columns other than doc_id, source and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import rows_of, text_of, written
from ledgerloom.llm.huffman import as_ids
from ledgerloom.llm.ids import encoder_of

CAPACITY = 2048
#: Sequences of a window.
WINDOW = 64
MAX_QUEUES = 1000

_IDS = "shard int, queue string, doc_id long, before long, n_ids long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "queue string, window long"
)


def shares(weights: list[int], tokens: int) -> list[int]:
    """``tokens`` whole tokens in proportion to ``weights``, largest remainders first."""
    total = sum(weights)
    granted = [w * tokens // total for w in weights]
    left = tokens - sum(granted)
    if left:
        by_rest = sorted(range(len(weights)), key=lambda q: (-(weights[q] * tokens % total), q))
        for q in by_rest[:left]:
            granted[q] += 1
    return granted


class Schedule:
    """What each queue was granted before any window."""

    def __init__(self, totals: list[int], weights: list[int], window: int):
        self.totals, self.window = totals, window
        self.starts: list[int] = []
        self.phases: list[tuple[list[int], list[int]]] = []  # granted before, weights from here on
        granted, at = [0] * len(totals), 0
        while any(g < t for g, t in zip(granted, totals, strict=True)):
            rest = [t - g for g, t in zip(granted, totals, strict=True)]
            live = [w if r else 0 for w, r in zip(weights, rest, strict=True)]
            if not sum(live):  # only queues with a target of nothing are left
                live = rest
            whole = min((r - 1) * sum(live) // (w * window) for r, w in zip(rest, live, strict=True) if w)
            if whole > 0:
                self._phase(at, granted, live)
                granted = [g + x for g, x in zip(granted, shares(live, whole * window), strict=True)]
                at += whole
                continue
            # a window in which a queue runs dry: its share goes to the others in turn
            now, room = [0] * len(totals), min(window, sum(rest))
            while room:
                open_ = [w if n < r else 0 for w, n, r in zip(live, now, rest, strict=True)]
                if not sum(open_):
                    open_ = [r - n for n, r in zip(now, rest, strict=True)]
                more = [min(x, r - n) for x, n, r in zip(shares(open_, room), now, rest, strict=True)]
                now = [n + m for n, m in zip(now, more, strict=True)]
                room -= sum(more)
            self._phase(at, granted, now)
            granted = [g + n for g, n in zip(granted, now, strict=True)]
            at += 1
        self.n_windows = at
        self.last = granted

    def _phase(self, at: int, granted: list[int], weights: list[int]) -> None:
        self.starts.append(at)
        self.phases.append((granted, weights))

    def before(self, window: int) -> list[int]:
        if window >= self.n_windows:
            return self.last
        i = bisect_right(self.starts, window) - 1
        granted, weights = self.phases[i]
        if window == self.starts[i]:
            return granted
        return [g + x for g, x in zip(granted, shares(weights, (window - self.starts[i]) * self.window), strict=True)]

    def find(self, queue: int, token: int) -> int:
        """The window that holds a token of a queue."""
        return bisect_right(range(self.n_windows), token, key=lambda w: self.before(w)[queue]) - 1


def sequence_of(position: int, total: int, capacity: int) -> tuple[int, int, int]:
    """Sequence, offset in it, and its length, for a position in the packed stream."""
    full = total // capacity
    if position < full * capacity:
        return position // capacity, position % capacity, capacity
    offset, rest, sequence = position - full * capacity, total % capacity, full
    while True:
        length = 1 << (rest.bit_length() - 1)
        if offset < length:
            return sequence, offset, length
        offset, rest, sequence = offset - length, rest - length, sequence + 1


def _tokenize(path: str, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_of(path), TaskContext.get().partitionId()
        queue, before = object(), 0
        for batch in batches:
            for part in rows_of(batch):
                ids = encoder.encode(part.column("text").to_pylist(), end)
                sizes = [len(x) // encoder.width.itemsize for x in ids]
                starts = []
                for q, n in zip(part.column("queue").to_pylist(), sizes, strict=True):
                    if q != queue:
                        queue, before = q, 0
                    starts.append(before)
                    before += n
                columns = [
                    pa.array(np.full(len(ids), shard, np.int32)),
                    part.column("queue"),
                    part.column("doc_id"),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "queue", "doc_id", "before", "n_ids", "ids"])

    return run


def _cut(schedule: Schedule, places: dict[tuple[int, str], tuple[int, int]], capacity: int, with_ids: bool):
    total = sum(schedule.totals)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_queue, window, low, high, shift = -1, 0, 0, 0, 0
        granted = lru_cache(4)(schedule.before)  # the end of a window is the start of the next
        for batch in batches:
            pieces: list[tuple] = []
            for shard, name, doc_id, before, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                queue, base = places[(shard, name)]
                token, end = base + before, base + before + n
                raw = memoryview(as_ids(data, n).astype("<u4").tobytes())
                start = 0
                while token < end:
                    if queue != at_queue or not low <= token < high:
                        if queue == at_queue and token == high:
                            window += 1
                            while granted(window + 1)[queue] <= token:
                                window += 1
                        else:
                            window, at_queue = schedule.find(queue, token), queue
                        first, after = granted(window), granted(window + 1)
                        low, high = first[queue], after[queue]
                        turn = sum(after[:queue]) - sum(first[:queue])
                        shift = sum(first) + turn - low  # from the queue's tokens to the stream
                    sequence, offset, length = sequence_of(token + shift, total, capacity)
                    take = min(end, high, token + length - offset) - token
                    ids = raw[4 * start : 4 * (start + take)]
                    piece = (doc_id, start, take, zlib.crc32(ids), n, sequence, offset, name, window)
                    pieces.append((*piece, bytes(ids)) if with_ids else piece)
                    token, start = token + take, start + take
            if pieces:
                kinds = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary()]
                names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"]
                columns = [pa.array(v, k) for v, k in zip(zip(*pieces, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    targets: dict[str | None, int] | None = None,
    capacity: int = CAPACITY,
    window: int = WINDOW,
    max_queues: int = MAX_QUEUES,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document. ``targets`` are whole-number weights by source, 0
    where a source is missing; without them each source has the share that it has of all
    tokens. ``with_ids`` adds the ids of each piece, as little-endian 32-bit integers.

    The driver gets totals of tokens by task and queue: as many rows as there are tasks
    and queues, since tasks hold ranges of (queue, doc_id)."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text_of().alias("text"))
    if targets is None:
        counts = docs.groupBy(F.col("source").cast("string").alias("source")).count()
        n_rows = docs.count()
        own = [r["source"] for r in counts.filter(F.col("count") * max_queues >= n_rows).collect()]
    else:
        own = list(targets)
    named = F.col("source").isin([s for s in own if s is not None])
    named = F.coalesce(named, F.lit(None in own))
    # "=" before a name, so that the shared queue "" meets no source's name; null is "-"
    queue = F.when(named, F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).otherwise("")
    rows = rows.select(queue.alias("queue"), "doc_id", "text", F.xxhash64("text").alias("h"))
    dealt = F.when(F.col("queue") == "", F.xxhash64("doc_id")).otherwise(F.lit(0))
    order = [F.col("queue"), dealt, F.col("doc_id"), F.col("h")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ids = written(ordered.select("queue", "doc_id", "text").mapInArrow(_tokenize(tokenizer, end), _IDS), "pack-ids")
    found = ids.groupBy("shard", "queue").agg(F.sum("n_ids").alias("n")).orderBy("queue", "shard").collect()
    weight_of = {"-" if s is None else f"={s}": w for s, w in targets.items()} if targets else None
    totals: dict[str, int] = {}
    for r in found:
        totals[r["queue"]] = totals.get(r["queue"], 0) + r["n"]
    span, everything = window * capacity, sum(totals.values())
    if weight_of is None:
        shared = [q for q, n in totals.items() if not q or n * span < everything]
    else:
        shared = [q for q in totals if q not in weight_of]
    names = [q for q in totals if q not in shared] + [""] * bool(shared)
    places, filled = {}, [0] * len(names)
    for r in found:
        q = names.index("" if r["queue"] in shared else r["queue"])
        places[(r["shard"], r["queue"])] = (q, filled[q])
        filled[q] += r["n"]
    weights = filled if weight_of is None else [weight_of.get(q, 0) for q in names]
    schedule = Schedule(filled, weights, span)
    schema = _PIECES + ", ids binary" * with_ids
    columns = ids.select("shard", "queue", "doc_id", "before", "n_ids", "ids")
    return columns.mapInArrow(_cut(schedule, places, capacity, with_ids), schema)
