"""Operator 1: exact duplicates by an extendible-hash index on shared files.

Texts are equal if their bytes are equal after lower-casing A-Z. The index has entries for
distinct texts, in buckets by the leading bits of a 64-bit key. The directory starts with
one slot; a bucket with more than ``capacity`` keys is split by one more bit, and where
the bucket is as deep as the directory, the directory doubles. It has at most
``MAX_SLOTS`` slots and is written beside the buckets.

Each bucket, hence range of keys, has one owner task. Copies are combined within a map
task before they are shuffled, so that a large group sends its owner a row for each map
task (or for every ``COMBINE_BYTES`` of other texts), not one for each document. The owner
walks its rows by key; a row whose bytes equal an entry's joins it, one that only has the
same key is chained behind it. Documents then meet their entry by key and digest.

Null texts are empty and equal to each other. Null doc_ids lose against others; keep_id is
null if a group has no other. Rows that repeat a doc_id together with its text are one
document and share its verdict. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_sized, keep_one, rows_of, text_hash, text_of, written

#: Keys in a bucket before it splits, at least; more where MAX_SLOTS / 4 buckets are full.
CAPACITY = 4096
#: Bits of the deepest directory.
DEPTH = 16
MAX_SLOTS = 1 << DEPTH
#: Bytes of distinct texts that a map task holds to combine copies.
COMBINE_BYTES = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_ENTRY = "bucket int, key long, chain int, n_bytes long, text_sha256 string, keep_id long, group_size long"


def normalised(text: str) -> bytes:
    return text.encode().lower()  # of bytes, lower() changes A-Z only


def key_of(data: bytes, bits: int = 64) -> int:
    """Signed 64-bit key. Fewer ``bits`` make collisions, for tests."""
    key = xxhash.xxh64_intdigest(data) >> (64 - bits) << (64 - bits)
    return key - (1 << 64) if key >> 63 else key


def _keys(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch):
                data = [normalised(t) for t in part.column("text").to_pylist()]
                columns = [
                    part.column("doc_id"),
                    pa.array([key_of(d, bits) for d in data], pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "text_sha256"])

    return run


def directory(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, list[int]]:
    """Slot to bucket, and each bucket's own depth, from key counts by DEPTH-bit prefix."""
    below = np.zeros(MAX_SLOTS + 1, np.int64)
    for prefix, n in counts.items():
        below[prefix + 1] = n
    below = np.cumsum(below)
    slots, depths, depth = np.zeros(1, np.int64), [0], 0
    full = [(0, 0)]  # bucket and its prefix
    while full:
        bucket, prefix = full.pop()
        own = depths[bucket]
        low = prefix << (DEPTH - own)
        if own == DEPTH or below[low + (1 << (DEPTH - own))] - below[low] <= capacity:
            continue
        if own == depth:
            slots, depth = np.repeat(slots, 2), depth + 1
        depths[bucket] += 1
        new = len(depths)
        depths.append(own + 1)
        start = (2 * prefix + 1) << (depth - own - 1)
        slots[start : start + (1 << (depth - own - 1))] = new
        full += [(bucket, 2 * prefix), (new, 2 * prefix + 1)]
    return slots, depths


def _combine(slots: np.ndarray, bits: int):
    shift = 64 - (len(slots).bit_length() - 1)

    def rows(held: dict[bytes, list]) -> pa.RecordBatch:
        data = list(held)
        keys = [key_of(d, bits) for d in data]
        at = [int(slots[(k % (1 << 64)) >> shift]) for k in keys]
        columns = [
            pa.array(at, pa.int32()),
            pa.array(keys, pa.int64()),
            pa.array(data, pa.binary()),
            pa.array([v[0] for v in held.values()], pa.int64()),
            pa.array([v[1] for v in held.values()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "key", "data", "keep_id", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            for part in rows_of(batch):
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = normalised(text)
                    seen = held.get(data)
                    if seen is None:
                        held[data] = [doc_id, 1]
                        size += len(data) + 100
                    else:
                        seen[1] += 1
                        if doc_id is not None and (seen[0] is None or doc_id > seen[0]):
                            seen[0] = doc_id
                if size > COMBINE_BYTES:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return run


def _own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and key; a chain has the distinct texts of a key."""
    at, chain = None, {}

    def entries() -> list[tuple]:
        return [
            (*at, i, len(data), hashlib.sha256(data).hexdigest(), keep_id, n)
            for i, (data, (keep_id, n)) in enumerate(chain.items())
        ]

    for batch in batches:
        out: list[tuple] = []
        for bucket, key, data, keep_id, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (bucket, key) != at:
                out += entries()
                at, chain = (bucket, key), {}
            seen = chain.get(data)  # a look-up by bytes: equal hashes are compared byte by byte
            if seen is None:
                chain[data] = [keep_id, n]
            else:
                seen[1] += n
                if keep_id is not None and (seen[0] is None or keep_id > seen[0]):
                    seen[0] = keep_id
        if out:
            yield _table(out)
    if chain:
        yield _table(entries())


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in _ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def build_index(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written keys (doc_id, key, text_sha256), directory (slot, bucket, depth) and
    entries, in one folder for each bucket."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_of().alias("text"))
    keys = written(texts.mapInArrow(_keys(key_bits), "doc_id long, key long, text_sha256 string"), "keys")
    prefix = F.shiftrightunsigned("key", 64 - DEPTH).cast("int").alias("prefix")
    counts = {r["prefix"]: r["count"] for r in keys.select("key").distinct().groupBy(prefix).count().collect()}
    slots, depths = directory(counts, max(capacity, 4 * sum(counts.values()) // MAX_SLOTS))
    table = [(i, int(b), depths[b]) for i, b in enumerate(slots)]
    slot_table = written(spark.createDataFrame(table, "slot int, bucket int, depth int"), "directory")
    combined = texts.mapInArrow(_combine(slots, key_bits), "bucket int, key long, data binary, keep_id long, n long")
    entries = combined.repartition("bucket").sortWithinPartitions("bucket", "key").mapInArrow(_own, _ENTRY)
    return keys, slot_table, written(entries, "index", "bucket")


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """Per document the one that stays of its copies, and whether it is that one."""
    keys, _, entries = build_index(docs, capacity, key_bits)
    found = entries.select("key", "text_sha256", "keep_id", "group_size", "bucket", "chain")
    joined = join_sized(keys, found, ["key", "text_sha256"], "group_size")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "bucket", "chain")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of copies.
    Of the texts with the doc_id that stays, the one with the smallest hash."""
    verdict = exact_duplicates(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    digest = F.sha2(F.translate(text_of(), UPPER, UPPER.lower()), 256).alias("text_sha256")
    texts = docs.select("doc_id", digest, text_hash()).withColumnsRenamed({"doc_id": "_id", "text_sha256": "_digest"})
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("text_sha256"))
    kept = texts.join(verdict, same).groupBy("doc_id", "text_sha256").agg(F.min("text_sha").alias("text_sha"))
    return keep_one(docs, written(kept.select("doc_id", "text_sha"), "exact-kept"))
