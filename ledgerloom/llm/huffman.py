"""Operator 2: token ids as canonical, length-limited Huffman codes in block files.

Documents are put in ascending order of doc_id by one range shuffle, tokenized once and
their ids written. Counts of ids over all documents give one code for the whole corpus,
no code longer than ``LIMIT`` bits, so that one table look-up decodes an id. Blocks of
whole documents are coded independently; every ``LANE`` ids a checkpoint holds the bit
offset, at which decoding can start. All checkpoints of a block are decoded side by side.

File format (Parquet, so that the shared file system needs nothing but Spark's writer):

* ``code``: id, length of its code. Canonical codes follow from the lengths.
* ``blocks``: start (ids of all documents before the block), doc_ids and doc_lengths (ids
  of each document, the end id included), bits (offset of each checkpoint), payload.

A null text counts as empty and has the end id only. Rows with one doc_id are ordered by
the hash of their text; null doc_ids come first. An empty table gives no block. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import rows_of, text_of, written
from ledgerloom.llm.ids import encoder_of

#: Bits of the longest code, where the number of distinct ids allows it.
LIMIT = 16
#: Ids between two checkpoints, and ids after which a block ends with its document.
LANE, BLOCK = 256, 1 << 18
#: Documents whose ids are counted at once: each count takes room for the vocabulary.
TOGETHER = 256

_IDS = "shard int, doc_id long, before long, n_ids long, ids binary"
_BLOCKS = "start long, doc_ids array<long>, doc_lengths array<long>, bits array<long>, payload binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol by package-merge; 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        level = both[at]
        is_leaf.append(at < len(leaves))
    take = 2 * len(leaves) - 2
    for leaf in reversed(is_leaf):
        n = int(leaf[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    of = lengths[order]
    longest = int(of.max(initial=1))
    # in units of the longest code, each code starts where the one before it ends
    ends = np.cumsum(1 << (longest - of))
    codes[order] = np.concatenate([[0], ends[:-1]])[: len(order)] >> (longest - of)
    return codes


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of all codes, and the bit offset of every LANE-th id."""
    n_bits = lengths[ids]
    ends = np.cumsum(n_bits)
    at = ends - n_bits
    word = at >> 5
    value = codes[ids] << (64 - n_bits - (at & 31))  # at most 31 + 32 bits
    size = (int(ends[-1]) >> 5) + 2 if len(ids) else 2
    value = value.view(np.uint64)
    # codes fill disjoint bits of a word, so sums are exact
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
    words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    payload = words.astype(np.uint64).astype(">u4").tobytes()
    return payload[: ((int(ends[-1]) + 7) >> 3 if len(ids) else 0)], at[::LANE]


class Decoder:
    """A table with the id and the length of the code at each ``longest`` bits."""

    def __init__(self, lengths: np.ndarray):
        self.longest = longest = int(lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        times = 1 << (longest - lengths[order])
        self.symbol = np.zeros(1 << longest, np.uint32)
        self.length = np.ones(1 << longest, np.int64)
        total = int(times.sum())
        self.symbol[:total] = np.repeat(order, times)
        self.length[:total] = np.repeat(lengths[order], times)

    def decode(self, payload: bytes, bits: np.ndarray, n_ids: int) -> np.ndarray:
        """All ids of a block: one step decodes an id after every checkpoint."""
        raw = np.frombuffer(payload + bytes(8 + LANE * 4), np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at, mask = np.array(bits, np.int64), np.uint32((1 << self.longest) - 1)
        out = np.empty((LANE, len(at)), np.uint32)
        last = len(window) - 1
        for step in range(min(LANE, n_ids)):
            seen = (window[np.minimum(at >> 3, last)] >> (32 - self.longest - (at & 7)).astype(np.uint32)) & mask
            out[step] = self.symbol[seen]
            at += self.length[seen]
        return out.T.reshape(-1)[:n_ids]


def _tokenize(path: str, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = encoder_of(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in rows_of(batch):
                ids = encoder.encode(part.column("text").to_pylist(), end)
                sizes = np.array([len(x) // encoder.width.itemsize for x in ids], np.int64)
                starts = before + np.cumsum(sizes) - sizes
                before = int(starts[-1] + sizes[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), shard, np.int32)),
                        part.column("doc_id"),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(ids, pa.binary()),
                    ],
                    ["shard", "doc_id", "before", "n_ids", "ids"],
                )

    return run


def as_ids(data: bytes, n: int) -> np.ndarray:
    """Ids as written by an encoder of either width."""
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1, np.int64)
    for batch in batches:
        rows = list(zip(batch.column("ids").to_pylist(), batch.column("n_ids").to_pylist(), strict=True))
        for i in range(0, len(rows), TOGETHER):
            more = np.bincount(np.concatenate([as_ids(data, n) for data, n in rows[i : i + TOGETHER]]))
            if len(more) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(more) - len(counts), np.int64)])
            counts[: len(more)] += more
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])


def _blocks(lengths: np.ndarray, offsets: dict[int, int]):
    codes = canonical_codes(lengths)

    def block(start: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        payload, bits = encode_ids(np.concatenate(ids).astype(np.int64), lengths, codes)
        values = [[start], [doc_ids], [[len(x) for x in ids]], [bits.tolist()], [payload]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        names = ["start", "doc_ids", "doc_lengths", "bits", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, expected, size, doc_ids, ids = 0, None, 0, [], []
        for batch in batches:
            for shard, doc_id, before, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = offsets[shard] + before
                if ids and (at != expected or size >= BLOCK):
                    yield block(start, doc_ids, ids)
                    size, doc_ids, ids = 0, [], []
                if not ids:
                    start = at
                doc_ids.append(doc_id)
                ids.append(as_ids(data, n))
                size, expected = size + n, at + n
        if ids:
            yield block(start, doc_ids, ids)

    return run


def write_ids(docs: DataFrame, tokenizer: str, end: int) -> tuple[DataFrame, DataFrame]:
    """Writes the ids of all documents; returns the ``code`` and ``blocks`` files as
    tables. Only counts by id (as many as the vocabulary) and totals by task reach the
    driver."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_of().alias("text"))
    ordered = texts.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
    ids = written(
        ordered.sortWithinPartitions("doc_id", "h").select("doc_id", "text").mapInArrow(_tokenize(tokenizer, end), _IDS),
        "ids",
    )
    totals = ids.groupBy("shard").agg(F.max(F.col("before") + F.col("n_ids")).alias("n")).orderBy("shard").collect()
    ends = np.cumsum([r["n"] for r in totals], dtype=np.int64).tolist()
    offsets = {r["shard"]: e - r["n"] for r, e in zip(totals, ends, strict=True)}
    found = ids.select("ids", "n_ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    code = spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int")
    blocks = ids.select("shard", "doc_id", "before", "n_ids", "ids").mapInArrow(_blocks(lengths, offsets), _BLOCKS)
    # files in order of documents: a block's place among all ids is the file that it goes to
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = F.floor(F.col("start") * files / F.lit(max(1, ends[-1] if ends else 1))).cast("int")
    placed = blocks.repartitionById(files, file).sortWithinPartitions("start")
    return written(code, "code"), written(placed, "blocks")


def read_ids(code: DataFrame, blocks: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document what its block decodes to: doc_id, start, n_tokens, ids_crc32, and
    the ids themselves if asked for."""
    table = {r["id"]: r["length"] for r in code.collect()}
    lengths = np.zeros(max(table, default=0) + 1, np.int64)
    for i, n in table.items():
        lengths[i] = n

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in batches:
            for start, doc_ids, sizes, bits, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = decoder.decode(payload, bits, sum(sizes))
                ends = np.cumsum(sizes)
                data = memoryview(ids.astype("<u4").tobytes())
                cuts = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes, strict=True)]
                columns = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends - np.array(sizes), pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(cut) for cut in cuts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(cut, "<u4").tolist() for cut in cuts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return blocks.select("start", "doc_ids", "doc_lengths", "bits", "payload").mapInArrow(run, schema)
