"""Operator 10: near-duplicates by SimHash fingerprints and BK-trees.

A document's fingerprint has a bit set if over half of its word shingles' XXH64 have it.
Fingerprints that differ in at most ``radius`` bits are linked, and a component is what
links connect. Equal fingerprints are one class from the start.

The 64 bits are cut into radius + k blocks. Two linked fingerprints agree in at least k of
them, so both lie in a shard of one of the choices of k blocks. k grows with the number
of fingerprints, so that a shard of evenly spread ones stays small; the result does not
depend on it. Each shard is a BK-tree: children are keyed by their Hamming distance to the
parent, and a query follows only edges within the radius of its own distance. A shard of
more than ``SHARD`` fingerprints is dealt into pieces, and every pair of pieces is a tree
of its own, so no tree exceeds two pieces. A tree's links leave it as a spanning forest, at
most one for each of its fingerprints.

A text without words has fingerprint zero. Texts of fewer words than a shingle are one
shingle. Null texts are empty; a null doc_id never is a component's id unless all are
null. Repeated rows each have their row; an empty table has none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_sized, keep_one, rows_of, text_hash, text_of, written
from ledgerloom.llm.components import components

WORDS, RADIUS, SEED = 4, 4, 42
#: Fingerprints of a piece of a shard, and how many a shard of spread ones should have.
SHARD, SPREAD = 4096, 64
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 15


def fingerprint(text: str, size: int = WORDS) -> int:
    words = text.encode().lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return 0
    joined, hash_of = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return hash_of(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    votes, n = np.zeros(64, np.int64), len(words) - size + 1
    for i in range(0, n, AT_ONCE):
        spans = zip(starts[i : min(i + AT_ONCE, n)], ends[i + size - 1 : i + AT_ONCE + size - 1], strict=False)
        found = np.array([hash_of(joined[a : b - 1], SEED) for a, b in spans], ">u8")
        votes += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch):
                found = [signed(fingerprint(t, size)) for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), part.column("text_sha"), pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_sha", "fp"])

    return run


class BKTree:
    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int) -> list[int]:
        """Places of the values within the radius."""
        found, todo = [], [0] if self.values else []
        values, children, radius = self.values, self.children, self.radius
        while todo:
            at = todo.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            low, high = distance - radius, distance + radius
            todo += [child for edge, child in children[at].items() if low <= edge <= high]
        return found

    def add(self, value: int) -> int:
        place = len(self.values)
        self.values.append(value)
        self.children.append({})
        at = 0
        while place:
            edges = self.children[at]
            after = edges.setdefault((self.values[at] ^ value).bit_count(), place)
            if after == place:
                break
            at = after
        return place


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what distances of at most ``radius`` connect."""
    tree, parent = BKTree(radius), list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for value in values:
        found = tree.near(value)
        own = tree.add(value)
        for other in found:
            a, b = root(own), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(values[i], values[root(i)]) for i in range(len(values)) if parent[i] != i]


def _shards(radius: int):
    mask = (1 << 64) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values = None, []
        for batch in batches:
            links: list[tuple[int, int]] = []
            for *shard, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != at:
                    if len(values) > 1:
                        links += spanning_links(values, radius)
                    at, values = shard, []
                values.append(fp & mask)
            yield table(links)
        if len(values) > 1:
            yield table(spanning_links(values, radius))

    def table(links: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = [pa.array([signed(x[i]) for x in links], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def masks(n: int, radius: int) -> list[int]:
    """For each choice of blocks the bits that a shard's fingerprints share."""
    k = 1
    while k < 4 and n > SPREAD << (64 * k // (radius + k)):
        k += 1
    blocks = radius + k
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(parts, k)]


def near_links(fingerprints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints in column fp, enough to connect all that
    are within ``radius`` bits, directly or by others."""
    chosen = masks(fingerprints.count(), radius)
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(signed(m))) for m in chosen))
    keyed = fingerprints.select("fp", F.posexplode(keys).alias("choice", "key"))
    sizes = keyed.groupBy("choice", "key").count().filter(F.col("count") > shard)
    large = written(sizes.withColumn("pieces", F.ceil(F.col("count") / shard).cast("int")).drop("count"), "large-shards")
    if large.isEmpty():
        dealt = keyed.select("choice", "key", F.lit(0).alias("p"), F.lit(0).alias("q"), "fp")
    else:
        pieces = F.coalesce("pieces", F.lit(1))
        own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
        others = F.explode(F.sequence(F.lit(0), pieces - 1))
        each = keyed.join(large, ["choice", "key"], "left").select("choice", "key", "fp", own.alias("own"), others.alias("other"))
        dealt = each.select(
            "choice", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp"
        )
    shards = ["choice", "key", "p", "q"]
    # few bytes but much work: a number of tasks that adaptive execution leaves as it is
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(tasks, *shards).sortWithinPartitions(*shards)
    return ordered.select(*shards, "fp").mapInArrow(_shards(radius), "a long, b long")


def _placed(docs: DataFrame, size: int, radius: int, shard: int) -> DataFrame:
    texts = docs.select("doc_id", text_hash(), text_of().alias("text"))
    found = written(texts.mapInArrow(_fingerprints(size), "doc_id long, text_sha string, fp long"), "fingerprints")
    classes = written(found.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    roots = components(near_links(classes.select("fp"), radius, shard))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = written(rooted.select("fp", "n", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"))
    placed = written(rooted.join(least, "root").select("fp", "n", "root", "component_id", "component_size"), "placed")
    return join_sized(found, placed, ["fp"], "n")


def near_duplicates(docs: DataFrame, size: int = WORDS, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Per document its fingerprint and component: the smallest doc_id linked to it."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _placed(docs, size, radius, shard).select("doc_id", hexed, "component_id", "component_size")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha")).alias("first")
    kept = _placed(docs, WORDS, RADIUS, SHARD).groupBy("root").agg(first)
    return keep_one(docs, written(kept.select("first.doc_id", "first.text_sha"), "near-kept"))
