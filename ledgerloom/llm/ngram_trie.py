"""Operator 11: language-model scores from an Elias-Fano trie of all n-grams of the corpus.

The model is a hierarchical Dirichlet one of three words,

    p(w)        = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | v)    = (c(v w)   + M2 p(w))     / (c(v)   + M2)
    p(w | u, v) = (c(u v w) + M3 p(w | v)) / (c(u v) + M3)

so that probabilities add up to 1, unknown words together as one. Nothing is pruned: every
pair and triple of the documents to learn from is in the trie. Words are numbered by
frequency; the trie goes from a word to those that follow it, and on to those that follow
the pair. A level has monotone pointers, its words as one sorted sequence, context by
context, searched from the context's base on, and 16-bit codes of the smoothed shares
``c(u v) / (c(u) + M2)`` and so on, in steps of 1/512 decade. A level's buffers are read in
place. They are columns of a table, not files, since the shared folder need not be mountable.

Documents are coded in slices of ``SLICE`` bytes of text. A slice's distinct words meet
the vocabulary, and its distinct pairs and triples go to the shards of the trie, once, both
to be counted and to be looked up; only codes come back. A shard has the pairs and triples
of its first words; the pairs of a word of many occurrences are dealt over as many shards as its share
asks for, by the second word. A word is in a slice's message once, however often it is there.

Text is split at the six ASCII spaces and ends with a token of its own. Null texts are
empty: one token. A null doc_id is neither held out nor learned from. Rows that repeat are
counted and scored each. Without anything to learn from scores are 0. Other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ledgerloom.llm.common import fold, rows_of, text_of, written
from ledgerloom.llm.elias_fano import Level, Monotone

#: Weights of the shorter context, in occurrences.
M2, M3 = 400.0, 60.0
SLICE = 8 << 20
#: Tokens to learn from for each shard of the trie.
SHARD = 1 << 20
STEPS = 512
_NONE = 65535
#: A token that cannot be at the end of a context, and one that was not learned.
START, UNKNOWN = 0, -1


def code_of(share: np.ndarray) -> np.ndarray:
    """16-bit codes of numbers up to 1, ``_NONE`` for 0."""
    some = share > 0
    codes = np.full(len(share), _NONE, np.uint16)
    codes[some] = np.minimum(np.rint(-np.log10(share[some]) * STEPS), _NONE - 1)
    return codes


_SHARES = np.append(10.0 ** (np.arange(_NONE) / -STEPS), 0.0)


def share_of(codes: np.ndarray) -> np.ndarray:
    return _SHARES[codes]


def packed(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed buffer, by bytes of equal weight."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (ord(a.dtype.char), len(a))], np.int64).tobytes()
    planes = [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    data = head + b"".join(planes)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def unpacked(buffer: bytes) -> list[np.ndarray]:
    data = pa.decompress(buffer[8:], int.from_bytes(buffer[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8).tolist()
    at, out = 8 + 16 * n, []
    for kind, length in zip(head[::2], head[1::2], strict=True):
        dtype = np.dtype(chr(kind))
        planes = np.frombuffer(data, np.uint8)[at : at + length * dtype.itemsize].reshape(dtype.itemsize, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += planes.size
    return out


# slices of documents, and their words


#: doc_ids; documents: held out or not, to learn from or not, tokens; words; the place of
#: each token among the words, 0 for the end of a document.
SLICES = "slice long, doc_ids array<long>, documents binary, words binary, tokens binary"
_SLICES = pa.schema(
    [("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("documents", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary())]
)


class _Places(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    doc_ids: list = []
    documents: list[tuple[int, int, int]] = []
    tokens: list[np.ndarray] = []
    place = _Places({b"": 0})
    size = n = 0

    def out() -> pa.RecordBatch:
        row = {"slice": first + n, "doc_ids": doc_ids, "words": b" ".join(place), "tokens": packed(np.concatenate(tokens), level=3)}
        row["documents"] = packed(*(np.array(c, np.int64) for c in zip(*documents, strict=True)))
        return pa.RecordBatch.from_pylist([row], _SLICES)

    for batch in batches:
        for part in rows_of(batch, 1 << 20):
            for doc_id, held_out, learned, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                words = text.encode().lower().split()  # of bytes: A-Z, and the six ASCII spaces
                words.append(b"")
                doc_ids.append(doc_id)
                documents.append((held_out, learned, len(words)))
                tokens.append(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)))
                size += len(text)
                if size >= SLICE:
                    yield out()
                    doc_ids, documents, tokens, place, size, n = [], [], [], _Places({b"": 0}), 0, n + 1
    if doc_ids:
        yield out()


def slices(docs: DataFrame) -> DataFrame:
    rest = fold(by=10)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(rest == 0, F.lit(False)).cast("int").alias("held_out"),
        F.coalesce(rest != 0, F.lit(False)).cast("int").alias("learned"),
        text_of().alias("text"),
    )
    return written(rows.mapInArrow(_slices, SLICES), "slices")


def _words(counted: bool):
    """Rows (slice, place, word) of the slices, or (word, n) with what is learned from."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, _, documents, words, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word = pa.array(words.split(b" "), pa.binary()).cast(pa.string())
                if counted:
                    _, learned, length = unpacked(documents)
                    n = np.bincount(unpacked(tokens)[0][np.repeat(learned, length) > 0], minlength=len(word))
                    some = np.flatnonzero(n)
                    columns, names = [word.take(pa.array(some)), pa.array(n[some])], ["word", "n"]
                else:
                    columns = [pa.array(np.full(len(word), number)), pa.array(np.arange(len(word))), word]
                    names = ["slice", "place", "word"]
                yield from pa.Table.from_arrays(columns, names).to_batches(1 << 16)

    return run


class Vocabulary(NamedTuple):
    words: DataFrame  # word, id from 1 on by frequency, n
    tokens: int
    size: int


#: Words of at least so many occurrences get the first ids, the most frequent first.
FREQUENT = 16


def _numbered(words: DataFrame, first: int) -> tuple[DataFrame, int, int]:
    """The words with ids from ``first`` on in their order, their number and occurrences.
    One row of each task that wrote them comes to the driver."""
    ordered = written(words.withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n")).orderBy("part").collect()
    starts, end = [], first
    for row in sizes:
        starts.append((row["part"], end))
        end += row["size"]
    begins = ordered.sparkSession.createDataFrame(starts, "part long, first long")
    ids = (F.col("first") + F.col("at") - F.shiftleft("part", 33)).alias("id")
    numbered = ordered.withColumn("part", part).join(F.broadcast(begins), "part").select("word", ids, "n")
    return numbered, end - first, sum(r["n"] for r in sizes)


def vocabulary(sliced: DataFrame) -> Vocabulary:
    """All words to learn from; the word "" is a document's end. Frequent words have small
    ids, which take fewer bytes."""
    counts = sliced.mapInArrow(_words(True), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts, "word-counts")
    often, n_often, tokens = _numbered(counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "word"), 1)
    seldom, n_seldom, others = _numbered(counts.filter(F.col("n") < FREQUENT), 1 + n_often)
    return Vocabulary(often.unionByName(seldom), tokens + others, n_often + n_seldom)


#: Ids and counts of a slice's words, UNKNOWN and 0 where not learned.
IDS = "slice long, words binary"
_IDS = pa.schema([("slice", pa.int64()), ("words", pa.binary())])


def _ids(found: pa.Table) -> pa.Table:
    place = found["place"].to_numpy()
    ids, n = np.full(len(place), UNKNOWN, np.int64), np.zeros(len(place), np.int64)
    ids[place], n[place] = (found[c].to_numpy() for c in ("id", "n"))
    return pa.Table.from_pylist([{"slice": found["slice"][0].as_py(), "words": packed(ids, n)}], _IDS)


def word_ids(sliced: DataFrame, words: Vocabulary) -> DataFrame:
    places = sliced.mapInArrow(_words(False), "slice long, place long, word string")
    # a slice has a word once, so no word has more rows than there are slices
    found = places.join(words.words.hint("shuffle_hash"), "word", "left")
    known = found.select("slice", "place", F.coalesce("id", F.lit(UNKNOWN)).alias("id"), F.coalesce("n", F.lit(0)).alias("n"))
    return written(known.groupBy("slice").applyInArrow(_ids, IDS), "word-ids")


# pairs and triples


class Grams(NamedTuple):
    """The distinct pairs and triples of known words of a slice, and where its tokens have them.
    Places and a slice's own counts take 4 bytes: a worker has several such arrays at a time."""

    held_out: np.ndarray
    lengths: np.ndarray
    pairs: np.ndarray  # (first << 32 | second), sorted
    pair_at: np.ndarray  # of tokens, -1 where a word is unknown
    triples: np.ndarray  # (place of the pair << 32 | third), sorted
    triple_at: np.ndarray
    pair_n: np.ndarray  # occurrences to learn from
    triple_n: np.ndarray
    pair_first_n: np.ndarray  # occurrences of a pair's first word in the corpus


def _distinct(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of at least 0, the place of each, and how many are learned from."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.diff(keys, prepend=-1) > 0
    at = np.cumsum(new, dtype=np.int32)
    at -= 1  # -1 for the keys below 0, which come first
    known = np.searchsorted(keys, 0)
    n = np.bincount(at[known:][learned[order[known:]]], minlength=int(at[-1]) + 1 if len(at) else 0)
    places = np.empty(len(keys), np.int32)
    places[order] = at
    return keys[new], places, n.astype(np.uint32)


def _after(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """(place << 32 | key), -1 where either is below 0."""
    both = places.astype(np.int64)
    both <<= 32
    both |= keys
    both[(places < 0) | (keys < 0)] = -1
    return both


def grams(documents: bytes, tokens: bytes, words: bytes, n_documents: int) -> Grams:
    (held_out, learned, lengths), place, (ids, n) = unpacked(documents), unpacked(tokens)[0], unpacked(words)
    by_id = np.argsort(ids)
    known, known_n = np.append(START, ids[by_id]), np.append(n_documents, n[by_id])
    ids = ids[place]
    del place
    starts = np.cumsum(lengths) - lengths
    learned = np.repeat(learned > 0, lengths)
    before = np.roll(ids, 1)
    before[starts] = START
    before = _after(before, ids)
    pairs, pair_at, pair_n = _distinct(before, learned)
    del before
    context = np.roll(pair_at, 1)
    context[starts] = -1
    context = _after(context, ids)
    del ids
    triples, triple_at, triple_n = _distinct(context, learned)
    del context
    some = np.flatnonzero(known >= START)  # START is first, the unknown words come after it
    first_n = known_n[some][np.searchsorted(known[some], pairs >> 32)]
    return Grams(held_out, lengths, pairs, pair_at, triples, triple_at, pair_n, triple_n, first_n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ x >> np.uint64(32)).astype(np.int64) & 0x7FFFFFFF


def dealt(g: Grams, shards: int, tokens: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, its pairs, its triples), as places in the slice's. A word has a shard, and one more for
    each whole share of the tokens that it has, which its second words choose from."""
    parts = 1 + g.pair_first_n * shards // max(tokens, 1)
    shard = _mixed(g.pairs & 0xFFFFFFFF) % parts
    del parts
    shard = ((_mixed(g.pairs >> 32) + shard) % shards).astype(np.int32)
    triple_shard = shard[g.triples >> 32]
    pairs, triples = np.argsort(shard, kind="stable"), np.argsort(triple_shard, kind="stable")
    pair_ends = np.searchsorted(shard[pairs], np.arange(shards + 1))
    triple_ends = np.searchsorted(triple_shard[triples], np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(pair_ends)).tolist():
        yield i, pairs[pair_ends[i] : pair_ends[i + 1]], triples[triple_ends[i] : triple_ends[i + 1]]


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin, and the end."""
    return np.concatenate([np.flatnonzero(np.diff(x, prepend=-1)), [len(x)]])


#: Second words of one first word are sent as the steps between them.
MESSAGES = "shard int, slice long, grams binary"


_MESSAGES = pa.schema([("shard", pa.int32()), ("slice", pa.int64()), ("grams", pa.binary())])


def _messages(shards: int, tokens: int, n_documents: int):
    def run(slice_: pa.Table, ids: pa.Table) -> pa.Table:
        row = slice_.to_pylist()[0]
        g = grams(row["documents"], row["tokens"], ids["words"][0].as_py(), n_documents)
        sizes = np.bincount(g.triples >> 32, minlength=len(g.pairs)).astype(np.uint32)
        rows = []
        for shard, pairs, triples in dealt(g, shards, tokens):
            first = g.pairs[pairs] >> 32
            at = _runs(first)
            second = g.pairs[pairs] & 0xFFFFFFFF
            steps = np.diff(second, prepend=0)
            steps[at[:-1]] = second[at[:-1]]
            data = packed(
                first[at[:-1]].astype(np.uint32), g.pair_first_n[pairs][at[:-1]], np.diff(at).astype(np.uint32),
                steps.astype(np.uint32), g.pair_n[pairs], sizes[pairs],
                (g.triples[triples] & 0xFFFFFFFF).astype(np.uint32), g.triple_n[triples],
            )
            rows.append({"shard": shard, "slice": row["slice"], "grams": data})
        return pa.Table.from_pylist(rows, _MESSAGES)

    return run


# the trie of a shard


class Message(NamedTuple):
    first: np.ndarray  # of pairs
    first_n: np.ndarray
    second: np.ndarray
    pair_n: np.ndarray
    pair: np.ndarray  # of triples: the place of their pair
    third: np.ndarray
    triple_n: np.ndarray


def message(data: bytes) -> Message:
    first, first_n, sizes, steps, pair_n, triples, third, triple_n = unpacked(data)
    sums, starts = np.cumsum(steps, dtype=np.int64), np.cumsum(sizes, dtype=np.int64) - sizes
    second = (sums - np.repeat(sums[starts] - steps[starts], sizes)).astype(np.uint32)
    pair = np.repeat(np.arange(len(steps), dtype=np.int32), triples)
    return Message(np.repeat(first, sizes), np.repeat(first_n, sizes), second, pair_n, pair, third, triple_n)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys that were learned, their counts, and the place of every key, or -1."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.diff(keys, prepend=-1) > 0
    at = np.cumsum(new, dtype=np.int32)
    at -= 1
    keys = keys[new]
    n = np.bincount(at, counts[order], len(keys)).astype(np.int64)
    some = n > 0
    place = np.where(some, np.cumsum(some, dtype=np.int32) - 1, -1).astype(np.int32)[at]
    del at
    places = np.empty(len(order), np.int32)
    places[order] = place
    return keys[some], n[some], places


def _joined(arrays: Iterable[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *arrays])


def build(messages: list[Message]) -> bytes:
    """The trie of all messages' pairs and triples."""
    pairs, pair_n, at = _added(
        _joined(m.first.astype(np.int64) << 32 | m.second for m in messages), _joined(m.pair_n for m in messages)
    )
    first_n = np.zeros(len(pairs), np.int64)
    starts = np.cumsum([0] + [len(m.first) for m in messages])
    keys, counts = [], []
    for m, start in zip(messages, starts, strict=False):
        own = at[start : start + len(m.first)]
        first_n[own[own >= 0]] = m.first_n[own >= 0]
        # a triple that was learned has a pair that was
        context = own[m.pair]
        known = context >= 0
        keys.append(context[known].astype(np.int64) << 32 | m.third[known])
        counts.append(m.triple_n[known])
    del at
    keys = _joined(keys)
    triples, triple_n, _ = _added(keys, _joined(counts))
    del keys, counts
    roots = _runs(pairs >> 32)
    context = triples >> 32
    levels = [
        Monotone.encode((pairs >> 32)[roots[:-1]]),
        *Level.encode(np.diff(roots), pairs & 0xFFFFFFFF),
        *Level.encode(np.bincount(context, minlength=len(pairs)), triples & 0xFFFFFFFF),
        code_of(pair_n / (first_n + M2)).tobytes(),
        code_of(M3 / (pair_n + M3)).tobytes(),
        code_of(triple_n / (pair_n[context] + M3)).tobytes(),
    ]
    return packed(np.array([len(x) for x in levels], np.int64), *(np.frombuffer(x, np.uint8) for x in levels))


class Trie:
    def __init__(self, data: bytes) -> None:
        _, roots, *pairs_triples, shares, weights, triple_shares = unpacked(data)
        pair_pointers, pairs, triple_pointers, triples = pairs_triples
        self.roots = Monotone(roots)
        self.pairs = Level(Monotone(pair_pointers), Monotone(pairs))
        self.triples = Level(Monotone(triple_pointers), Monotone(triples))
        self.shares, self.weights, self.triple_shares = (x.view(np.uint16) for x in (shares, weights, triple_shares))

    def look_up(self, m: Message) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes: shares of pairs, weights of the shorter context behind pairs, shares of triples."""
        first = m.first.astype(np.int64)
        root = self.roots.successor(first)
        hit = root < self.roots.n
        hit[hit] = self.roots.value(root[hit]) == first[hit]
        pair = self.pairs.find(np.where(hit, root, -1), m.second.astype(np.int64))
        triple = self.triples.find(pair[m.pair], m.third.astype(np.int64))
        found = (self.shares, pair, _NONE), (self.weights, pair, 0), (self.triple_shares, triple, _NONE)
        return tuple(np.append(codes, np.uint16(none))[at] for codes, at, none in found)  # at -1: none


#: A shard's trie, with a null slice, or its answer to a slice's message.
ANSWERS = "shard int, slice long, codes binary"
_ANSWERS = pa.schema([("shard", pa.int32()), ("slice", pa.int64()), ("codes", pa.binary())])


def _answer(learn: bool):
    def run(table: pa.Table) -> pa.Table:
        """Without ``learn``, the row without a slice has the trie, if anything was learned."""
        rows = table.to_pylist()
        asked = [(r["slice"], message(r["grams"])) for r in rows if r["slice"] is not None]
        known = [r["grams"] for r in rows if r["slice"] is None]
        data = known[0] if known else build([m for _, m in asked] if learn else [])
        trie = Trie(data)
        out = [(number, packed(*trie.look_up(m))) for number, m in asked]
        if learn:
            out.append((None, data))
        return pa.Table.from_pylist([{"shard": rows[0]["shard"], "slice": s, "codes": c} for s, c in out], _ANSWERS)

    return run


# scores


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(shards: int, tokens: int, size: int, n_documents: int):
    def run(slice_: pa.Table, found: pa.Table) -> pa.Table:
        """``found``: the answers, and the word ids as those of shard -1."""
        row, codes = slice_.to_pylist()[0], {r["shard"]: r["codes"] for r in found.to_pylist()}
        g = grams(row["documents"], row["tokens"], codes[-1], n_documents)
        # a place more, for tokens without a pair or a triple
        share, triple_share = (np.full(len(x) + 1, _NONE, np.uint16) for x in (g.pairs, g.triples))
        weight = np.zeros(len(g.pairs) + 1, np.uint16)  # of 1
        for shard, pairs, triples in dealt(g, shards, tokens):
            share[pairs], weight[pairs], triple_share[triples] = unpacked(codes[shard])
        starts = np.cumsum(g.lengths) - g.lengths
        counts = unpacked(codes[-1])[1][unpacked(row["tokens"])[0]]
        before = np.roll(counts, 1)
        before[starts] = n_documents
        base = (counts + 0.1) / (tokens + 0.1 * (size + 1))
        n_known, base_score = np.add.reduceat(counts > 0, starts), np.add.reduceat(np.log10(base), starts)
        del counts
        two = share_of(share[g.pair_at]) + M2 / (before + M2) * base
        del before, base
        context = np.roll(g.pair_at, 1)
        context[starts] = -1
        three = share_of(triple_share[g.triple_at]) + share_of(weight[context]) * two
        score = np.add.reduceat(np.log10(three), starts)
        columns = [row["doc_ids"], g.held_out > 0, g.lengths, n_known.astype(np.int64), np.full(len(starts), tokens), base_score, score]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in SCORES.split(", ")])

    return run


class Model(NamedTuple):
    words: Vocabulary
    n_documents: int
    shards: int
    trie: DataFrame  # shard, codes


#: Columns of a slice that its pairs, triples and scores come from.
_CODED = ["slice", "doc_ids", "documents", "tokens"]


def _scored(sliced: DataFrame, ids: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    score = _score(model.shards, model.words.tokens, model.words.size, model.n_documents)
    own = ids.select(F.lit(-1).alias("shard"), "slice", F.col("words").alias("codes"))
    return sliced.select(_CODED).groupBy("slice").cogroup(answers.unionByName(own).groupBy("slice")).applyInArrow(score, SCORES)


def _asked(sliced: DataFrame, ids: DataFrame, shards: int, words: Vocabulary, n_documents: int) -> DataFrame:
    message = _messages(shards, words.tokens, n_documents)
    return sliced.select(_CODED).groupBy("slice").cogroup(ids.groupBy("slice")).applyInArrow(message, MESSAGES)


def learned_and_scored(docs: DataFrame, shard_tokens: int = SHARD) -> tuple[Model, DataFrame]:
    """The model of the documents to learn from, and the scores of all."""
    sliced = slices(docs)
    words = vocabulary(sliced)
    ends = words.words.filter("word = ''").select("n").first()
    n_documents = ends["n"] if ends else 0
    shards = max(1, -(-words.tokens // shard_tokens))
    ids = word_ids(sliced, words)
    asked = _asked(sliced, ids, shards, words, n_documents)
    answers = written(asked.groupBy("shard").applyInArrow(_answer(True), ANSWERS), "trie")
    model = Model(words, n_documents, shards, answers.filter("slice IS NULL").select("shard", "codes"))
    return model, _scored(sliced, ids, answers.filter("slice IS NOT NULL"), model)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of any documents by a model."""
    sliced = slices(docs)
    ids = word_ids(sliced, model.words)
    tries = model.trie.select("shard", F.lit(None).cast("long").alias("slice"), F.col("codes").alias("grams"))
    asked = _asked(sliced, ids, model.shards, model.words, model.n_documents).unionByName(tries)
    answers = asked.groupBy("shard").applyInArrow(_answer(False), ANSWERS)
    return _scored(sliced, ids, answers, model)


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per document, held out or not."""
    return learned_and_scored(docs)[1]
