"""Operator 9: byte-level BPE by merge replay over the words of a corpus slice.

A task gathers the distinct pieces (matches of the splitting pattern) of its slice of the
corpus and encodes them together. All pieces lie in one array of tokens with links to the
neighbours. An inverted index leads from each adjacent token pair to its positions; merges
are taken in rank order, each is applied to all positions of its pair at once, and only
the pairs with touched neighbours are entered anew. A piece is thus encoded once for each
slice, however often it occurs, and runs seen before are kept.

Rank order over all pieces gives each piece the merges that it would get on its own, with
one exception that is dealt with: where a merge makes a token that is the start or end of
an earlier-ranked token, a piece with several places for the merge takes the first only,
since the pair that it makes there may come before the others.

The join of whole-corpus words back to their documents would shuffle several times the
corpus; a slice for each task needs no shuffle at all.

A null text is empty: no ids, and the digest of nothing. Repeated rows and null doc_ids
each have their row; an empty table has none. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerloom.llm.common import rows_of, text_of
from ledgerloom.llm.ids import CUT_OFF, runs

#: Runs kept by a worker between slices.
KEPT_RUNS = 600_000
#: The splitting pattern for which a run of a text can be cut off at spaces. Texts are
#: encoded whole by any other.
CUT_BY = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def early_parts(ranks: dict[bytes, int]) -> set[int]:
    """Ranks of tokens that start or end a token of lower rank."""
    found = set()
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            for part in (token[:cut], token[cut:]):
                if ranks.get(part, -1) > rank:
                    found.add(ranks[part])
    return found


class MergeReplay:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.first_only = early_parts(ranks)
        self.base = max(ranks.values()) + 1
        self.rank_of_pair: dict[int, int] = {}

    def _rank(self, pair: int) -> int:
        """The rank of a pair's merge, -1 if the two tokens don't merge."""
        rank = self.rank_of_pair.get(pair)
        if rank is None:
            left, right = divmod(pair, self.base)
            rank = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
            self.rank_of_pair[pair] = rank
        return rank

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. A word that is a token itself has that id."""
        get = self.ranks.get
        out = [None if rank is None else [rank] for rank in map(get, words)]
        several = [i for i, ids in enumerate(out) if ids is None]
        if several:
            tokens, sizes = self._replay([words[i] for i in several])
            tokens, ends = tokens.tolist(), np.cumsum(sizes).tolist()
            for i, start, end in zip(several, [0, *ends], ends, strict=False):
                out[i] = tokens[start:end]
        return out

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words])
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        after = np.arange(1, len(token) + 1)
        before = np.arange(-1, len(token) - 1)
        ends = np.cumsum(sizes)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        alive = np.ones(len(token), bool)
        index: dict[int, list[np.ndarray]] = {}  # token pair -> positions of its left token
        queue: list[tuple[int, int]] = []  # (rank, pair)

        def enter(pairs: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(pairs, kind="stable")
            pairs, at = pairs[order], at[order]
            cuts = np.flatnonzero(np.diff(pairs)) + 1
            heads = pairs[np.concatenate([[0], cuts])].tolist() if len(pairs) else []
            for pair, where in zip(heads, np.split(at, cuts), strict=False):
                rank = self._rank(pair)
                if rank < 0:
                    continue
                if pair not in index:
                    index[pair] = []
                    heapq.heappush(queue, (rank, pair))
                index[pair].append(where)

        left = np.flatnonzero(after >= 0)
        enter(token[left] * self.base + token[left + 1], left)
        while queue:
            rank = queue[0][0]
            found = []
            while queue and queue[0][0] == rank:  # pairs of different tokens may make the same one
                pair = heapq.heappop(queue)[1]
                at = np.unique(np.concatenate(index.pop(pair)))
                at = at[alive[at] & (after[at] >= 0)]
                found.append(at[token[at] * self.base + token[after[at]] == pair])
            at = found[0] if len(found) == 1 else np.sort(np.concatenate(found))
            if rank in self.first_only:
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]]) if len(at) else np.zeros(0, bool)
                later, at = at[~first], at[first]
            else:
                later = at[:0]
                # of places that overlap, every second one, counted from the left
                touch = np.flatnonzero(after[at[:-1]] == at[1:]) + 1
                if len(touch):
                    linked = np.zeros(len(at), bool)
                    linked[touch] = True
                    place = np.arange(len(at))
                    start = np.maximum.accumulate(np.where(linked, 0, place))
                    at = at[(place - start) % 2 == 0]
            if len(at):
                right = after[at]
                token[at] = rank
                alive[right] = False
                follows = after[right]
                after[at] = follows
                has = follows >= 0
                before[follows[has]] = at[has]
                precedes = before[at]
                led = precedes >= 0
                enter(
                    np.concatenate([token[precedes[led]] * self.base + rank, rank * self.base + token[follows[has]]]),
                    np.concatenate([precedes[led], at[has]]),
                )
            if len(later):
                later = later[alive[later] & (after[later] >= 0)]
                enter(token[later] * self.base + token[after[later]], later)
        return token[alive], np.bincount(word[alive], minlength=len(words))


@lru_cache(maxsize=1)
def replay_of(path: str) -> MergeReplay:
    return MergeReplay(read_ranks(path))


@lru_cache(maxsize=1)
def known_runs(path: str, pattern: str) -> dict[str, tuple[bytes, bytes]]:
    """Runs that a worker's tasks have met: their ids, and the ids' decimals."""
    return {}


def _run(path: str, pattern: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, pieces_of = replay_of(path), regex.compile(pattern).findall
        table = [replay.bytes_of.get(i, b"") for i in range(replay.base)]
        four = [i.to_bytes(4, "little") for i in range(replay.base)]
        decimal = [b"%d" % i for i in range(replay.base)]
        known = known_runs(path, pattern)

        def cut(x: str) -> list[str]:
            if x[0] == " " and pattern == CUT_BY:  # a word, and a mark behind it: nothing to search
                if x[1:].isalpha():
                    return [x]
                if x[-1] in CUT_OFF and x[1:-1].isalpha():
                    return [x[:-1], x[-1]]
            return pieces_of(x)

        def learn(new: list[str]) -> None:
            of_run = [cut(x) for x in new]
            words = list(set().union(*of_run))
            coded = {}
            for word, ids in zip(words, replay.encode([w.encode() for w in words]), strict=True):
                coded[word] = b"".join([four[i] for i in ids]), b",".join([decimal[i] for i in ids])
            for x, pieces in zip(new, of_run, strict=True):
                if len(pieces) == 1:
                    known[x] = coded[pieces[0]]
                else:
                    found = [coded[p] for p in pieces]
                    known[x] = b"".join([a for a, _ in found]), b",".join([b for _, b in found])

        for batch in batches:
            for part in rows_of(batch):
                texts = []
                for text in part.column("text").to_pylist():
                    first, rest = runs(text) if pattern == CUT_BY else ([text] if text else [], [])
                    texts.append(first + [" " + x for x in rest])
                new = set().union(*texts)
                if len(known) > KEPT_RUNS:
                    for x in [x for x in known if x not in new]:
                        del known[x]
                missing = [x for x in new if x not in known]
                if missing:
                    learn(missing)
                sizes, coded, decoded = [], [], []
                for text in texts:
                    found = [known[x] for x in text]
                    ids = np.frombuffer(b"".join([a for a, _ in found]), "<u4").tolist()
                    sizes.append(len(ids))
                    coded.append(hashlib.sha256(b",".join([b for _, b in found])).hexdigest())
                    decoded.append(hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest())
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(coded), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, and digests of the ids and of their decoded bytes."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(_run(ranks_path, pattern), schema)


def encode_texts(replay: MergeReplay, texts: list[str], pattern: str) -> list[list[int]]:
    """Ids of whole texts in memory, for callers with a few of them."""
    cut = [regex.findall(pattern, text) for text in texts]
    words = list(set().union(*cut))
    ids_of = dict(zip(words, replay.encode([w.encode() for w in words]), strict=True))
    return [[i for piece in pieces for i in ids_of[piece]] for pieces in cut]
