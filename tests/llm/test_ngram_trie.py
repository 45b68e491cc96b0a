"""Operator 11: its sequences and tries against plain lists, its scores against a plain model."""

import tracemalloc
from collections import Counter
from math import log10
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import ngram_trie as nt
from ledgerloom.llm.elias_fano import Level, Monotone
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, slice long, word string, score double"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 1 << 62)), max_size=200), st.lists(st.integers(0, 1 << 62), max_size=20))
def test_sorted_sequences(values, others):
    values = np.array(sorted(values), np.int64)
    found = Monotone(Monotone.encode(values))
    assert (found.value(np.arange(len(values))) == values).all()
    asked = np.unique(np.concatenate([values, values + 1, np.array(others, np.int64), [0, 1 << 62]]))
    assert (found.successor(asked) == np.searchsorted(values, asked)).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 1000), max_size=40), max_size=30), st.integers(0, 1000))
def test_levels(groups, other):
    names = np.array([x for g in groups for x in sorted(g)], np.int64)
    level = Level(*map(Monotone, Level.encode(np.array([len(g) for g in groups], np.int64), names)))
    node = np.array([i for i in range(-1, len(groups)) for _ in range(3)], np.int64)
    name = np.array([n for i in range(-1, len(groups)) for n in (other, 0, max(groups[i], default=7) if i >= 0 else 1)], np.int64)
    places = {(i, x): k for k, (i, x) in enumerate((i, x) for i, g in enumerate(groups) for x in sorted(g))}
    assert level.find(node, name).tolist() == [places.get((i, x), -1) for i, x in zip(node.tolist(), name.tolist())]


@given(st.lists(st.lists(st.integers(0, 1 << 40), max_size=30), max_size=4))
def test_packing(lists):
    arrays = [np.array(x, t) for x, t in zip(lists, (np.int64, np.uint64, np.int64, np.uint64))]
    assert [(a.tolist(), a.dtype) for a in nt.unpacked(nt.packed(*arrays))] == [(a.tolist(), a.dtype) for a in arrays]


class Brute:
    def __init__(self, rows):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        for doc_id, text in rows:
            if doc_id is not None and crc32(str(doc_id).encode()) % 10:
                t = self.tokens(text)
                self.one.update(t)
                self.one["<"] += 1
                t = ["<", *t]
                self.two.update(zip(t, t[1:]))
                self.three.update(zip(t, t[1:], t[2:]))
        self.starts = self.one.pop("<", 0)
        self.n, self.v = sum(self.one.values()), len(self.one)

    @staticmethod
    def tokens(text):
        words = "".join(" " if c in " \t\n\v\f\r" else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
        return [w for w in words if w] + ["</"]

    def base(self, w):
        return (self.one[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def seen(self, w):
        return self.starts if w == "<" else self.one[w]

    def p(self, u, v, w):
        two = (self.two[v, w] + nt.M2 * self.base(w)) / (self.seen(v) + nt.M2)
        return two if u is None else (self.three[u, v, w] + nt.M3 * two) / (self.two[u, v] + nt.M3)

    def row(self, doc_id, text):
        t = self.tokens(text)
        before = [None, "<", *t]
        score = sum(log10(self.p(*x)) for x in zip(before, before[1:], t))
        held = doc_id is not None and crc32(str(doc_id).encode()) % 10 == 0
        return (doc_id, held, len(t), sum(self.one[w] > 0 for w in t), self.n, sum(log10(self.base(w)) for w in t), score)


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-6)
        # shares and weights are within half a step of 1/4096 decade
        assert g[6] == pytest.approx(w[6], abs=g[2] / nt.STEPS + 1e-9)


def test_query_against_a_plain_model(spark, monkeypatch):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    model = Brute(rows)
    got = QUERIES["op11_elias_fano_trie"](spark, SF).collect()
    compare(got, [model.row(*r) for r in rows])
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # many slices and shards, a word over several of them
    monkeypatch.setattr(nt, "SLICE", 20_000)
    learned, again = nt.learned_and_scored(docs, 3000)
    assert learned.shards > 8
    compare(again.collect(), [model.row(*r) for r in rows])
    # the same model on texts it has not seen
    others = [(1, "the of and"), (2, "unseen words only here"), (10**6, None), (None, " ".join(rows[0][1].split()[5:40]))]
    compare(nt.scores(spark.createDataFrame(others, "doc_id long, text string"), learned).collect(), [model.row(*r) for r in others])


def test_probabilities_add_up_to_one():
    rows = [(i, f"a b c a b {'abcde'[i % 5]} d a") for i in range(40)]
    model = Brute(rows)
    for u, v in [("a", "b"), (None, "<"), ("<", "a"), ("zz", "a"), ("c", "zz")]:
        assert sum(model.p(u, v, w) for w in [*model.one, "unknown"]) == pytest.approx(1)


def test_odd_rows(spark):
    texts = [None, "", " \t\n ", "one", "One ONE\none", "Äpfel ÄPFEL äpfel \x01 中文 🙂", " ".join(f"w{i % 97}" for i in range(20_000))]
    rows = [(i, t, None, 7, "w", 0.5) for i, t in enumerate(texts)] + [(None, "one one", "en", None, None, None)]
    rows += [rows[4], rows[4], (None, None, None, None, None, None)]
    want = Brute([r[:2] for r in rows])
    got = nt.lm_scores(spark.createDataFrame(rows, SCHEMA).repartition(3))
    compare(got.collect(), [want.row(*r[:2]) for r in rows])
    none = nt.lm_scores(spark.createDataFrame([], SCHEMA))
    assert none.columns == got.columns and none.count() == 0
    held = [r for r in range(100) if crc32(str(r).encode()) % 10 == 0]
    nothing = nt.lm_scores(spark.createDataFrame([(held[0], "some text", None, 1, "w", 0.5), (None, "x", None, 1, "w", 0.5)], SCHEMA))
    assert [(r.base_score, r.score, r.train_tokens, r.n_known) for r in nothing.collect()] == [(0, 0, 0, 0)] * 2


def peak_of(call):
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_slice_takes_few_bytes_a_token():
    draw = np.random.default_rng(1)
    n, n_words = 300_000, 20_000
    place = (draw.zipf(1.3, n) % n_words).astype(np.uint32)
    documents = nt.packed(*(np.array([x] * 300) for x in (0, 1, n // 300)))
    words = nt.packed(np.append(draw.permutation(n_words - 1) + 1, nt.UNKNOWN), np.append(np.arange(1, n_words), 0))
    args = documents, nt.packed(place), words, 300
    assert peak_of(lambda: nt.grams(*args)) < 80 * n
    g, shards = nt.grams(*args), 4
    assert (g.pair_n.sum(), g.triple_n.sum()) == ((g.pair_at >= 0).sum(), (g.triple_at >= 0).sum())
    slice_ = pa.Table.from_pylist([{"slice": 7, "doc_ids": list(range(300)), "documents": documents, "tokens": args[1]}])
    asked = nt._messages(shards, n, 300)(slice_, pa.table({"words": [words]}))
    messages = [nt.message(r["grams"]) for r in asked.to_pylist()]
    n_grams = sum(len(m.first) + len(m.third) for m in messages)
    assert n_grams == len(g.pairs) + len(g.triples)
    assert peak_of(lambda: nt.build(messages)) < 110 * n_grams
