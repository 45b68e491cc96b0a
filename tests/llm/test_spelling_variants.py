"""Operator 12 against all words with one edit undone, on the smallest tables and on odd rows."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import spelling_variants as sv
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, word string, n double, form string"


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_near(words):
    """Words that share a form with one place open or left out, compared one by one."""
    buckets = defaultdict(set)
    for w in words:
        buckets[w].add(w)
        for i in range(len(w)):
            buckets[w[:i] + w[i + 1 :]].add(w)
    near = {w: set() for w in words}
    for group in buckets.values():
        group = sorted(group)
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    return near


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = brute_words(rows)
    near = brute_near(n)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda t: (-n[t], t), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def rows_of(got):
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = brute(rows)
    assert rows_of(QUERIES["op12_variable_grams"](spark, SF)) == want
    assert sum(r[1] is not None for r in want) > 5 and sum(r[4] for r in want) > 100


def test_every_dictionary_and_dealt_lists(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for frequent, hot in [(1, sv.HOT), (50, 5), (10**9, 0)]:
        assert rows_of(sv.spelling_variants(docs, frequent, hot)) == want, (frequent, hot)


def edited(word, draw):
    i = int(draw.integers(0, len(word) + 1))
    letter = "abcé"[draw.integers(0, 4)]
    kind = draw.integers(0, 3)
    if kind == 0 or i == len(word):
        return word[:i] + letter + word[i:]
    return word[:i] + (letter if kind == 1 else "") + word[i + 1 :]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_near_words_meet_in_a_list(seed):
    """With a dictionary of some of the grams, whatever its order."""
    draw = np.random.default_rng(seed)
    word = "".join("abcé"[i] for i in draw.integers(0, int(draw.integers(1, 5)), int(draw.integers(7, 16))))
    other = edited(word, draw)
    if len(other) < 7 or other == word:
        return
    every = {sv.marked(w)[i : i + k] for w in (word, other) for k in (2, 3, 4) for i in range(len(w) + 3 - k)}
    some = sorted(g for g in every if len(g) == 2 or draw.random() < 0.5)
    draw.shuffle(some)
    grams = {g: (i, 1) for i, g in enumerate(some)}
    lists = [{t for t, _ in sv.indexed(w, grams)} for w in (word, other)]
    assert lists[0] & lists[1]
    assert list(sv.near_pairs([word, other])) and set(sv._parts(word)) & set(sv._parts(other))


def test_odd_rows(spark):
    long = " ".join(f"{w}ation" for w in ("organis", "organiz", "organs", "Organiz")) + " "
    rows = [(1, None), (2, ""), (3, " 12 "), (None, long * 3), (4, long * 40), (5, "Àéîõü÷×ß Àéîõü÷×ß àéîõü÷×ß Àéîõü÷×"), (6, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999)]
    rows += [(7, "shorter short sho"), (7, "shorter short sho"), (None, None), (8, "ORGANISATION" * 1 + " tab\torganisation\n")]
    data = [(i, t, None, "w", 0.5, None) for i, t in rows]
    got = sv.spelling_variants(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert rows_of(got) == brute(rows)
    assert rows_of(sv.spelling_variants(spark.createDataFrame([], SCHEMA))) == []


def test_forms_are_followed_to_the_last(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d"), ("y", "x")], "word string, form string")
    assert {r.word: r.root for r in sv.roots(rows).collect()} == dict.fromkeys("abcxy", "d")
