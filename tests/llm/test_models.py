"""The learned operators' inner steps against plain versions that try everything."""

from itertools import product
from math import exp, log1p

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import language, quality_model, toxicity

LEXICON = ["=idiot", "stupi", "=trash", "loser"]


def restorer():
    counts = sum(toxicity.trigrams(t) for t in ["the quick brown fox and the lazy dog", "idiot loser trash stupid stupidity", "this is it"])
    return toxicity.Restorer(counts, LEXICON)


RESTORER = restorer()


def all_paths(token):
    """Each word that the lattice may mean, with its cheapest path."""
    words = {}
    for path in product(*RESTORER.lattice(token)):
        word = "".join(letter for letter, _ in path)
        codes = [0, 0, *map(toxicity.class_of, word), 0]
        cost = sum(extra for _, extra in path) + sum(RESTORER.cost[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:]))
        words[word] = min(cost, words.get(word, cost))
    return words


@settings(max_examples=120, deadline=None)
@given(st.text("idotshlersp@1!0$*.-é", min_size=1, max_size=7))
def test_viterbi_finds_the_cheapest_of_all_paths(token):
    words = all_paths(token)
    found = RESTORER.restore(token)
    assert words[found] == pytest.approx(min(words.values()))


def test_restored_words():
    for token in ("id1ot", "i.d.i.o.t", "iidiot", "!diot", "1d!0t"):
        assert RESTORER.restore(token) == "idiot", token


@pytest.mark.parametrize("n", [2, 3, 5, 9])
def test_codeword_of_least_loss_among_all(n):
    draw = np.random.default_rng(n)
    counts = draw.integers(0, 200, (n, language.BUCKETS))
    model = language.fit([f"l{i}" for i in range(n)], counts)
    for turn in range(30):
        own = draw.multinomial(300, counts[turn % n] / counts[turn % n].sum())
        total = int(own.sum())
        losses = []
        for i in range(n):
            loss = 0.0
            for b in range(model.codes.shape[1]):
                margin = 4 * sum(float(c) * float(model.odds[k, b]) for k, c in enumerate(own) if c) / total / model.scale[b]
                loss += model.weight[b] * log1p(exp(-model.codes[i, b] * margin))
            losses.append(loss)
        lang, score, ambiguous = model.predict(own)
        best, second = sorted(losses)[:2]
        assert lang == f"l{losses.index(best)}" and ambiguous == (second - best < language.AMBIGUOUS)
        assert 1 / n - 1e-9 <= score <= 1


@pytest.mark.parametrize("n", [2, 4, 6, 7, 40])
def test_codewords_differ_and_halve(n):
    codes = language.codewords(n)
    assert len({tuple(row) for row in codes.tolist()}) == n
    assert (np.abs(codes.sum(0)) < n).all()  # every bit tells some from others


def test_newton_steps_reach_what_slow_descent_does():
    draw = np.random.default_rng(5)
    rows = draw.normal(size=(80, 4))
    y = (rows @ [1.0, -2.0, 0.5, 0] + draw.normal(size=80) > 0).astype(int)
    model = quality_model.fit(rows, y, 0.5)
    scaled = np.clip((rows - rows.mean(0)) / (rows.std(0) + 1e-6), -6, 6)
    good, bad = scaled[y == 1], scaled[y == 0]
    pairs_of = np.random.default_rng(7)
    n = quality_model.PAIRS * max(len(good), len(bad))
    pairs = good[pairs_of.integers(len(good), size=n)] - bad[pairs_of.integers(len(bad), size=n)]
    weights = np.zeros(4)
    for _ in range(60_000):
        weights += 0.2 * (pairs.T @ (1 / (1 + np.exp(pairs @ weights))) / n - 1e-3 * weights)
    assert model.weights == pytest.approx(weights, abs=2e-3)
    # every pair, plainly: the share that the strengths put in the right order
    strength = model.strength(rows)
    right = np.mean([a > b for a in strength[y == 1] for b in strength[y == 0]])
    assert right > 0.9 and model.score(rows)[strength.argmax()] == model.score(rows).max()
