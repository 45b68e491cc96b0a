"""Operator 6: toxicity of texts restored from obfuscation through a noisy channel.

A writer's word reaches us through a channel that swaps letters for look-alikes, puts
separators between them and repeats them. A token that the channel may have touched is a
lattice: each character stands for itself, for the letters it resembles, or for nothing.
Viterbi search finds the likeliest letters under a character trigram model, which mixes
the trigrams of all documents with those of the lexicon. Letters that stand alone in a row
are one token. A token of letters only has but one path, unless a letter is there three
times in a row, or twice and the word without repetitions is in the lexicon without them.
Look-alikes at a token's edge may be letters or punctuation: the better reading counts.

The lexicon is learned from labels: whole words and word beginnings of 3 to 8 letters that
are far more frequent in toxic texts. A text's evidence is the log odds of its strongest word,
and of all its words together; a logistic curve maps it to a score. Labels are learned from a bounded sample, the
``MOST`` documents of each label with the smallest hash of their doc_id, each distinct text
once. The character model and the scores cover all whole texts.

Empty and null texts have the evidence 0. Without labels of both kinds every score is 0:
nothing is known to be toxic. Null labels, and doc_ids whose labels disagree, are not
learned from. Repeated rows get equal scores. An empty table gives an empty table. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import COUNTS, fold, rows_of, summed, text_of, written
from ledgerloom.llm.quality_model import labelled, sample

MOST, SAMPLE_TASKS = 10_000, 16
#: A document counts as toxic from this score on.
CUT = 0.3
#: Entries need this many toxic texts, and share of them, log odds, and standard scores.
LEAST, SHARE, ODDS, STANDARD = 3, 0.01, 2.5, 4.5
#: Entries of the lexicon, the best ones. Words whose evidence a worker keeps.
ENTRIES, KEPT_WORDS = 2000, 300_000
BEGINNINGS = range(3, 9)

# fixed values: what characters may stand for, and what each step of the channel costs
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c",
}
SWAP, DROP_LOOKALIKE, DROP_OTHER, DROP_REPEAT, ANY_LETTER = 0.7, 6.0, 0.5, 1.0, 3.0

_EDGE = re.compile(r"^[^\w$@]+|[^\w$@]+$|^\$\$\$+|\$\$\$+$|^_+|_+$")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_REPEATED = re.compile(r"([^\W\d_])\1+")
_SPACED = re.compile(r" (\w(?: \w){3,})(?!\w)")
_SPACED_SIGNS = re.compile(r"(?<!\S)[\w@$!|+€£(<](?:\s+[\w@$!|+€£(<]){3,}(?!\w)")
_PUNCTUATION = ".,;:!?'\"()[]{}"
_SIGNS = "@$!|+€£(<"
_NO_LETTERS = ".,;:?'\")[]{}>*~-_#=/"

#: Classes of the character model: 0 edge of a word, 1-26 a-z, 27 any other letter.
SIZE = 28
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[192:] = 27


def class_of(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def trigrams(text: str) -> np.ndarray:
    """Counts of three classes in a row in a text's words."""
    data = np.frombuffer(f"  {text.lower()}  ".encode(), np.uint8)
    at = _CLASS[data[(data & 0xC0) != 0x80]]
    return np.bincount((at[:-2] * SIZE + at[1:-1]) * SIZE + at[2:], minlength=SIZE**3)


def log_model(counts: np.ndarray, strength: float = 5.0) -> np.ndarray:
    """Probability of a class after two others, each order smoothed by the one below."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    one = (three.sum((0, 1)) + 1) / (three.sum() + SIZE)
    two = three.sum(0)
    two = (two + strength * one) / (two.sum(1, keepdims=True) + strength)
    return (three + strength * two) / (three.sum(2, keepdims=True) + strength)


class Restorer:
    def __init__(self, corpus: np.ndarray, lexicon: Iterable[str]):
        own = np.zeros(SIZE**3, np.int64)
        for entry in lexicon:
            codes = [0, 0, *map(class_of, entry.lstrip("=")), *([0] if entry.startswith("=") else [])]
            for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
                own[(a * SIZE + b) * SIZE + c] += 1
        self.cost = (-np.log(0.5 * log_model(corpus) + 0.5 * log_model(own, 0.5))).tolist()

    def lattice(self, token: str) -> Iterator[list[tuple[str, float]]]:
        """For each character the letters it may be ("" for none) and the channel's cost."""
        before = ""
        for char in token:
            if char.isalpha():
                steps = [(char, 0.0)]
            elif char in LOOKALIKES:
                steps = [(letter, SWAP) for letter in LOOKALIKES[char]] + [("", DROP_LOOKALIKE)]
            elif char == "*":
                steps = [("", DROP_OTHER)] + [(letter, ANY_LETTER) for letter in "aeiou"]
            else:
                steps = [("", DROP_OTHER)]
            if char == before and steps[-1][0]:
                steps.append(("", DROP_REPEAT))
            elif char == before:
                steps[-1] = ("", min(DROP_REPEAT, steps[-1][1]))
            before = char
            yield steps

    def restore(self, token: str) -> str:
        """The likeliest word behind a token."""
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for steps in self.lattice(token):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in paths.items():
                row = self.cost[a][b]
                for letter, extra in steps:
                    if letter:
                        code = class_of(letter)
                        state, total, way = (b, code), cost + extra + row[code], (letter, path)
                    else:
                        state, total, way = (a, b), cost + extra, path
                    if state not in after or total < after[state][0]:
                        after[state] = total, way
            paths = after
        _, way = min((cost + self.cost[a][b][0], i, path) for i, ((a, b), (cost, path)) in enumerate(paths.items()))[1:]
        letters = []
        while way:
            letters.append(way[0])
            way = way[1]
        return "".join(reversed(letters))


def plain(token: str) -> tuple[str, bool]:
    """A lower-case token without its edges, and whether the channel may have touched it."""
    core = token.strip(_PUNCTUATION)
    if not core.isalpha():
        core = _EDGE.sub("", _EDGE.sub("", token))
    if core.isalpha():
        return core, _TRIPLE.search(core) is not None
    return core, any(c.isalpha() for c in core)


def entries_of(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself, and its beginnings."""
    return ["=" + word, *(word[:n] for n in BEGINNINGS if n < len(word))]


class Model(NamedTuple):
    corpus: np.ndarray
    lexicon: dict[str, float]
    weights: np.ndarray
    shift: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights + self.shift, -30, 30)))

    def evidence_of(self) -> WordEvidence:
        return WordEvidence(self)


class WordEvidence:
    """Evidence of texts, with words seen before kept."""

    def __init__(self, model: Model):
        self.lexicon = model.lexicon
        self.restorer = Restorer(model.corpus, model.lexicon)
        self.known: dict[str, float] = {}
        self.collapsed = {_REPEATED.sub(r"\1", entry) for entry in model.lexicon}

    def _may_repeat(self, word: str) -> bool:
        """Whether the lexicon may have a word that this one repeats letters of."""
        short = _REPEATED.sub(r"\1", word)
        return len(short) < len(word) and any(e in self.collapsed for e in ("=" + short, *(short[:n] for n in range(2, 9))))

    def _word(self, word: str) -> float:
        get = self.lexicon.get
        most = get("=" + word, 0.0)
        for n in BEGINNINGS:
            if n >= len(word):
                break
            odds = get(word[:n])
            if odds is not None and odds > most:
                most = odds
        return most

    def _token(self, token: str) -> float:
        core, touched = plain(token)
        most = self._word(core) if core.isalpha() else 0.0
        if touched or (core.isalpha() and self._may_repeat(core)):
            most = max(most, self._word(self.restorer.restore(core)))
        wide = token.strip(_NO_LETTERS)
        if len(wide) > len(core) and any(map(str.isalpha, wide)):
            for edged in {wide, wide.lstrip(_SIGNS), wide.rstrip(_SIGNS)} - {core}:
                most = max(most, self._word(self.restorer.restore(edged)))
        return most

    def _spaced(self, low: str) -> Iterator[set[str]]:
        """Readings of each run of letters that stand alone: look-alikes at its ends, and
        among its letters, may be letters or not."""
        for run in _SPACED_SIGNS.findall(low):
            letters = "".join(run.split())
            readings = {x.replace(" ", "") for x in _SPACED.findall(" " + " ".join(run.split()))}
            if any(map(str.isalpha, letters)):
                readings |= {letters, letters.lstrip(_SIGNS), letters.rstrip(_SIGNS)}
            if readings:
                yield readings

    def text(self, text: str) -> list[float]:
        """The strongest word's log odds, and those of all distinct words together: their
        sum, and their mean. The last two level off."""
        low = text.lower()
        tokens = set(low.split())
        if len(self.known) > KEPT_WORDS:
            self.known = {t: self.known[t] for t in tokens if t in self.known}
        for token in tokens:
            if token not in self.known:
                self.known[token] = self._token(token)
        found = [x for x in map(self.known.__getitem__, tokens) if x]
        for readings in self._spaced(low):
            words = [self.restorer.restore(letters) for letters in readings]
            # single letters that are words may stand before and after the spaced word
            found.append(max(self._word(word[i:]) for word in words for i in range(max(1, len(word) - 2))))
        total = sum(sorted(found))
        mean = 100 * total / (len(tokens) + 20)
        return [max(found, default=0.0), 30 * total / (30 + total), 30 * mean / (30 + mean)]


def _trigrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SIZE**3, np.int64)
    for batch in batches:
        for part in rows_of(batch):
            for text in part.column("text").to_pylist():
                counts += trigrams(text)
    yield pa.RecordBatch.from_arrays([pa.array(["all"]), pa.array([counts.tobytes()])], ["name", "counts"])


def _entries(allowed: set[str] | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = {plain(t)[0] for t in set(text.lower().split())}
                own = {e for w in words if w.isalpha() for e in entries_of(w)}
                found.update(own if allowed is None else own & allowed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["entry", "n"]
        )

    return run


def _lexicon(some: DataFrame, sizes: dict[int, int]) -> dict[str, float]:
    """Log odds of the entries of toxic texts that stand out. Entries found in fewer than
    ``SHARE`` of them don't reach the driver, so what does is bounded by a text's length."""
    n_toxic, n_clean = sizes[1], sizes[0]
    least = max(LEAST, SHARE * n_toxic)

    def counted(y: int, allowed: set[str] | None) -> DataFrame:
        rows = some.filter(F.col("y") == y).select("text").mapInArrow(_entries(allowed), "entry string, n long")
        return rows.groupBy("entry").agg(F.sum("n").alias("n"))

    toxic = {r["entry"]: r["n"] for r in counted(1, None).filter(F.col("n") >= least).collect()}
    clean = {r["entry"]: r["n"] for r in counted(0, set(toxic)).collect()}
    kept = []
    for entry, n in toxic.items():
        other = clean.get(entry, 0)
        odds = np.log((n + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_clean + 1))
        both = (n + other) / (n_toxic + n_clean)
        apart = (n / n_toxic - other / n_clean) / np.sqrt(both * (1 - both) * (1 / n_toxic + 1 / n_clean) + 1e-12)
        if odds >= ODDS and apart >= STANDARD:
            kept.append((-odds * np.sqrt(n), entry, float(odds)))
    return {entry: odds for _, entry, odds in sorted(kept)[:ENTRIES]}


def _calibrated(evidence: np.ndarray, y: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Weights and shift of the logistic curve, at the labels' true shares. Each class
    counts one more text in the middle, so that clear-cut samples have finite weights."""
    middle = np.median(evidence[y == 1], axis=0) / 2
    x = np.concatenate([evidence, [middle, middle]])
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    target = np.concatenate([y, [0, 1]]).astype(float)
    weight = np.where(target == 1, share / (target == 1).sum(), (1 - share) / (target == 0).sum())
    hold = np.array([1e-4] * evidence.shape[1] + [1e-7])
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (weight * (target - p)) - hold * w)
        step *= min(1.0, 1 / (np.abs(step).max() + 1e-12))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model | None:
    known = labelled(labels, "toxic", fold(by=4) != 2)
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    some = written(sample(docs, known, most).withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "y"]).repartition(SAMPLE_TASKS, "h"), "toxic-sample")
    sizes = {r["y"]: r["count"] for r in some.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return None
    corpus = summed(docs.select(text_of().alias("text")).mapInArrow(_trigrams, COUNTS))["all"]
    model = Model(corpus, _lexicon(some, sizes), np.zeros(3), 0.0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.evidence_of()
        for batch in batches:
            found = [of.text(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.float64()))], ["y", "evidence"])

    rows = some.select("y", "text").mapInArrow(run, "y int, evidence array<double>").collect()  # 2 * most at most
    table = np.array(sorted((r["y"], *r["evidence"]) for r in rows))
    weights, shift = _calibrated(table[:, 1:], table[:, 0], counts[1] / (counts[0] + counts[1]))
    return model._replace(weights=weights, shift=shift)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.evidence_of() if model else None
        for batch in batches:
            for part in rows_of(batch):
                texts = part.column("text").to_pylist()
                if of is None:
                    scores = np.zeros(len(texts))
                else:
                    scores = model.score(np.array([of.text(t) for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    found = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(fold(by=4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return scored(docs, learn(docs, labels))
