"""Operator 4: a quality score learned from preferences (Bradley-Terry).

A labelled good document is preferred to a labelled bad one; the probability of a
preference is the logistic function of the difference of two scores, and a score is linear
in a document's features. Weights come from the logistic loss on feature differences over
many pairs. The model cuts the scores at a quantile of the sample's scores, the one that
makes the fewest errors at the classes' true shares, and maps them to 0..1 so that the cut
is at ``CUT``.

Labels are learned from a bounded sample: ``MOST`` texts of each label, those with the
smallest hash of doc_id and text. All other work is one pass over all whole texts.

Documents without text get the score of their (constant) features. With no label, or only
one, there is nothing to prefer: every score is then 0.5, which keeps the document. Null
labels, and doc_ids whose labels disagree, are not learned from. Repeated rows get equal
scores. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, fold, keep_where, rows_of, text_hash, text_of

#: Documents of each label that the model learns from, and pairs for each of them.
MOST, PAIRS = 4000, 12
#: The score from which on a document counts as good.
CUT = 0.3

_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = bytes(b for b in range(33, 127) if b not in _LETTERS + _DIGITS + _MARKS)
_CONTROL = bytes(b for b in range(32) if chr(b) not in SPACES) + b"\x7f"


def features(text: str) -> list[float]:
    """Shares and counts of one whole text."""
    data = text.encode()
    words = data.split()
    n, size = len(words) or 1, len(data) or 1

    def many(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    letters, upper = many(_LETTERS), many(_UPPER)
    often = Counter(words)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    most = max(often.values(), default=0)
    return [
        np.log1p(len(words)),
        min(many(_SYMBOLS) / n, 2.0),
        np.sqrt(many(_SYMBOLS) / size),
        min(data.count(b"!") / n, 1.0),
        min(data.count(b"|") / n, 1.0),
        upper / (letters or 1),
        letters / size,
        many(_DIGITS) / size,
        min(many(_MARKS) / n, 2.0),
        min(data.count(b".") / n, 1.0),
        min(data.count(b"http") / n, 1.0),
        many(_CONTROL) / size,
        data.count("�".encode()) / n,
        np.log((len(often) + 1) / (len(words) + 1)),
        most / n if n > 20 else 0.0,
        same / n,
        min(sum(map(len, words)) / n, 30.0) / 10,
        np.log1p(len(words) / (len(lines) or 1)),
        (len(lines) - len(set(lines))) / (len(lines) or 1),
    ]


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.spread, -6, 6) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        at = self.slope * (self.strength(rows) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -30, 30)))


def labelled(labels: DataFrame, column: str, learn: Column) -> DataFrame:
    """doc_id and y (0 or 1) of the rows to learn from."""
    known = labels.filter(learn).select("doc_id", F.col(column).cast("int").alias("y")).filter(F.col("y").isin(0, 1))
    agreed = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other"))
    return agreed.filter("y = other").select("doc_id", "y")


def sample(docs: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """y and text of at most ``most`` texts of each label, by hash of doc_id and text. Rows
    that repeat both count once. The sides that are broadcast have at most twice ``most`` keys."""

    def few(rows: DataFrame, *by: str) -> DataFrame:
        some = [rows.filter(F.col("y") == y).orderBy(F.xxhash64(*by), *by).limit(most) for y in (0, 1)]
        return some[0].unionByName(some[1])

    texts = docs.select("doc_id", text_of().alias("text"))
    chosen = few(known, "doc_id").withColumnRenamed("doc_id", "_id")
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")
    keys = joined.select("doc_id", "y", text_hash("text")).distinct()
    wanted = few(keys, "doc_id", "text_sha").select(F.col("doc_id").alias("_id"), F.col("text_sha").alias("_sha"), "y")
    same = (F.col("doc_id") == F.col("_id")) & (text_hash("text") == F.col("_sha"))
    return texts.join(F.broadcast(wanted), same).dropDuplicates(["_id", "_sha"]).select("doc_id", "y", "text")


def fit(rows: np.ndarray, y: np.ndarray, share: float) -> Model | None:
    """``share``: of all labels, that of 1."""
    good, bad = rows[y == 1], rows[y == 0]
    if not len(good) or not len(bad):
        return None
    mean, spread = rows.mean(0), rows.std(0) + 1e-6
    good, bad = (np.clip((x - mean) / spread, -6, 6) for x in (good, bad))
    draw, n = np.random.default_rng(7), PAIRS * max(len(good), len(bad))
    pairs = good[draw.integers(len(good), size=n)] - bad[draw.integers(len(bad), size=n)]
    weights = np.zeros(rows.shape[1])
    for _ in range(30):  # Newton steps of the penalised logistic loss
        p = 1 / (1 + np.exp(-np.clip(pairs @ weights, -30, 30)))
        slope = pairs.T @ (1 - p) / n - 1e-3 * weights
        curve = (pairs * (p * (1 - p))[:, None]).T @ pairs / n + 1e-3 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    up, down = good @ weights, bad @ weights
    scores = np.concatenate([up, down])
    weight = np.concatenate([np.full(len(up), share / len(up)), np.full(len(down), (1 - share) / len(down))])
    # the quantile of the sample's scores with the least weight on the wrong side
    order = np.argsort(scores, kind="stable")
    ranked, is_good = scores[order], order < len(up)
    wrong = np.concatenate([[0], np.cumsum(np.where(is_good, weight[order], -weight[order]))]) + (1 - share)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edges = np.concatenate([[ranked[0] - 1], ranked, [ranked[-1] + 1]])
    at = best[np.argmax(edges[best + 1] - edges[best])]
    cut = float((edges[at] + edges[at + 1]) / 2)
    # steepness by likelihood, with the cut held
    shift, a = np.log(CUT / (1 - CUT)), 1.0
    for _ in range(50):
        z = np.clip(a * (scores - cut) + shift, -30, 30)
        p = 1 / (1 + np.exp(-z))
        target = np.arange(len(scores)) < len(up)
        first = (weight * (target - p) * (scores - cut)).sum() - 1e-3 * a
        second = (weight * p * (1 - p) * (scores - cut) ** 2).sum() + 1e-3
        a = float(np.clip(a + np.clip(first / second, -1, 1), 0.2, 20))
    return Model(mean, spread, weights, cut, a)


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            rows = [features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("y"), pa.array(rows, pa.list_(pa.float64()))], ["y", "features"]
            )


def learn(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = MOST) -> Model | None:
    known = labelled(labels, column, fold() != 0)
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    found = sample(docs, known, most).select("y", "text").mapInArrow(_features, "y int, features array<double>")
    rows = found.collect()  # at most twice ``most`` short rows
    if not rows:
        return None
    data = sorted((r["y"], *r["features"]) for r in rows)
    table = np.array(data)
    return fit(table[:, 1:], table[:, 0], counts[1] / (counts[0] + counts[1]))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch):
                rows = [features(t) for t in part.column("text").to_pylist()]
                found = np.full(len(rows), 0.5) if model is None else model.score(np.array(rows))
                columns = [part.column("doc_id"), part.column("text_sha"), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_sha", "score"])

    texts = docs.select("doc_id", text_hash(), text_of().alias("text"))
    found = texts.mapInArrow(run, "doc_id long, text_sha string, score double")
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", "text_sha", held_out, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return scored(docs, learn(docs, labels)).drop("text_sha")


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with all columns."""
    return keep_where(docs, scored(docs, learn(docs, labels)), F.col("predicted") == 1)
