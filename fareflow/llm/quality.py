"""Operator 7: quality classifier, naive Bayes features under a linear hinge-loss model (NB-SVM).

Features are indicators of hashed n-grams: word unigrams and bigrams, and one to three in a row
of word shapes (case, marks around the word, whether it repeats the word before).  A shape
n-gram also says which share of the text it makes up, as a power of two.  Each indicator is
scaled by its log-count ratio between the classes, rows are scaled to unit length, and a linear
model is fitted by dual coordinate descent on the hinge loss.  A logistic curve, fitted on rows
the model has not seen, turns margins into scores.

The fit uses a bounded sample of labelled rows on the driver; scoring streams every document
through the tasks, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import labelled_sample, parts, texts
from fareflow.llm.tokens import Bounded

SIZE = 1 << 18  # hashed features
SHAPES = 1 << 14  # of them, the last ones are for shapes
PER_LABEL = 6000  # labelled rows of each class in the fit, at most

_edges = re.compile(r"^(\W*).*?(\W*)$", re.DOTALL)


def _shape(word: str) -> int:
    left, right = _edges.match(word).groups()
    core = word[len(left):len(word) - len(right)]
    case = "d" if core.isdigit() else "U" if core.isupper() else "l" if core.islower() else "T" if core.istitle() else "x" if core else "-"
    return zlib.crc32(f"{left[:3]} {case} {right[:3]}".encode())


_word_hash = Bounded(lambda word: zlib.crc32(word.lower().encode()), 150_000)
_shape_hash = Bounded(_shape, 150_000)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20)


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of the whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int32)
    word = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, n)
    shape = np.fromiter(map(_shape_hash.__getitem__, words), np.uint64, n)
    shape[1:] += (word[1:] == word[:-1]) * np.uint64(7)
    grams = [_mix(word, 1), _mix(word[:-1] * np.uint64(3) + word[1:], 2)]
    found = [np.concatenate(grams) % np.uint64(SIZE - SHAPES)]
    for size in (1, 2, 3):
        if n < size:
            break
        gram = _mix(sum(shape[i:n - size + 1 + i] * np.uint64(2 * i + 1) for i in range(size)), 10 + size)
        gram, counts = np.unique(gram, return_counts=True)
        share = np.log2(n / counts).astype(np.uint64)
        found.append(np.uint64(SIZE - SHAPES) + _mix(gram * np.uint64(64) + share, 20) % np.uint64(SHAPES))
    return np.unique(np.concatenate(found)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # per feature: ratio times hinge weight
    ratios: np.ndarray
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(np.square(self.ratios[found], dtype=np.float64).sum()))
        return float(self.weights[found].sum(dtype=np.float64)) / length + self.weights[SIZE] if length else float(self.weights[SIZE])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features(text)) + self.shift, -35, 35))))


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0, least: int = 2) -> np.ndarray:
    """Per feature, log of its share among the positive rows' indicators over that among the
    negative ones; 0 for features in fewer than ``least`` rows."""
    counts = [np.bincount(np.concatenate([np.zeros(0, np.int32), *(r for r, p in zip(rows, positive, strict=True) if p == side)]),
                          minlength=SIZE) for side in (True, False)]
    share = [(c + smoothing) / (c + smoothing).sum() for c in counts]
    return np.where(counts[0] + counts[1] >= least, np.log(share[0] / share[1]), 0).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray,
                            epochs: int = 15, seed: int = 0) -> np.ndarray:
    """Weights (the last one the bias) that minimise |w|^2 / 2 + sum of cost * hinge loss."""
    weights = np.zeros(SIZE + 1)
    duals = np.zeros(len(rows))
    norms = np.array([np.square(v).sum() for v in values]) + 1
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = signs[i] * (weights[rows[i]] @ values[i] + weights[SIZE]) - 1
            dual = min(max(duals[i] - gradient / norms[i], 0.0), cost[i])
            step = (dual - duals[i]) * signs[i]
            if step:
                duals[i] = dual
                weights[rows[i]] += step * values[i]
                weights[SIZE] += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def _logistic(margins: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve through margins, by Newton steps; the slope stays positive."""
    x = np.stack([margins, np.ones_like(margins)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -35, 35)))
        gradient = x @ (weight * (p - positive)) + 1e-2 * beta
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 1e-2 * np.eye(2), gradient)
        beta = beta - np.clip(step, -2, 2)
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL, cost: float = 1.0) -> Model:
    """Fit on ``labels`` (``doc_id`` and ``label``, 1 for good) and the texts of ``docs``.

    At most ``per_label`` rows of each class are used, those with the lowest doc_id hashes; a
    fifth of them fits the score curve.  Without rows of both classes every score is the share of label 1
    (0.5 without labels).
    """
    known = labels.select("doc_id", (F.col(label) == 1).alias("label"))

    def run(batches):
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([features(t) for t in texts(batch)], pa.list_(pa.int32()))],
                ["doc_id", "label", "features"])

    sample = (labelled_sample(docs.withColumn("doc_id", F.col("doc_id").cast("long")), known, per_label)
              .mapInArrow(run, "doc_id long, label boolean, features array<int>").toArrow().sort_by("doc_id"))
    of_class = {r["label"]: r["count"] for r in known.where("label IS NOT NULL").groupBy("label").count().collect()}
    rows = [r.values.to_numpy() for r in sample.column("features")]
    positive = sample.column("label").to_numpy(zero_copy_only=False).astype(bool)
    good, bad = of_class.get(True, 0), of_class.get(False, 0)
    if not positive.any() or positive.all():
        prior = good / (good + bad) if good + bad else 0.5
        return Model(np.zeros(SIZE + 1, np.float32), np.zeros(SIZE, np.float32), 1.0, float(np.clip(np.log((prior + 1e-9) / (1 - prior + 1e-9)), -35, 35)))
    ratios = log_count_ratios(rows, positive)
    values = []
    for r in rows:
        v = ratios[r].astype(np.float64)
        values.append(v / (np.sqrt(np.square(v).sum()) or 1.0))
    fifth = np.arange(len(rows)) % 5 == 0
    if len(rows) < 50 or len(set(positive[fifth])) < 2 or len(set(positive[~fifth])) < 2:
        fifth = np.zeros(len(rows), bool)
    signs = np.where(positive, 1.0, -1.0)
    # a class weighs as much as the other; the curve then restores the classes' true shares
    balance = np.where(positive, 1.0, positive.sum() / (~positive).sum()) * cost

    def margins(weights, of):
        return np.array([weights[rows[i]] @ values[i] + weights[SIZE] for i in of])

    used = np.flatnonzero(~fifth)
    weights = dual_coordinate_descent([rows[i] for i in used], [values[i] for i in used], signs[used], balance[used])
    held = np.flatnonzero(fifth) if fifth.any() else used
    share = np.where(positive, good / max(1, positive.sum()), bad / max(1, (~positive).sum()))
    slope, shift = _logistic(margins(weights, held), positive[held].astype(float), share[held] / share[held].mean())
    scaled = np.append(weights[:SIZE] * ratios, weights[SIZE]).astype(np.float32)
    return Model(scaled, ratios, slope, shift)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every document.

    Null, empty and wordless texts have no feature and get the score of the bare bias.  Null
    and repeated doc_ids keep a row each; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the corpus

    def run(batches):
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([shared.value.score(t) for t in texts(batch)], pa.float64())],
                                             ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in parts(batches):
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array([shared.value.score(t or "") >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
