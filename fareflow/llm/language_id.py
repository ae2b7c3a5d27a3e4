"""Operator 2: language identification by nearest centroid.

A text is a vector of hashed character n-grams (1 to 3 letters, lower case, other characters as
one space), weighted by TF-IDF and scaled to unit length.  Each language has several centroids,
found by spherical k-means; the nearest by cosine names the language.  A text farther from its
centroid than nearly all texts that formed it is rejected.

Document frequencies cover all training documents.  The k-means runs on the driver over a bounded
sample of them per language.  Prediction streams every document through the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import labelled_sample, parts, texts

SIZE = 1 << 13  # hashed n-grams
PER_LANGUAGE = 500  # documents of a language in the k-means, at most
CENTROIDS = 4  # of a language
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct n-gram numbers of the whole text and their counts; None without a letter."""
    letter = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[letter]
    if not is_letter.any():
        return None
    c = np.concatenate([[0], np.where(is_letter, letter, 0), [0]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # one space in a row
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (c[2:] + np.uint32(0x27D4EB2F))) * np.uint32(0xC2B2AE35)
    numbers = np.concatenate([one[c != 0], two, three]) >> np.uint32(32 - 13)
    counts = np.bincount(numbers, minlength=SIZE)
    some = np.flatnonzero(counts)
    return some.astype(np.int32), counts[some]


def _vector(found, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, counts = found
    value = np.log1p(counts).astype(np.float32) * idf[some]
    length = np.sqrt(np.square(value).sum())
    return some, value / length if length else value


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    farthest: np.ndarray  # accepted distance from each centroid

    def predict(self, text: str) -> tuple[str, str, float, bool]:
        """(nearest language, language or ``und`` if rejected, cosine, rejected)."""
        found = grams(text)
        if found is None or not self.languages:
            return UNKNOWN, UNKNOWN, 0.0, True
        some, value = _vector(found, self.idf)
        cosines = self.centroids[some].T @ value
        best = int(cosines.argmax())
        rejected = bool(1 - cosines[best] > self.farthest[best])
        return self.languages[best], UNKNOWN if rejected else self.languages[best], float(np.clip(cosines[best], 0, 1)), rejected


def spherical_k_means(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit rows and each row's centroid; starts are spread out by k-means++."""
    random = np.random.default_rng(seed)
    chosen = [int(random.integers(len(rows)))]
    while len(chosen) < min(k, len(rows)):
        far = np.clip(1 - (rows @ rows[chosen].T).max(1), 0, None).astype(np.float64)
        if far.sum() <= 1e-6:
            break
        chosen.append(int(random.choice(len(rows), p=far / far.sum())))
    centroids = rows[chosen]
    for _ in range(rounds):
        of = (rows @ centroids.T).argmax(1)
        sums = np.stack([rows[of == i].sum(0) if (of == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, (rows @ centroids.T).argmax(1)


def fit(docs: DataFrame, training, lang: str = "lang", per_language: int = PER_LANGUAGE, k: int = CENTROIDS,
        quantile: float = 0.999) -> Model:
    """Learn from the rows of ``docs`` where ``training`` holds and ``lang`` is not null.

    IDF counts all of them; the k-means uses per language the ``per_language`` documents of the
    lowest doc_id hashes.  Without training rows every text is ``und``.
    """
    rows = docs.where(training & F.col(f"`{lang}`").isNotNull()).select("doc_id", "text", F.col(f"`{lang}`").cast("string").alias("label"))

    def counted(batches):
        seen = np.zeros(SIZE + 1, np.int64)
        for batch in parts(batches):
            for text in texts(batch):
                if (found := grams(text)) is not None:
                    seen[found[0]] += 1
                    seen[SIZE] += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["gram", "n"])

    table = rows.select("text").mapInArrow(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(SIZE + 1, np.int64)
    seen[table.column("gram").to_numpy()] = table.column("n").to_numpy()
    idf = (np.log((1 + seen[SIZE]) / (1 + seen[:SIZE])) + 1).astype(np.float32)

    def vectors(batches):
        for batch in parts(batches):
            found = [(l, _vector(g, idf)) for l, t in zip(batch.column("label").to_pylist(), texts(batch), strict=True) if (g := grams(t)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([l for l, _ in found], pa.string()), pa.array([v[0] for _, v in found], pa.list_(pa.int32())),
                 pa.array([v[1] for _, v in found], pa.list_(pa.float32()))], ["label", "grams", "weights"])

    sample = (labelled_sample(rows, rows.select("doc_id", "label"), per_language).orderBy("doc_id")
              .mapInArrow(vectors, "label string, grams array<int>, weights array<float>").toArrow())
    languages, centroids, farthest = [], [np.zeros((0, SIZE), np.float32)], []
    labels = np.array(sample.column("label").to_pylist(), object)
    for language in sorted(set(labels)):
        of = np.flatnonzero(labels == language)
        dense = np.zeros((len(of), SIZE), np.float32)
        for i, at in enumerate(of):
            dense[i, sample.column("grams")[int(at)].values.to_numpy()] = sample.column("weights")[int(at)].values.to_numpy()
        found, member = spherical_k_means(dense, k)
        distance = 1 - (dense * found[member]).sum(1)
        for i in range(len(found)):
            languages.append(language)
            farthest.append(float(np.quantile(distance[member == i], quantile)) + 0.05 if (member == i).any() else 1.0)
        centroids.append(found)
    return Model(idf, languages, np.ascontiguousarray(np.concatenate(centroids).T), np.array(farthest))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``nearest`` (language of the nearest centroid), ``lang`` (the same, or ``und`` if
    the text is too far from it), ``score`` (cosine, 0 to 1) and ``rejected``.

    A null text or one without a letter is ``und`` with score 0.  Null and repeated doc_ids keep
    a row each; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x centroids x 2^13 numbers

    def run(batches):
        for batch in parts(batches):
            rows = [shared.value.predict(t) for t in texts(batch)]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                             ["doc_id", "nearest", "lang", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, nearest string, lang string, score double, rejected boolean")
