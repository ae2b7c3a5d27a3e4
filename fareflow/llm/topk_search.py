"""Operator 3: exact top-k by inner product, term at a time.

Vectors are quantised to integers; a component number is a term, a non-zero component a posting.
Queries and candidates are dealt into blocks, and each pair of a query block and a candidate
block is one group: the candidates' inverted lists are built once, every query row scatters its
weighted postings into a dense score array, and a partition selection keeps its k best of the
block.  The blocks' winners are merged per query.  The queries are a stated set (here a
twentieth of the rows), so the work is queries times rows by the nature of an exact search;
blocks bound the memory of a group and spread the pairs over all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import stored

LARGEST = 2.0**63  # a quantised component from this size on is an error
DENSE = 8  # a list that holds more than 1/8 of the block's rows is kept complete


def _quantised(scale: float):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.compute.and_(pa.compute.is_valid(batch.column("vec_id")), pa.compute.is_valid(batch.column("embedding"))))
            lists = batch.column("embedding")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            usable = np.bincount(row, ~np.isfinite(flat), len(sizes)) == 0
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(scale * flat)
                if (np.abs(values[usable[row]]) >= LARGEST).any():
                    raise OverflowError("a component times the scale leaves 64 bits")
                values = np.where(usable[row], values, 0).astype("<i8")
            ends = np.cumsum(sizes)
            ids = batch.column("vec_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[usable], pa.int64()),
                 pa.array([values[e - n:e].tobytes() for e, n, u in zip(ends, sizes, usable, strict=True) if u], pa.binary())],
                ["vec_id", "v"])
    return run


def quantise(vectors: DataFrame, scale: float = 64) -> DataFrame:
    """``vec_id`` and floor(scale * x) of each component as packed 64-bit integers."""
    return vectors.select("vec_id", "embedding").mapInArrow(_quantised(scale), "vec_id long, v binary")


def _rows(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), np.int64)
    for i, v in enumerate(packed):
        x = np.frombuffer(v, "<i8")
        out[i, :len(x)] = x
    return out


class InvertedLists:
    """Postings of a candidate block by term, over rows in ascending vec_id order."""

    def __init__(self, rows: np.ndarray, score_type):
        self.n, self.type = len(rows), score_type
        self.lists = []
        for column in np.ascontiguousarray(rows.T).astype(score_type):
            at = np.flatnonzero(column)
            self.lists.append((None, column) if len(at) * DENSE > self.n else (at, column[at]))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Accumulate the query's terms one by one."""
        total, part = np.zeros(self.n, self.type), np.empty(self.n, self.type)
        for term in np.flatnonzero(query):
            at, values = self.lists[term]
            weight = int(query[term]) if self.type is object else self.type(query[term])
            if at is None:  # a complete list: every row has a place, in order
                np.multiply(values, weight, out=part)
                total += part
            else:
                total[at] += weight * values
        return total


def select_top(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > kth)
    return np.concatenate([above, np.flatnonzero(scores == kth)[: k - len(above)]])


def _searched(k: int):
    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            order = np.argsort(candidates.column("vec_id").to_numpy(), kind="stable")
            ids = candidates.column("vec_id").to_numpy()[order]
            theirs = candidates.column("v").to_pylist()
            ours = queries.column("v").to_pylist()
            width = max(map(len, ours + theirs)) // 8
            rows, weights = _rows([theirs[i] for i in order], width), _rows(ours, width)
            largest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
            bound = width * largest(rows) * largest(weights)
            # beyond 64 bits Python's integers keep the sums exact; a winner's score beyond them is an error
            lists = InvertedLists(rows, np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object)
            for qid, qkey, query in zip(queries.column("vec_id").to_numpy(), queries.column("query_key").to_numpy(), weights, strict=True):
                scores = lists.scores(query)
                others = np.flatnonzero(ids != qid)
                top = others[select_top(scores[others], k)]
                out["query_id"].append(np.full(len(top), qid))
                out["query_key"].append(np.full(len(top), qkey))
                out["vec_id"].append(ids[top])
                out["score"].append(scores[top].astype(np.int64))
        return pa.table({n: pa.array(np.concatenate(v) if v else [], pa.int64()) for n, v in out.items()})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64,
          query_block: int = 256, candidate_block: int = 8192) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best candidates of each query.

    ``is_query`` chooses the query rows by ``vec_id``.  Candidates are all rows with another
    vec_id than the query's; ties go to the smaller vec_id.  Rows whose vec_id or vector is null
    or whose vector holds a null or non-finite component take no part; a shorter vector counts
    as zero in the components it lacks, an empty one scores 0.  Rows that repeat a vec_id are
    candidates each; a query repeated exactly is asked once, and two different vectors under one
    query id are answered each.  Scores are exact; a component after scaling or a
    winner's score that leaves 64 bits is an error.  An empty table gives no rows; other columns are ignored.
    """
    rows = stored(quantise(vectors, scale), "vectors")
    asked = rows.where(is_query).distinct().withColumn("query_key", F.xxhash64("vec_id", "v"))
    query_blocks = -(-asked.count() // query_block) or 1
    candidate_blocks = -(-rows.count() // candidate_block) or 1

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = (asked.withColumn("qb", F.pmod("query_key", F.lit(query_blocks)).cast("int"))
               .withColumn("cb", every(candidate_blocks)))
    candidates = (rows.withColumn("cb", F.pmod(F.monotonically_increasing_id(), F.lit(candidate_blocks)).cast("int"))
                  .withColumn("qb", every(query_blocks)))
    found = (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
             .applyInArrow(_searched(k), "query_id long, query_key long, vec_id long, score long"))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
