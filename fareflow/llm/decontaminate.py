"""Operator 6: benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is contained in a document when at least ``threshold`` of the item's distinct
shingles (five words) occur in it.  A MinHash signature of a long document says next to nothing
about a short item, so, as in containment indexes, items are partitioned by size: an item of q
shingles falls in the class of the power of two u >= q, and its signature is the bottom
floor((1 - threshold) * u) + 1 of its shingles in hash order.  At most floor((1 - threshold) * q)
shingles of a contained item are missing, so at least one of its signature is in the document:
no contained item is lost, however long the document is.  An item of fewer words than a shingle (one
to four) has one shingle of all its words, which only a document of just these words has: such items
match whole texts only, and are not found inside longer documents.  A document probes the signatures with
all its shingles; each candidate is verified by the exact containment of its shingle set.

The benchmark is read in slices of at most about ``SLICE_BYTES`` of text.  One slice is sent to
every task; a larger benchmark takes one scan of the documents for each slice.  Documents never move.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce
from math import floor

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import parts, texts

SLICE_BYTES = 32 << 20

_WORD = re.compile(r"[^\W_]+")


def shingles(text: str, n: int) -> list[str]:
    """Space-joined runs of n words (letters and digits, lower case); fewer words: the one run."""
    words = _WORD.findall(text.lower())
    if len(words) <= n:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[i:] for i in range(n)))))


class ContainmentIndex:
    """Signatures of benchmark items, by shingle."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int, threshold: float):
        self.n, self.threshold = n, threshold
        self.items: list[tuple[int | None, frozenset[str]]] = []
        self.signatures: dict[str, list[int]] = defaultdict(list)
        by_size = defaultdict(list)
        for item_id, text in items:
            found = frozenset(shingles(text or "", n))
            if found:
                by_size[1 << (len(found) - 1).bit_length()].append((item_id, found))
        for upper, members in sorted(by_size.items()):
            bottom = floor((1 - threshold) * upper + 1e-9) + 1
            for item_id, found in members:
                for shingle in sorted(found, key=lambda s: (xxhash.xxh64_intdigest(s), s))[:bottom]:
                    self.signatures[shingle].append(len(self.items))
                self.items.append((item_id, found))
        self.keys = frozenset(self.signatures)

    def search(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item_id, item shingles in the text, item shingles) of every contained item."""
        own = set(shingles(text, self.n))
        candidates = sorted({i for s in own & self.keys for i in self.signatures[s]})
        found = []
        for i in candidates:
            item_id, wanted = self.items[i]
            hit = len(wanted & own)
            if hit >= self.threshold * len(wanted) - 1e-9:
                found.append((item_id, hit, len(wanted)))
        return found


def _indexes(benchmark: DataFrame, n: int, threshold: float):
    """A broadcast index for each slice of the benchmark."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    slices = -(-size // SLICE_BYTES) or 1
    context = benchmark.sparkSession.sparkContext
    for at in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == at)
        yield context.broadcast(ContainmentIndex([tuple(r) for r in part.collect()], n, threshold))


def contained_items(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document and benchmark item contained in it: ``doc_id``, ``item_id``,
    ``matched`` and ``item_shingles`` (distinct shingles), ``containment``.

    Words are runs of letters and digits in lower case, so case, punctuation and line breaks do
    not hide an item.  An item or document of fewer words than a shingle is one shingle of all
    its words; null and wordless texts contain nothing and are contained in nothing.  Null ids
    and repeated rows on either side are rows of their own; an empty table gives no rows; other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(index):
        def run(batches):
            for batch in parts(batches):
                rows = [(d, i, hit, size) for d, t in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
                        for i, hit, size in index.value.search(t)]
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "matched", "item_shingles"])
        return docs.mapInArrow(run, "doc_id long, item_id long, matched long, item_shingles long")

    found = reduce(DataFrame.unionByName, map(search, _indexes(benchmark, shingle_words, threshold)))
    return found.withColumn("containment", F.col("matched") / F.col("item_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item.  Null texts stay."""
    def keep(index):
        def run(batches):
            for batch in parts(batches):
                at = batch.schema.get_field_index("text")
                clean = [not index.value.search(t or "") for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    return reduce(lambda kept, index: kept.mapInArrow(keep(index), docs.schema),
                  _indexes(benchmark, shingle_words, threshold), docs)
