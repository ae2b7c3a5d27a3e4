"""Operator 4: packing by lexical retrieval.

Two passes over the documents, and a sample between them:

1. Corpus statistics for BM25: the number of documents with each term, the number of documents
   and their mean length, over all documents.  Terms are words (runs of letters) hashed to 2^18
   numbers, so the statistics that every task gets are 2^18 counts (2 MB), whatever the corpus.
2. Documents are dealt into slots of about ``shard_docs`` documents by content.  A balanced tree of
   at most 2^8 leaves, made from a sample of ``SAMPLE`` documents with at least ``LEAF`` of them a
   leaf, halves them by their main direction of variation (TF-IDF, 2^12 dimensions); a leaf that
   holds more than one slot is parted by a MinHash of a document's terms weighted by rarity, or for a
   MinHash that stands out in the sample (a large group of copies) by the hash of the doc_id.
   Slots vary with the sample: in sf0.1 with 40 documents a slot the median is 40, the largest 72.
   Smaller groups of copies are not parted.  Documents meet by slot in one shuffle, as ids and terms.
3. The index is sharded: a shard is the next ``shard_docs`` documents in slot order (or fewer, when
   they reach ``shard_ids`` ids, or when a slot ends after half as many) with their inverted
   lists.  The first document is the seed; its window is filled with the best-scoring unused
   documents of the shard, in order, until it is full.  The document that the window's end cuts
   goes on in the next window and is its seed.  Every window of a shard but the last is
   therefore full; the last is closed as sequences of powers of two, which need no padding.

A task holds one shard at a time, and the work of a document depends on the shard size alone, so
the job grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import partition_id, parts, texts
from fareflow.llm.tokens import text_ids
from fareflow.llm.words import LETTER, Units, batches_of, units

WORD_BPE = "word_bpe_49k.json"
END_ID = 1
TERMS = 1 << 18
K1, B = 1.2, 0.75
SAMPLE = 2048  # documents from which the tree of slots is made
DIMENSIONS, DEPTH = 1 << 12, 8
RARE = 8  # power of the idf by which a term is drawn for the MinHash
LEAF = 64  # documents of the sample in a leaf of the tree
HOT = 4  # a MinHash that so many documents of the sample share is parted by doc_id
BATCH = 1 << 20  # bytes of text cut at once
FIRST = 32  # neighbours of a seed sorted before the others
COMMON = 4  # a term of more than this part of a shard's documents has a row of weights
_DOCS, _WORDS = TERMS, TERMS + 1  # two more numbers in the statistics


def _term_counts(cut: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of texts: terms (ascending in each text) and how often each occurs, text after
    text, and where each text begins."""
    text = np.repeat(np.arange(len(cut.text_end)), np.diff(cut.first_of))
    word = cut.kind == LETTER
    key, counts = np.unique(text[word] * TERMS + (cut.hash[word] >> np.uint64(46)).astype(np.int64), return_counts=True)
    return key % TERMS, counts, np.searchsorted(key, np.arange(len(cut.text_end) + 1) * TERMS)


def corpus_statistics(docs: DataFrame) -> tuple[np.ndarray, float, int]:
    """Inverse document frequency of each term number, the mean number of words, and the number of documents."""

    def counted(batches):
        seen = np.zeros(TERMS + 2, np.int64)
        for batch in parts(batches):
            for first, last, raw in batches_of(texts(batch), BATCH):
                terms, counts, _ = _term_counts(units(raw))
                seen[:TERMS] += np.bincount(terms, minlength=TERMS)
                seen[_DOCS] += last - first
                seen[_WORDS] += counts.sum()
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["term", "n"])

    rows = docs.select("text").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(TERMS + 2, np.int64)
    seen[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    n = seen[_DOCS]
    return np.log1p((n - seen[:TERMS] + 0.5) / (seen[:TERMS] + 0.5)).astype(np.float32), max(1.0, seen[_WORDS] / max(1, n)), int(n)


def _sample(docs: DataFrame, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms and counts of about ``SAMPLE`` documents, chosen by their hash."""
    def run(batches):
        for batch in parts(batches):
            for _, _, raw in batches_of(texts(batch), BATCH):
                terms, counts, bounds = _term_counts(units(raw))
                some = list(zip(bounds, bounds[1:]))
                yield pa.RecordBatch.from_arrays([pa.array([x[i:j].tobytes() for i, j in some], pa.binary()) for x in (terms, counts)], ["t", "c"])

    share = min(1.0, SAMPLE / max(1, n))
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # a group of rows that are equal in all may exceed the share; the limit holds the driver's part
    found = some.select("text").mapInArrow(run, "t binary, c binary").limit(2 * SAMPLE).toArrow()
    pairs = sorted(zip(found.column("t").to_pylist(), found.column("c").to_pylist(), strict=True))
    return [(np.frombuffer(t, np.int64), np.frombuffer(c, np.int64)) for t, c in pairs]


class Slots:
    """Deals documents into slots of like content."""

    def __init__(self, sample: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, n: int, shard_docs: int):
        self.idf = idf
        # terms in a random order that puts rare ones first (a weighted MinHash); those of one document come last
        shared = np.log1p((n - 1.5) / 2.5) + 1e-3 if n > 2 else np.inf  # the idf of a term of two documents
        draw = -np.log(np.random.default_rng(4).random(TERMS)) / np.maximum(idf, 1e-6).astype(np.float64) ** RARE
        self.drawn = np.empty(TERMS, np.int64)
        self.drawn[np.argsort(np.where(idf <= shared, draw, np.inf), kind="stable")] = np.arange(TERMS)
        self.drawn[idf > shared] = TERMS
        # a leaf is made from enough documents of the sample to halve the corpus as it halves them
        fine = max(1, len(sample) // LEAF).bit_length() - 1
        self.depth = min(DEPTH, fine, max(0, -(-n // shard_docs) - 1).bit_length())
        self.directions = np.zeros(((1 << self.depth) - 1, DIMENSIONS), np.float32)
        self.limits = np.full(len(self.directions), np.inf)
        terms, counts = [t for t, _ in sample], [c for _, c in sample]
        if self.depth and sample:
            rows = np.zeros((len(sample), DIMENSIONS), np.float32)
            doc, dim, weight = self._vectors(terms, counts)
            np.add.at(rows, (doc, dim), weight)
            self._grow(0, rows)
        leaf = self._leaves(terms, counts)
        held = np.bincount(leaf, minlength=1 << self.depth)
        self.slots = np.maximum(1, np.rint(held * (n / shard_docs / max(1, len(sample)))).astype(np.int64))
        self.first = np.cumsum(self.slots) - self.slots
        keys, often = np.unique(self.minhashes(terms), return_counts=True)
        self.hot = frozenset([TERMS, *keys[often >= HOT].tolist()])

    def _vectors(self, terms: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, dimension, weight) of the documents' terms; each document has length one."""
        doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        term = np.concatenate([np.zeros(0, np.int64), *terms])
        weight = self.idf[term] * np.log1p(np.concatenate([np.zeros(0, np.int64), *counts]))
        norm = np.sqrt(np.bincount(doc, weight * weight, len(terms)))
        return doc, term % DIMENSIONS, (weight / np.maximum(norm, 1e-9)[doc]).astype(np.float32)

    def _grow(self, node: int, rows: np.ndarray) -> None:
        if node >= len(self.limits) or len(rows) < 4:
            return
        off = rows - rows.mean(0)
        along = off[np.argmax((off * off).sum(1))]
        for _ in range(12):  # power iteration
            along = off.T @ (off @ along)
            if not (size := np.linalg.norm(along)) > 1e-12:
                return
            along /= size
        at = rows @ along
        self.directions[node], self.limits[node] = along, np.median(at) + 1e-6
        self._grow(2 * node + 1, rows[at <= self.limits[node]])
        self._grow(2 * node + 2, rows[at > self.limits[node]])

    def _leaves(self, terms: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        node = np.zeros(len(terms), np.int64)
        if self.depth:
            doc, dim, weight = self._vectors(terms, counts)
            for _ in range(self.depth):
                at = np.bincount(doc, self.directions[node[doc], dim] * weight, len(terms))
                node = 2 * node + 1 + (at > self.limits[node])
        return node - len(self.limits)

    def minhashes(self, terms: list[np.ndarray]) -> np.ndarray:
        """Of each document the first of its terms in the drawn order (``TERMS`` if it shares none)."""
        starts = np.cumsum([0, *(len(t) for t in terms[:-1])])
        drawn = np.append(self.drawn[np.concatenate([np.zeros(0, np.int64), *terms])], TERMS)
        least = np.minimum.reduceat(drawn, starts) if len(terms) else np.zeros(0, np.int64)
        return np.where([len(t) > 0 for t in terms], least, TERMS)

    def of(self, doc_ids: list, terms: list[np.ndarray], counts: list[np.ndarray]) -> list[int]:
        out = []
        for doc_id, key, leaf in zip(doc_ids, self.minhashes(terms).tolist(), self._leaves(terms, counts).tolist(), strict=True):
            slot, n = int(self.first[leaf]), int(self.slots[leaf])
            if n > 1:
                slot += xxhash.xxh64_intdigest(str(doc_id if key in self.hot else key)) % n
            out.append(slot)
        return out


class Shard:
    """Inverted BM25 lists over the documents of one shard; a term of over a ``1 / COMMON`` of them has a row of weights instead."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean: float):
        self.unused = np.ones(len(terms), bool)
        lengths = np.array([c.sum() for c in counts], np.float32)
        sizes = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(len(terms)), sizes)
        tf = np.concatenate(counts).astype(np.float32)
        names, term, held = np.unique(np.concatenate(terms), return_inverse=True, return_counts=True)
        weight = idf[names][term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
        self.own = np.split(term, np.cumsum(sizes)[:-1])
        common = COMMON * held > len(terms)
        self.row = np.where(common, np.cumsum(common) - 1, -1)  # of each term
        self.rows = np.zeros((int(common.sum()), len(terms)), np.float32)
        far = common[term]
        self.rows[self.row[term[far]], doc[far]] = weight[far]
        doc, term, weight = doc[~far], term[~far], weight[~far]
        by_term = np.argsort(term.astype(np.uint16) if len(names) <= 1 << 16 else term, kind="stable")  # a radix sort of the shorter
        self.term, self.doc, self.weight = term[by_term], doc[by_term], weight[by_term].astype(np.float64)  # as bincount takes them
        self.left = self.indexed = len(terms)
        self._bounds(len(names))

    def _bounds(self, n: int) -> None:
        self.bounds = np.searchsorted(self.term, np.arange(n + 1))

    def use(self, doc: int) -> None:
        self.unused[doc] = False
        self.left -= 1
        if self.left < self.indexed // 2:  # drop the used documents' postings
            keep = self.unused[self.doc]
            self.term, self.doc, self.weight = self.term[keep], self.doc[keep], self.weight[keep]
            self._bounds(len(self.bounds) - 1)
            self.indexed = self.left

    def neighbours(self, seed: int) -> Iterator[int]:
        """All unused documents, best score first, ties in shard order.  A window takes few: those are sorted first."""
        own = self.own[seed]
        row = self.row[own]
        own = own[row < 0]
        starts, ends = self.bounds[own], self.bounds[own + 1]
        sizes = ends - starts
        total = int(sizes.sum())
        at = np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        scores = np.bincount(self.doc[at], self.weight[at], len(self.unused)) + self.rows[row[row >= 0]].sum(0, np.float64)
        some = np.flatnonzero(self.unused)
        behind = -scores[some]
        if len(some) > 4 * FIRST:
            best = behind <= np.partition(behind, FIRST)[FIRST]
            yield from some[best][np.argsort(behind[best], kind="stable")].tolist()
            some, behind = some[~best], behind[~best]
        yield from some[np.argsort(behind, kind="stable")].tolist()


def retrieval_order(lengths: list[int], window: int, shard) -> list[int]:
    """The order of the shard's documents: each window's seed, then its best unused neighbours.

    Laid end to end in this order and cut at every ``window`` ids, the documents fill all
    windows but the last.
    """
    order, seed, at = [0], 0, lengths[0]
    shard.use(0)
    while shard.left:
        for doc in shard.neighbours(seed):
            shard.use(doc)
            order.append(doc)
            full, at = at // window < (at + lengths[doc]) // window, at + lengths[doc]
            if full:  # this document crosses the end: its rest starts the next window
                seed = doc
                break
    return order


def layout(lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Cut documents laid end to end: place in the order, start in the document, length,
    sequence and offset of each piece.  The rest after the last full window is cut into
    descending powers of two."""
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    sequences = list(range(0, total - window + 1, window))
    at = total - total % window
    for power in reversed(range(window.bit_length())):
        if (total - at) >> power & 1:
            sequences.append(at)
            at += 1 << power
    sequences = np.array(sequences, np.int64)
    cuts = np.union1d(starts, sequences)
    place = np.searchsorted(starts, cuts, "right") - 1
    sequence = np.searchsorted(sequences, cuts, "right") - 1
    return place, cuts - starts[place], np.diff(cuts, append=total), sequence, cuts - sequences[sequence]


def _narrow(values: np.ndarray) -> bytes:
    """The numbers in the fewest bytes each that hold them all, after that number of bytes."""
    most = values.max(initial=0)
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _wide(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(kind)


def _encoded(batches: Iterator[pa.RecordBatch], slots: Slots, tokenizer: str, end_id: int):
    """``doc_id``, ``slot``, and the document's ids, terms and counts as packed integers."""
    encoder, end = text_ids(tokenizer), np.array([end_id], "<u4")
    for batch in parts(batches):
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def seen(first: int, cut: Units):
            term, count, bounds = _term_counts(cut)
            terms.extend(term[i:j] for i, j in zip(bounds, bounds[1:]))  # noqa: B023
            counts.extend(count[i:j] for i, j in zip(bounds, bounds[1:]))  # noqa: B023

        ids = [np.concatenate([own, end]) for own in encoder.all_ids(texts(batch), seen, BATCH)]
        doc_ids = batch.column("doc_id").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(slots.of(doc_ids, terms, counts), pa.int32()),
             *(pa.array(list(map(_narrow, column)), pa.binary()) for column in (ids, terms, counts))],
            ["doc_id", "slot", "ids", "terms", "counts"])


def _packed(batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float, window: int, shard_docs: int, shard_ids: int):
    # the tables of the tasks before, which tokenized in this worker, are not needed any more
    text_ids.cache_clear()
    pa.default_memory_pool().release_unused()
    sequence0, last = partition_id() << 33, None
    doc_ids, ids, terms, counts, size = [], [], [], [], 0

    def pack():
        nonlocal sequence0
        lengths = [len(i) for i in ids]
        order = retrieval_order(lengths, window, Shard(terms, counts, idf, mean))
        place, start, length, sequence, offset = layout(np.array(lengths, np.int64)[order], window)
        doc = [order[p] for p in place]
        yield pa.RecordBatch.from_arrays(
            [pa.array([doc_ids[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             pa.array([ids[d][a:a + n].tobytes() for d, a, n in zip(doc, start.tolist(), length.tolist(), strict=True)], pa.binary()),
             pa.array([lengths[d] for d in doc], pa.int64()), pa.array(sequence0 + sequence, pa.int64()), pa.array(offset, pa.int64())],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        sequence0 += int(sequence[-1]) + 1

    for batch in parts(batches):
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "slot", "ids", "terms", "counts")), strict=True)
        for doc_id, slot, of_text, term, count in rows:
            if len(ids) >= shard_docs or size >= shard_ids or slot != last and 2 * len(ids) >= shard_docs:
                yield from pack()
                doc_ids, ids, terms, counts, size = [], [], [], [], 0
            last = slot
            doc_ids.append(doc_id)
            ids.append(_wide(of_text, "<u4"))
            terms.append(_wide(term, "i8"))
            counts.append(_wide(count, "i8"))
            size += len(ids[-1])
    if ids:
        yield from pack()


def pack_documents(docs: DataFrame, tokenizer: str = WORD_BPE, end_id: int = END_ID, window: int = 2048,
                   shard_docs: int = 1024, shard_ids: int = 1 << 23) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` and ``length`` in its document, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``.

    A document is the ids of its whole text (null: empty) and the end id, and each id lies in
    exactly one piece.  Sequences hold ``window`` ids (a power of two), or at the end of a shard a smaller
    power of two.  Null and repeated doc_ids and repeated rows are documents of their own; ties
    in the score go to the smaller doc_id; an empty table gives no rows; other columns are ignored.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    context = docs.sparkSession.sparkContext
    idf, mean, n = corpus_statistics(docs)
    dealt = Slots(_sample(docs, n) if n > shard_docs else [], idf, n, shard_docs)
    slots, many = context.broadcast(dealt), int(dealt.slots.sum())  # at most 5 MB
    encoded = docs.mapInArrow(lambda it: _encoded(it, slots.value, tokenizer, end_id),
                              "doc_id long, slot int, ids binary, terms binary, counts binary")
    # neighbouring slots go to one task, the same number to each, so that no task sorts much
    tasks = min(many, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    to = F.floor(F.col("slot").cast("long") * tasks / many).cast("int")
    return encoded.repartitionById(tasks, to).sortWithinPartitions("slot", "doc_id").mapInArrow(
        lambda it: _packed(it, slots.value.idf, mean, window, shard_docs, shard_ids),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
