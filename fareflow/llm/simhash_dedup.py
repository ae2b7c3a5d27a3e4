"""Operator 9: SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  A segment's fuzzy keys are
the nearest Golay codeword indices of all words at most one bit away, at most six.  Two segments
at a distance of at most 2 have a word between them that is at most one bit from each, so they
share a fuzzy key.  At most 4 differing bits over three segments (pigeonhole) leave two cases:

- one segment is equal, and of the other two one differs in at most 2 bits: the key is the equal
  segment with the other's fuzzy key (34 bits, for each ordered pair of segments);
- every segment differs, by (1, 1, 1) or (1, 1, 2) bits.  Take the word between the two that has the
  midpoint in the segment with most errors s, the second's bits in t and the first's in u: it is one
  flip in s and in t from the first, and one in s and in u from the second.  The keys are the
  triples of indices with fuzzy keys in two segments and the own index in the third (36 bits).

So linked fingerprints share a key, and unlinked ones hardly ever do by chance (about one pair in
ten million).  A fingerprint has about a hundred distinct keys.

Only distinct fingerprints are keyed.  Buckets are verified by the exact bit distance.  A bucket
with more than ``BUCKET`` fingerprints is dealt into blocks, and each pair of blocks is a cell of
its own, so no task holds an unbounded group.  Cells of up to 16 rows give their links, larger ones a
spanning forest of them, which has the same connected components and is never quadratic.
"""

from __future__ import annotations

from itertools import accumulate, permutations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import parts, stored, texts
from fareflow.llm.components import connected_components
from fareflow.llm.golay import nearby

MOST = 4  # the largest distance that the three segments prove
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
BUCKET = 1024  # fingerprints in a block of a large bucket
_SMALL = 16

_words = regex.compile(rb"[^\x20\x09-\x0D]+")
_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle_words: int = 4) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included; no word: zero."""
    words = _words.findall(text.encode().translate(_lower))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [e - len(w) for e, w in zip(ends, words, strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle_words - 1:] or ends[-1:], strict=False)], ">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """``doc_id``, ``text_hash`` (of the text as it stands) and ``fp`` (the fingerprint as a signed long)."""
    def run(batches):
        for batch in parts(batches):
            prints = np.array([fingerprint(t, shingle_words) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every distinct key of each fingerprint."""
    segment = [(prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1) for shift, bits in SEGMENTS]
    near = [nearby(part, bits).astype(np.int64) for part, (_, bits) in zip(segment, SEGMENTS, strict=True)]
    rows, keys = [], []

    def emit(grid: np.ndarray) -> None:
        grid.sort(axis=1)
        new = np.ones(grid.shape, bool)
        new[:, 1:] = grid[:, 1:] != grid[:, :-1]
        rows.append(np.nonzero(new)[0])
        keys.append(grid[new])

    for tag, (i, j) in enumerate(permutations(range(3), 2)):
        emit(near[j] | (segment[i].astype(np.int64) << 12)[:, None] | tag << 36)
    triples = []
    for own in range(3):
        parts = [near[i][:, :1, None] if i == own else near[i][:, :, None] if i == (own + 1) % 3 else near[i][:, None, :] for i in range(3)]
        triples.append((parts[0] << 24 | parts[1] << 12 | parts[2]).reshape(len(prints), -1))
    emit(np.concatenate(triples, axis=1) | 6 << 36)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches):
    for batch in parts(batches):
        fp = batch.column("fp").to_numpy()
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            rows, keys = fuzzy_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def spanning_links(prints: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what the links within ``distance`` connect: each fingerprint is
    compared with those not yet reached only."""
    a, b, left = [], [], prints
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            close = np.bitwise_count(left ^ one) <= distance
            if close.any():
                b.append(left[close])
                a.append(np.full(len(b[-1]), one))
                reached.extend(b[-1])
                left = left[~close]
    return a, b


def _linked(distance: int):
    def cells(cell: np.ndarray, fp: np.ndarray):
        """Links inside runs of equal ``cell``."""
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(starts, append=len(cell))
        number = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= _SMALL, sizes)
        a, b = [], []
        few, prints = number[small], fp[small]
        for step in range(1, min(_SMALL, len(prints))):
            close = np.flatnonzero((few[step:] == few[:-step]) & (np.bitwise_count(prints[step:] ^ prints[:-step]) <= distance))
            a.append(prints[close])
            b.append(prints[close + step])
        for s, n in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
            more = spanning_links(fp[s:s + n], distance)
            a += more[0]
            b += more[1]
        empty = np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *x]).view(np.int64)) for x in (a, b)], ["a", "b"])

    def run(batches):
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:  # sorted by cell; the last one may go on in the next batch
            cell = np.concatenate([cell, batch.column("cell").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(cell) or cell[0] == cell[-1]:
                continue
            whole = np.searchsorted(cell, cell[-1])
            yield cells(cell[:whole], fp[:whole])
            cell, fp = cell[whole:], fp[whole:]
        if len(cell):
            yield cells(cell, fp)
    return run


def links(prints: DataFrame, max_distance: int = MOST) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints (column ``fp``) with the components of all links."""
    if not 0 <= max_distance <= MOST:
        raise ValueError(f"max_distance must be 0 to {MOST}")
    keys = prints.select("fp").mapInArrow(_keyed, "key long, fp long")
    sizes = keys.groupBy("key").count().where("count > 1")
    # a fingerprint has about a hundred keys, but the planner counts one row of them for each: it would broadcast them all
    rows = keys.hint("merge").join(sizes, "key").withColumn("blocks", F.ceil(F.col("count") / BUCKET).cast("int"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "fp"))
    return (dealt.repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(_linked(max_distance), "a long, b long"))


def _grouped(docs: DataFrame, shingle_words: int, max_distance: int) -> tuple[DataFrame, DataFrame]:
    """All documents' fingerprints, and (fp, root) of the distinct ones."""
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # 8 bytes a row, but much work on each: as many tasks as there are shuffle partitions
    distinct = prints.select("fp").distinct().repartition(spread, F.xxhash64("fp"))
    roots = connected_components(links(distinct, max_distance))
    return prints, (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_distance: int = MOST) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest doc_id reachable over links of at most ``max_distance`` (0 to 4) differing bits.

    A text of fewer words than a shingle is one shingle; null, empty and white-space texts have
    fingerprint zero and link like any other.  Repeated rows keep a row each; a null doc_id links
    but names no component (a component of such rows only has a null component_id); an empty
    table gives no rows; other columns are ignored.
    """
    prints, roots = _grouped(docs, shingle_words, max_distance)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(roots, "fp")
    component = first.groupBy("root").agg(F.min("first").alias("component_id"))
    of = first.join(component, "root").select("fp", "component_id")
    # files of many equal fingerprints are far smaller than their rows, so their size is no reason to broadcast them
    return prints.hint("merge").join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 4, max_distance: int = MOST) -> DataFrame:
    """The rows of ``docs``, all columns, without the near-duplicates: of each component one row
    stays, that with the smallest doc_id (a null one only if there is no other; then the smaller
    text hash; of rows equal in both, one)."""
    prints, roots = _grouped(docs, shingle_words, max_distance)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = (prints.groupBy("fp").agg(F.min(rank).alias("best")).join(roots, "fp")
            .groupBy("root").agg(F.min("best").alias("best")))
    key, of_row = "__near_duplicate_key", "__near_duplicate_rank"

    def name(doc_id, text_hash):
        return F.concat_ws("/", F.coalesce(doc_id.cast("long").cast("string"), F.lit("-")), text_hash.cast("string"))

    # the key names the row by value, so that neither nulls nor repeats match another row
    kept = kept.select(name(F.col("best.doc_id"), F.col("best.text_hash")).alias(key))
    # rows of one key are cut to one before they meet (a partial limit in each map task)
    one = Window.partitionBy(key).orderBy(key)
    rows = (docs.withColumn(key, name(F.col("doc_id"), F.xxhash64("text")))
            .withColumn(of_row, F.row_number().over(one)).where(F.col(of_row) == 1))
    return rows.join(kept, key).select(*[F.col(f"`{c}`") for c in docs.columns])
