"""Operator 5: token ids as binary files of patched frame-of-reference blocks.

Documents are range-partitioned and sorted by doc_id; every part encodes its documents, appends
the end id and writes segments.  A segment holds whole documents and is one binary value:

    header   magic, number of ids, number of blocks, number of exceptions
    index    per block of 256 ids: minimum, width, start of its packed words, first exception
    words    the differences to the minimum, ``width`` low bits each, 64 values in ``width`` words
    patches  position in the block and the bits above ``width`` of each outlier

``width`` is that of the block's 95th percentile difference; larger ones are patched.  Segments
are rows of a Parquet table in the given folder, so that Spark's commit protocol keeps retried
and lost tasks from leaving half-written files, on any store.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import partition_id, parts, texts
from fareflow.llm.tokens import text_ids

WORD_BPE = "word_bpe_49k.json"
END_ID = 1
BLOCK = 256  # ids in a block: four lanes of 64
MAGIC = b"PFR1"
_HEADER = struct.Struct("<4sIII")


def _lanes(width: int):
    """(value, word, shift) of a lane of 64 values packed in ``width`` 64-bit words."""
    return [(i, i * width // 64, i * width % 64) for i in range(64)]


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.uint8)


def encode(ids: np.ndarray, percentile: float = 0.95) -> bytes:
    """The binary segment of an array of 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return _HEADER.pack(MAGIC, 0, 0, 0)
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[:n] = ids
    grid = padded.reshape(blocks, BLOCK)
    low = grid.min(1)
    grid = grid - low[:, None]
    at = min(BLOCK - 1, int(percentile * BLOCK))
    width = _bit_length(np.partition(grid, at, axis=1)[:, at])
    kept = (np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)
    high = (grid.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    patched, position = np.nonzero(high)
    patches = high[patched, position]
    starts = np.concatenate([[0], np.cumsum(4 * width.astype(np.int64))])  # in words
    words = np.zeros(starts[-1], np.uint64)
    for w in np.unique(width):
        if w == 0:
            continue
        of = np.flatnonzero(width == w)
        values = np.ascontiguousarray((grid[of] & kept[of, None].astype(np.uint32)).reshape(-1, 64).T).astype(np.uint64)
        out = np.zeros((int(w), values.shape[1]), np.uint64)
        for i, word, shift in _lanes(int(w)):
            out[word] |= values[i] << np.uint64(shift)
            if shift + w > 64:
                out[word + 1] |= values[i] >> np.uint64(64 - shift)
        rows = (starts[of][:, None] + np.arange(4 * int(w))).ravel()
        words[rows] = np.ascontiguousarray(out.T).ravel()
    first = np.searchsorted(patched, np.arange(blocks))
    return b"".join([
        _HEADER.pack(MAGIC, n, blocks, len(patches)), low.astype("<u4").tobytes(), width.tobytes(),
        starts[:-1].astype("<u4").tobytes(), first.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
        position.astype(np.uint8).tobytes(), patches.astype("<u4").tobytes()])


def decode(data: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of a segment, or those of blocks ``first_block`` to ``last_block`` (exclusive)."""
    magic, n, blocks, n_patches = _HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = _HEADER.size

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype, count, at)
        at += out.nbytes
        return out

    low, width, starts, first = take("<u4", blocks), take("u1", blocks), take("<u4", blocks), take("<u4", blocks)
    words = take("<u8", int(4 * width.astype(np.int64).sum()))
    position, patches = take("u1", n_patches), take("<u4", n_patches)
    stop = blocks if last_block is None else min(last_block, blocks)
    pick = slice(first_block, stop)
    grid = np.zeros((max(0, stop - first_block), BLOCK), np.uint32)
    for w in np.unique(width[pick]):
        if w == 0:
            continue
        of = np.flatnonzero(width[pick] == w)
        rows = starts[pick][of].astype(np.int64)[:, None] + np.arange(4 * int(w))
        packed = np.ascontiguousarray(words[rows.ravel()].reshape(-1, int(w)).T)
        mask = np.uint64((1 << int(w)) - 1)
        values = np.empty((64, packed.shape[1]), np.uint32)
        for i, word, shift in _lanes(int(w)):
            v = packed[word] >> np.uint64(shift)
            if shift + w > 64:
                v = v | (packed[word + 1] << np.uint64(64 - shift))
            values[i] = v & mask
        grid[of] = np.ascontiguousarray(values.T).reshape(-1, BLOCK)
    ends = np.append(first[1:], n_patches)
    lo, hi = (int(first[first_block]), int(ends[stop - 1])) if stop > first_block else (0, 0)
    block = np.repeat(np.arange(blocks), ends.astype(np.int64) - first)[lo:hi] - first_block
    grid[block, position[lo:hi]] |= patches[lo:hi] << width[block + first_block]
    return (grid + low[pick, None]).ravel()[: max(0, min(n, stop * BLOCK) - first_block * BLOCK)]


def _segments(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, segment_ids: int):
    encoder, part, seq, start = text_ids(tokenizer), partition_id(), 0, 0
    end = np.array([end_id], "<u4")
    docs, held, size = [], [], 0

    def row():
        lengths = [len(p) + 1 for p in held]
        ids = np.concatenate([a for p in held for a in (p, end)])
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
             pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([encode(ids)], pa.binary())],
            ["part", "segment", "start", "n_ids", "doc_ids", "lengths", "data"])

    for batch in parts(batches):
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.all_ids(texts(batch)), strict=True):
            docs.append(doc_id)
            held.append(ids)
            size += len(ids) + 1
            if size >= segment_ids:
                yield row()
                seq, start, docs, held, size = seq + 1, start + size, [], [], 0
    if docs:
        yield row()


SEGMENT = ("part int, segment int, start long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, data binary")


def write_token_files(docs: DataFrame, path: str, tokenizer: str = WORD_BPE, end_id: int = END_ID,
                      segment_ids: int = 1 << 18) -> None:
    """Write the ids of all documents, in ascending doc_id order, to the folder ``path``.

    A null text is empty (its document holds the end id alone).  Null doc_ids come first;
    rows with the same doc_id follow one another in the order of a hash of their texts, and
    repeated rows are written each.  Other columns are ignored.  Range bounds include that
    hash, so one doc_id with very many rows spans several parts.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    (keyed.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text")
     .select("doc_id", "text")
     .mapInArrow(lambda it: _segments(it, tokenizer, end_id, segment_ids), SEGMENT)
     .write.option("compression", "none").parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).

    One total per part (there are as many as write tasks) is summed on the driver.
    """
    files = spark.read.schema(SEGMENT).parquet(path)
    offsets, before = {}, 0
    for part, n in sorted(files.groupBy("part").agg(F.sum("n_ids")).collect()):
        offsets[part] = before
        before += n

    def documents(batches):
        for batch in parts(batches):
            for row in batch.to_pylist():
                ids, at = decode(row["data"]).astype("<u4"), offsets[row["part"]] + row["start"]
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at + ends - lengths), pa.array(lengths),
                     pa.array([ids[e - k:e].tobytes() for e, k in zip(ends, lengths, strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return files.select("part", "start", "doc_ids", "lengths", "data").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids binary")
