"""Operator 1: token counts without token ids.

Documents are read in blocks.  A block knows its distinct pre-tokens and, per document, how
often each occurs.  The pre-tokens of all blocks are shuffled by their text, so that each
distinct one is cut into pieces once; the piece counts return to the blocks and are multiplied
with the per-document frequencies.  No id is ever made, and what moves is one row per block and
distinct pre-token plus the packed frequencies, both in proportion to the input.

Both reads of the documents must see the same rows in the same partitions, as file scans do.
Each read sends a digest of a block's pre-tokens, one with the packed frequencies and one in a row
among the pre-tokens; blocks whose digests differ raise an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fareflow.llm.common import partition_id, parts, texts
from fareflow.llm.tokens import pre_tokens

BYTE_BPE = "byte_bpe_50k.json"


class _Numbers(dict):
    """Pre-token -> running number inside a block."""

    def __missing__(self, piece):
        n = self[piece] = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, block_bytes: int):
    """(block, doc_ids, bytes per document, numbers, rows of numbers, frequencies) of each block."""
    cut = pre_tokens(tokenizer).cut
    part, seq = partition_id(), 0
    numbers, ids, sizes, rows, size = _Numbers(), [], [], [], 0
    for batch in parts(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
            pieces = cut(text)
            rows.append(np.unique(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)), return_counts=True))
            ids.append(doc_id)
            sizes.append(len(text.encode()))
            size += sizes[-1]
            if size >= block_bytes:
                yield (part << 32) | seq, ids, sizes, numbers, rows
                seq += 1
                numbers, ids, sizes, rows, size = _Numbers(), [], [], [], 0
    if ids:
        yield (part << 32) | seq, ids, sizes, numbers, rows


def _digest(numbers: dict) -> int:
    """31 bits over the block's pre-tokens and their order."""
    return zlib.crc32("\0".join(numbers).encode()) >> 1


def _deltas(rows) -> np.ndarray:
    """Sorted numbers of each document as differences: small values that compress well."""
    return np.concatenate([np.diff(r[0], prepend=np.uint32(0)) for r in rows]) if rows else np.zeros(0, np.uint32)


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of 32-bit values, compressed: the high planes are nearly all zero."""
    return zlib.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unplanes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


def token_counts(docs: DataFrame, tokenizer: str = BYTE_BPE, block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    ``tokenizer`` is a file of the tokenizers library: a path or a public name.  A null text is
    an empty one (0 bytes, 0 tokens); null or repeated doc_ids keep a row each; an empty table
    gives no rows; other columns are ignored.  ``block_bytes`` bounds a worker's memory (a
    single longer text is a block of its own).
    """
    docs = docs.select("doc_id", "text")

    def block_pieces(batches):
        for block, _, _, numbers, _ in _blocks(batches, tokenizer, block_bytes):
            # the last row has no piece and the digest as a negative number
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * (len(numbers) + 1), pa.int64()), pa.array([*range(len(numbers)), -1 - _digest(numbers)], pa.int32()),
                 pa.array([*numbers, None], pa.string())], ["block", "no", "piece"])

    def counted(batches):
        count, last = pre_tokens(tokenizer).count, (None, 0)
        for batch in batches:  # sorted by piece: each distinct one is counted once
            coded = pc.dictionary_encode(batch.column("piece"))
            values = coded.dictionary.to_pylist()
            n = [last[1] if v == last[0] else count(v) for v in values]
            if values:
                last = (values[-1], n[-1])
            counts = np.array([*n, 0], np.int32)[coded.indices.fill_null(len(n)).to_numpy()]  # a digest's row counts nothing
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("no"), pa.array(counts, pa.int32())], ["block", "no", "n"])

    def frequencies(batches):
        for block, ids, sizes, numbers, rows in _blocks(batches, tokenizer, block_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([len(numbers)], pa.int32()), pa.array([_digest(numbers)], pa.int64()),
                 pa.array([_planes(np.array([len(r[0]) for r in rows], np.uint32))], pa.binary()),
                 pa.array([_planes(_deltas(rows))], pa.binary()),
                 pa.array([_planes(np.concatenate([r[1] for r in rows]))], pa.binary())],
                ["block", "ids", "sizes", "distinct", "digest", "lengths", "deltas", "counts"])

    def summed(key, block: pa.Table, counts: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_bytes": [], "n_tokens": []}
        no, found = counts.column("no").to_numpy(), counts.column("n").to_numpy()
        digest = -1 - no[no < 0]
        if block.num_rows != 1 or digest.tolist() != block.column("digest").to_pylist() or block.column("distinct")[0].as_py() != len(no) - 1:
            raise RuntimeError("the documents differ between two reads; store them first")
        n = np.zeros(len(no) - 1, np.int64)
        n[no[no >= 0]] = found[no >= 0]
        row = {k: block.column(k)[0].as_py() for k in ("ids", "sizes", "lengths", "deltas", "counts")}
        lengths, deltas, freq = (_unplanes(row[k]).astype(np.int64) for k in ("lengths", "deltas", "counts"))
        ends = np.cumsum(lengths)
        total = np.cumsum(deltas)  # running over documents: take off what stood before each
        before = np.concatenate([[0], total])[ends - lengths]
        products = n[total - np.repeat(before, lengths)] * freq if len(n) else np.zeros(0, np.int64)
        running = np.concatenate([[0], np.cumsum(products)])
        out = {"doc_id": row["ids"], "n_bytes": row["sizes"], "n_tokens": running[ends] - running[ends - lengths]}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    counts = (docs.mapInArrow(block_pieces, "block long, no int, piece string")
              .repartition("piece").sortWithinPartitions("piece")
              .mapInArrow(counted, "block long, no int, n int"))
    blocks = docs.mapInArrow(frequencies, "block long, ids array<bigint>, sizes array<bigint>, distinct int, digest long, "
                                          "lengths binary, deltas binary, counts binary")
    return (blocks.groupBy("block").cogroup(counts.groupBy("block"))
            .applyInArrow(summed, "doc_id long, n_bytes long, n_tokens long"))
