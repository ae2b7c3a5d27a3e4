"""Operator 12: repeated byte strings, found by sorting sampled suffixes.

A string of ``length`` bytes that also starts earlier (smaller doc_id, or further left in the same
text) is removed.  Sorting the suffix of every byte would move each byte a hundred times, so
suffixes are sampled by content: of the ``gram``-byte grams of a string the one with the smallest
hash, the leftmost of equal ones, stands for it.  Equal strings choose the same gram at the same
place, so only suffixes that begin with the same gram need to be compared.  Neighbouring strings
mostly share their gram; a run of string starts with one gram is a row (about one for 45 bytes).

1. ``_rows``: the runs of each block of texts.  Runs with the same bytes in a block are settled there.
2. ``_sift``: sorted by gram and bytes (64-bit hashes of each), runs with the same bytes as an earlier one are
   repeats, and grams that stand in one kind of run only are done.  What is left are the ends of
   repeated passages: the first run of each kind, where a gram has several kinds.
3. These suffixes, with the bytes before them, are range-partitioned by their bytes with Spark's
   sampled splitters (and by position, so that frequent bytes are spread).  A run is parted where its gram
   comes into the string's second half: of a string with the gram in the first half more than half lies
   behind it, so these runs are ordered by that part and then by the bytes before, the others
   the other way round.  Strings that share the longer part and all bytes on the other side are then neighbours.
   ``_resolve`` sorts a bucket's suffixes, and the bytes before them from right to left, by
   multikey quicksort; the common prefixes of neighbours tell for every place of the gram which strings are equal.
4. Strings whose neighbours go on beyond a bucket's (or piece's) boundary are compared across boundaries
   by their bytes; each piece sends the first of equal strings only.
5. The removed starts return to the texts.

No task holds an unbounded group: rows stream in sorted order, and of equal strings each block or
piece forwards one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import parts, stored

LENGTH = 100
GRAM = 24
KINDS = 8  # kinds of runs of a gram in one block from which they go to the suffix sort directly
PIECE = 8192  # suffixes compared at once

_KEY = ("none", "id", "th")
_KEY_TYPES = "none boolean, id long, th long"
_RUN, _REPEAT, _END = 0, 1, 2  # to be compared; string starts to remove; a run for the suffix sort
_ROW = f"kind byte, kh long, sh long, {_KEY_TYPES}, at int, n int, to int"
_BYTE = np.random.default_rng(12).integers(0, 2**64, 256, dtype=np.uint64)
_MULTIPLY = 0x9E3779B97F4A7C15


def _gram_hashes(buffer: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from every place."""
    power, size = _BYTE[buffer], 1
    out, done = None, 0
    while True:
        if gram & size:
            if out is None:
                out, done = power, size
            else:
                out = out[:len(out) - size] * np.uint64(pow(_MULTIPLY, size, 2**64)) + power[done:]
                done += size
        if done == gram:
            break
        power = power[:len(power) - size] * np.uint64(pow(_MULTIPLY, size, 2**64)) + power[size:]
        size *= 2
    out = out ^ (out >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _first_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the offset of its lowest, the leftmost of equal ones."""
    offset, size = np.zeros(len(values), np.uint16), 1
    while size < width:
        step = min(size, width - size)
        left = values[:len(values) - step] <= values[step:]
        offset = np.where(left, offset[:len(values) - step], offset[step:] + np.uint16(step))
        values = np.where(left, values[:len(values) - step], values[step:])
        size += step
    return offset


def runs(pieces: list[bytes], length: int, gram: int):
    """Runs of string starts with one gram: (piece, first start, starts less one, gram's place after the first
    start, gram hash, hash of the run's bytes)."""
    empty = np.zeros(0, np.int64)
    sizes = np.array([len(p) for p in pieces])
    raw = b"".join(pieces)
    if len(raw) < length:
        return empty, empty, empty, empty, empty, empty
    ends = np.cumsum(sizes)
    inside = np.ones(len(raw), bool)
    for start, end in zip(np.maximum(ends - sizes, ends - length + 1).tolist(), ends.tolist(), strict=True):
        inside[start:end] = False
    at = np.flatnonzero(inside)
    if not len(at):
        return empty, empty, empty, empty, empty, empty
    hashes = _gram_hashes(np.frombuffer(raw, np.uint8), gram)
    chosen = at + _first_lowest((hashes >> np.uint64(32)).astype(np.uint32), length - gram + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    start, stop, place = at[first], at[last] + length, chosen[first]
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(raw[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)], np.uint64)
    piece = np.searchsorted(ends, start, "right")
    return piece, start - (ends - sizes)[piece], stop - length - start, place - start, hashes[place].view(np.int64), own.view(np.int64)


def _cut(texts: list[bytes], length: int, most: int):
    """Lists of (text number, offset, bytes) of about ``most`` bytes; longer texts in overlapping pieces."""
    out, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), most):
            piece = text[offset:offset + most + length - 1]
            out.append((number, offset, piece))
            size += len(piece)
            if size >= most:
                yield out
                out, size = [], 0
    if out:
        yield out


def _batch(kind, kh, sh, key, at, n, to) -> pa.RecordBatch:
    arrays = [pa.array(np.broadcast_to(np.int8(kind), len(at)).copy()), pa.array(kh, pa.int64()), pa.array(sh, pa.int64()),
              *(pa.array(k) for k in key), *(pa.array(np.asarray(v).astype(np.int32)) for v in (at, n, to))]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "kh", "sh", *_KEY, "at", "n", "to"])


def _merged(owner: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Intervals (both ends included) of each owner, joined where they touch; sorted by owner and start."""
    order = np.lexsort((first, owner))
    owner, first, last = owner[order], first[order], last[order]
    if not len(owner):
        return owner, first, last
    # the furthest end so far inside the owner: shift owners apart, then one running maximum
    far = np.maximum.accumulate(last + owner * (1 << 32)) - owner * (1 << 32)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (first[1:] > far[:-1] + 1)
    at = np.flatnonzero(new)
    return owner[at], first[at], far[np.append(at[1:], len(owner)) - 1]


def _within(doc, at, n, to, kh, sh):
    """The runs without those whose bytes stand earlier in the same text, and these as intervals of starts."""
    order = np.lexsort((at, doc, sh, kh))
    doc, at, n, to, kh, sh = (c[order] for c in (doc, at, n, to, kh, sh))
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (sh[1:] == sh[:-1]) & (kh[1:] == kh[:-1])
    return tuple(c[~again] for c in (doc, at, n, to, kh, sh)), _merged(doc[again], at[again], (at + n)[again])


def _rows(length: int, gram: int, block_bytes: int, piece_bytes: int):
    def block(keys: list[tuple], texts: list[bytes]):
        none, ids, th = (np.array(c) for c in zip(*keys, strict=True))
        order = np.lexsort((th, ids, none))
        rank = np.empty(len(order), np.int64)
        changes = [(c[order][1:] != c[order][:-1]) for c in (none, ids, th)]
        rank[order] = np.concatenate([[0], np.cumsum(np.logical_or.reduce(changes))])
        found, repeated = [], []
        for pieces in _cut(texts, length, piece_bytes):
            piece, *rest = runs([p for _, _, p in pieces], length, gram)
            number, offset = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
            rows = (number[piece], rest[0] + offset[piece], *rest[1:])
            if 8 * len(piece) > sum(len(p) for _, _, p in pieces):  # a text that repeats itself has a run for nearly every byte
                rows, more = _within(*rows)
                repeated.append(more)
            found.append(rows)
        doc, at, n, to, kh, sh = (np.concatenate(c) for c in zip(*found, strict=True))
        if not len(doc):
            return
        order = np.lexsort((at, rank[doc], sh, kh))
        doc, at, n, to, kh, sh = (c[order] for c in (doc, at, n, to, kh, sh))
        new_gram = np.concatenate([[True], kh[1:] != kh[:-1]])
        new = new_gram.copy()
        new[1:] |= sh[1:] != sh[:-1]
        first = np.flatnonzero(new)
        leader = first[np.cumsum(new) - 1]
        again = ~new & ((rank[doc] != rank[doc[leader]]) | (at != at[leader]))
        again = zip((doc[again], at[again], (at + n)[again]), *repeated, strict=True)
        owner, start, stop = _merged(*(np.concatenate(c) for c in again))
        nothing = np.zeros(len(owner), np.int64)
        yield _batch(_REPEAT, nothing, nothing, (none[owner], ids[owner], th[owner]), start, stop - start, nothing)
        # two kinds of a frequent gram show the others that it has several; the rest need no comparison
        group = np.cumsum(new_gram[first]) - 1
        place = np.arange(len(first)) - np.flatnonzero(new_gram[first])[group]
        direct = (np.bincount(group)[group] > KINDS) & (place >= 2)
        for kind, own in ((_END, first[direct]), (_RUN, first[~direct])):
            of = doc[own]
            yield _batch(kind, kh[own], sh[own], (none[of], ids[of], th[of]), at[own], n[own], to[own])

    def run(batches):
        keys, texts, size = [], [], 0
        for batch in parts(batches):
            for key, text in zip(zip(*(batch.column(c).to_pylist() for c in _KEY), strict=True), batch.column("text").to_pylist(), strict=True):
                if text is not None and len(text) >= length:
                    keys.append(key)
                    texts.append(text)
                    size += len(text)
                    if size >= block_bytes:
                        yield from block(keys, texts)
                        keys, texts, size = [], [], 0
        if keys:
            yield from block(keys, texts)
    return run


def _sift(batches):
    """Rows sorted by kind, gram, bytes and position: repeats of a run, and first runs of grams with several kinds."""
    fields = ("kh", "sh", *_KEY, "at", "n", "to")
    held, several = None, False  # the first row of the last run, and whether its gram has shown another kind
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind != _RUN).any():
            yield batch.filter(pa.array(kind != _RUN))
            batch = batch.filter(pa.array(kind == _RUN))
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in fields}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in fields}
        size = len(rows["at"])
        if not size:
            continue
        same_gram = np.concatenate([[False], rows["kh"][1:] == rows["kh"][:-1]])
        new = ~same_gram
        new[1:] |= rows["sh"][1:] != rows["sh"][:-1]
        first = np.flatnonzero(new)
        leader = first[np.cumsum(new) - 1]
        again = np.flatnonzero(~new & np.logical_or.reduce([rows[c] != rows[c][leader] for c in (*_KEY, "at")]))
        mixed = same_gram[first]
        mixed[0] = several
        mixed[:-1] |= same_gram[first[1:]]
        ends = first[:-1][mixed[:-1]]
        for out, own in ((_REPEAT, again), (_END, ends)):
            yield _batch(out, rows["kh"][own], rows["sh"][own], [rows[c][own] for c in _KEY], *(rows[c][own] for c in ("at", "n", "to")))
        held, several = {c: rows[c][first[-1:]] for c in fields}, bool(mixed[-1])
    if held is not None and several:
        yield _batch(_END, held["kh"], held["sh"], [held[c] for c in _KEY], *(held[c] for c in ("at", "n", "to")))


def multikey_order(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of byte strings (rows padded with 0, ``sizes`` bytes long), eight bytes a key: each round
    sorts by the next key those rows only that are equal so far.  Returns the order and, for each
    row in it, the common prefix with the row before."""
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, :rows.shape[1]] = rows
    keys = wide.view(">u8").astype(np.uint64)
    order = np.arange(len(rows))
    group = np.zeros(len(rows), np.int64)  # by place in the order: rows equal so far
    for key in [*keys.T, sizes]:
        tied = np.zeros(len(rows), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        own = order[open_]
        sorted_ = np.lexsort((key[own], group[open_]))
        order[open_] = own[sorted_]
        new = np.ones(len(rows), bool)
        new[1:] = group[1:] != group[:-1]
        value = key[order]
        new[1:] |= tied[1:] & tied[:-1] & (value[1:] != value[:-1])
        group = np.cumsum(new)
    common = np.zeros(len(rows), np.int64)
    for at in range(0, len(rows) - 1, 1024):  # compared in parts, so that the copies stay small
        a, b = order[at:at + 1025][:-1], order[at:at + 1025][1:]
        differs = rows[a] != rows[b]
        equal = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
        common[at + 1:at + 1 + len(equal)] = np.minimum(equal, np.minimum(sizes[a], sizes[b]))
    return order, common


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(v) for v in values], np.int64)
    return np.frombuffer(b"".join([v.ljust(width, b"\0") for v in values]), np.uint8).reshape(len(values), width), sizes


_RESOLVED = f"window binary, {_KEY_TYPES}, at int, n int"


def _half(length: int, gram: int) -> int:
    """The gram's last place in a string that counts as the first half."""
    return (length - gram) // 2


def _shared(rows: np.ndarray, sizes: np.ndarray, with_: int) -> np.ndarray:
    """The common prefix of each row with the row ``with_``."""
    differs = rows != rows[with_]
    return np.minimum(np.where(differs.any(1), differs.argmax(1), rows.shape[1]), np.minimum(sizes, sizes[with_]))


def _resolve(length: int, gram: int):
    """Suffixes and the reversed bytes before them in the order of ``_order``: string starts to remove, and the strings
    that may go on beyond the piece (``window``), to be compared with those of other pieces."""
    most, half = length - gram, _half(length, gram)  # most: the gram's last place in a string

    def piece(before: list[bytes], suffix: list[bytes], key: list[np.ndarray], at: np.ndarray):
        by_position = np.lexsort((at + np.array([len(b) for b in before]), *key[::-1]))
        edges = np.flatnonzero((by_position == 0) | (by_position == len(at) - 1)).tolist()  # the piece's first and last row
        before, suffix = [before[i] for i in by_position], [suffix[i] for i in by_position]
        key, at = [k[by_position] for k in key], at[by_position]
        left, left_size = _matrix(before, most)
        right, right_size = _matrix(suffix, length)
        low, high = length - right_size, left_size  # places of the gram in the row's strings
        place = at + left_size  # of the gram in its text
        side = np.where(high <= half, 1, np.where(low > half, 2, 0))  # 0: runs that are not parted, ordered by gram only
        near = []  # rows with an edge's order, and bytes that their strings share with the edge on the other side
        for e in edges:
            behind, before_ = _shared(right, right_size, e), _shared(left, left_size, e)
            near.append(((side == side[e]) & [behind >= gram, behind >= length - half, before_ > half][side[e]], side[e], behind, before_))
        position = np.concatenate([[0], np.cumsum(np.logical_or.reduce([place[1:] != place[:-1], *(k[1:] != k[:-1] for k in key)]))])
        right_order, right_common = multikey_order(right, right_size)
        left_order, left_common = multikey_order(left, left_size)
        remove = np.zeros((len(at), most + 1), bool)  # by row and by start after the row's first
        kind = np.empty((2, len(at)), np.int64)
        for back in range(most + 1):
            kind[0, right_order] = np.cumsum(right_common < length - back)
            kind[1, left_order] = np.cumsum(left_common < back)
            rows = np.flatnonzero((low <= back) & (back <= high))
            if not len(rows):
                continue
            string = kind[0, rows] * (len(at) + 1) + kind[1, rows]
            _, first, of = np.unique(string, return_index=True, return_inverse=True)  # rows are in order of position
            first = rows[first][of]
            again = position[rows] != position[first]
            remove[rows[again], left_size[rows[again]] - back] = True
            beyond = np.logical_or.reduce([own & [True, before_ >= back, behind >= length - back][of] for own, of, behind, before_ in near])
            asks = rows[(first == rows) & beyond[rows]]
            if len(asks):
                whole = np.concatenate([left[asks, :back][:, ::-1], right[asks, :length - back]], axis=1)
                window = pa.Array.from_buffers(pa.binary(), len(asks), [
                    None, pa.py_buffer(np.arange(0, length * len(asks) + 1, length, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(whole).tobytes())])
                yield _result(window, [k[asks] for k in key], place[asks] - back, np.zeros(len(asks)))
        edge = np.zeros((len(at), most + 3), bool)
        edge[:, 1:-1] = remove
        row, begin = np.nonzero(edge[:, 1:] & ~edge[:, :-1])
        _, end = np.nonzero(edge[:, :-1] & ~edge[:, 1:])
        yield _result(pa.nulls(len(row), pa.binary()), [k[row] for k in key], at[row] + begin, end - 1 - begin)

    def run(batches):
        before, suffix, key, at = [], [], [[], [], []], []

        def cut(size: int):
            return piece(before[:size], suffix[:size], [np.array(k[:size]) for k in key], np.array(at[:size], np.int64))

        for batch in parts(batches, PIECE):
            before += batch.column("before").to_pylist()
            suffix += batch.column("suffix").to_pylist()
            for values, name in zip(key, _KEY, strict=True):
                values += batch.column(name).to_pylist()
            at += batch.column("at").to_pylist()
            while len(at) >= PIECE:
                yield from cut(PIECE)
                for values in (before, suffix, at, *key):
                    del values[:PIECE]
        if at:
            yield from cut(len(at))
    return run


def _result(window, key, at, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([window, *(pa.array(k) for k in key), pa.array(np.asarray(at).astype(np.int32)),
                                       pa.array(np.asarray(n).astype(np.int32))], ["window", *_KEY, "at", "n"])


def _across(batches):
    """Strings sorted by bytes and position: all but those at the first position are repeats."""
    last = None
    for batch in batches:
        done = batch.column("window").is_null()
        yield batch.filter(done)
        open_ = batch.filter(pc.invert(done))
        keep = []
        for i, row in enumerate(zip(*(open_.column(c).to_pylist() for c in ("window", *_KEY, "at")), strict=True)):
            if last is None or row[0] != last[0]:
                last = row
            elif row != last:
                keep.append(i)
        yield open_.take(pa.array(keep, pa.int32()))


def _lists(column: pa.Array, fields: tuple[str, ...]):
    """(start of each row's values, values of each field) of an array of structs."""
    offsets = column.offsets.to_numpy()
    values = column.values
    return offsets, [values.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _order(length: int, gram: int) -> list[Column]:
    """The order of the suffixes: see step 3 of the module's text."""
    half = _half(length, gram)
    first = F.length("before") <= half
    own = (F.when(first, F.concat(F.substring("suffix", 1, length - half), "before"))
           .otherwise(F.concat(F.substring("suffix", 1, gram), F.substring("before", 1, half + 1), F.col("suffix").substr(gram + 1, length))))
    return [first, own, *(F.col(c) for c in _KEY), F.col("at") + F.length("before")]


def _ends(length: int, gram: int):
    """The suffixes of the runs that a text is asked for, with the bytes before them from right to left; a run is
    parted between the halves of the gram's places."""
    half = _half(length, gram)

    def run(batches):
        for batch in parts(batches):
            offsets, (start, n, to) = _lists(batch.column("asked"), ("at", "n", "to"))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            if not len(rows):
                continue
            start, n, to = (v[offsets[0]:offsets[-1]] for v in (start, n, to))
            late = np.clip(to - half, 0, n + 1)  # string starts with the gram in the second half
            rows, start, n, to = (np.concatenate([a[late > 0], b[late <= n]]) for a, b in
                                  ((rows, rows), (start, start + late), (late - 1, n - late), (to, to - late)))
            texts = batch.column("text").to_pylist()
            own = [texts[r] for r in rows.tolist()]
            places = (start + to).tolist()
            before = [t[a:x][::-1] for t, a, x in zip(own, start.tolist(), places, strict=True)]
            suffix = [t[x:b] for t, x, b in zip(own, places, (start + n + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(suffix, pa.binary()), pa.array(before, pa.binary()),
                                              *(batch.column(c).take(pa.array(rows)) for c in _KEY), pa.array(start.astype(np.int32))],
                                             ["suffix", "before", *_KEY, "at"])
    return run


def _kept(length: int):
    """Per text its bytes without the removed ones."""
    def run(batches):
        for batch in parts(batches):
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
            offsets, (start, n) = _lists(batch.column("removed"), ("at", "n"))
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or b""
                own = slice(offsets[i], offsets[i + 1])
                first = start[own].astype(np.int64)
                _, first, last = _merged(np.zeros(len(first), np.int64), first, first + n[own] + length - 1)
                kept, at = [], 0
                for a, b in zip(first.tolist(), last.tolist(), strict=True):
                    kept.append(text[at:a])
                    at = b + 1
                kept = b"".join([*kept, text[at:]])
                for c, v in (("n_bytes", len(text)), ("n_removed", len(text) - len(kept)), ("n_spans", len(first)), ("kept", kept)):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*_KEY, "copies")), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                 pa.array(out["kept"], pa.binary())], [*_KEY, "copies", *out])
    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = 16 << 20,
                    piece_bytes: int = 2 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs of removed bytes) and
    ``kept`` (the UTF-8 bytes left, as binary; cutting may part a character).

    Every byte goes that a string of ``length`` bytes covers which also starts earlier: in a document
    with a smaller doc_id, or further left.  A null text is empty; texts under ``length`` bytes
    lose nothing.  Null doc_ids come after all others; rows with one doc_id are ordered by a hash of
    their texts; of rows equal in both, one counts as the first and the others lose all their
    strings.  An empty table gives no rows; other columns are ignored.
    """
    if not 8 <= gram < length:
        raise ValueError("gram must be 8 to length - 1 bytes")
    keyed = docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"),
                        F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    found = keyed.mapInArrow(_rows(length, gram, block_bytes, piece_bytes), _ROW)
    dealt = F.when(F.col("kind") == _RUN, F.col("kh")).otherwise(F.xxhash64("id", "th"))
    sifted = (found.repartition(dealt).sortWithinPartitions("kind", "kh", "sh", *_KEY, "at").mapInArrow(_sift, _ROW))
    places = F.struct("at", "n", "to")
    marks = stored(sifted.groupBy(*_KEY).agg(F.collect_list(F.when(F.col("kind") == _REPEAT, F.struct("at", "n"))).alias("repeats"),
                                             F.collect_list(F.when(F.col("kind") == _END, places)).alias("asked")), "repeat-marks")
    # the texts by key: used for the suffixes and again for the result (one shuffle, which Spark reuses)
    texts = keyed.groupBy(*_KEY).agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    asked = marks.select(*_KEY, "asked").hint("shuffle_hash")
    suffixes = (texts.join(asked, list(_KEY), "left").select(*_KEY, "text", F.coalesce("asked", F.array().cast("array<struct<at:int,n:int,to:int>>")).alias("asked"))
                .mapInArrow(_ends(length, gram), f"suffix binary, before binary, {_KEY_TYPES}, at int"))
    order = _order(length, gram)
    resolved = suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_resolve(length, gram), _RESOLVED)
    across = (resolved.repartition(F.when(F.col("window").isNull(), F.xxhash64("id", "th")).otherwise(F.xxhash64("window")))
              .sortWithinPartitions("window", *_KEY, "at").mapInArrow(_across, _RESOLVED))
    more = across.groupBy(*_KEY).agg(F.collect_list(F.struct("at", "n")).alias("more")).hint("shuffle_hash")
    none = F.array().cast("array<struct<at:int,n:int>>")
    removed = F.concat(F.coalesce("repeats", none), F.coalesce("more", none))
    kept = (texts.join(marks.select(*_KEY, "repeats").hint("shuffle_hash"), list(_KEY), "left").join(more, list(_KEY), "left")
            .select(*_KEY, "text", "copies", removed.alias("removed"))
            .mapInArrow(_kept(length), f"{_KEY_TYPES}, copies long, n_bytes long, n_removed long, n_spans long, kept binary"))
    each = kept.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    whole = (F.col("copy") > 1) & (F.col("n_bytes") >= length)
    return each.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_bytes",
                       F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                       F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
                       F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
