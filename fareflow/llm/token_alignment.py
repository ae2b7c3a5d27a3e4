"""Operator 11: alignment of two tokenizers by an associative fragment monoid.

Both tokenizers cut the same bytes.  Where tokens of both end at one byte offset a group ends, and the
tokens of a group are linked with each other.

A text of up to ``long_bytes`` is aligned in one go, many texts of a block at once.  A longer one is
cut into byte ranges, each tokenizer's at a place where its tokens provably do not depend on the other
side (the two need not be the same place).  A range yields a ``Fragment``: the tokens before its
first common end (open prefix), the closed groups, the tokens after its last common end (open
suffix); without a common end all tokens are open.  Fragments compose associatively: only the
open parts between two fragments are looked at again, and what closes there leaves the reduction at
once.  So the ranges of a document are reduced in a tree of Spark groups of ``FAN`` neighbours,
which carries open tokens only.

The count of an id pair is the number of documents that hold it linked.  A block sends each of its
distinct pairs once, with the number of its documents; totals and each left id's highest total
return to the blocks the same way and are multiplied with the packed link counts of each document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import partition_id, parts, stored, texts, tokenizer_file
from fareflow.llm.tokens import BYTE_LEVEL

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
LONG, CHUNK, BLOCK, FAN = 64 << 10, 32 << 10, 1 << 20, 16
ID_BITS = 20  # of a pair's right id
_MANY = 1 << 16  # links of a group from which equal ids are counted before they are paired

# Fixed value: the byte-level cut pattern of the public vocabulary.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond these characters regular-expression libraries may differ in what a letter is.
_plain = regex.compile("[\x00-ɏ]*+")
# A token of the left side never spans the place after a visible ASCII character and before white space; one of
# the right side never that before a single space (see ``Right.cuttable``).
_LEFT_CUT = re.compile(rb"[\x21-\x7e](?=[ \t\n][\x21-\x7e])")
_RIGHT_CUT = re.compile(rb"[\x21-\x7e](?= [\x21-\x7e\x80-\xff])")


class Left:
    """Byte-level BPE of the tokenizers library; special strings in a text are text."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file(name))
        self.library.encode_special_tokens = True
        back = {c: b for b, c in BYTE_LEVEL.items()} | {chr(b): b for b in range(256) if b not in BYTE_LEVEL}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(back[c] for c in token)
        self.sizes = np.array([len(b) for b in self.bytes])
        self.fast = self._ranked(json.loads(self.library.to_str()), vocabulary)

    def _ranked(self, spec: dict, vocabulary: dict):
        """The same merges by rank, where ids are numbered in the order of merges (then they say the same)."""
        import tiktoken

        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if (spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]
                or model.get("ignore_merges") or [vocabulary[m] for m in merged] != list(range(256, 256 + len(merged)))):
            return None
        ranks = {b: i for i, b in enumerate(self.bytes[:256 + len(merged)])}
        return tiktoken.Encoding("ranked", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merged) else None

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [self.fast.encode_ordinary(t) if _plain.fullmatch(t) else self.library.encode(t, add_special_tokens=False).ids for t in texts]


class Right:
    """A sentencepiece model that adds a space before each text."""

    def __init__(self, name: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name))
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = np.array([len(b) for b in self.bytes])
        # no piece goes on with a space after something else, so no merge spans the start of a word
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def sides(left: str, right: str) -> tuple[Left, Right]:
    a, b = Left(left), Right(right)
    if max(len(a.bytes), len(b.bytes)) >= 1 << ID_BITS:
        raise ValueError(f"vocabularies of up to 2 ** {ID_BITS} ids")
    return a, b


def _joined(side, ids: list[int], raw: bytes) -> bool:
    return b"".join([side.bytes[i] for i in ids]) == raw


@dataclass
class Tokens:
    """Ids and byte offsets of their ends, of both sides."""
    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self.arrays(), other.arrays(), strict=True)))

    def arrays(self):
        return self.a, self.a_end, self.b, self.b_end

    def common(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)

    def between(self, low, high) -> Tokens:
        """The tokens that end after ``low`` and up to ``high``."""
        i, j = np.searchsorted(self.a_end, [low, high], "right")
        k, m = np.searchsorted(self.b_end, [low, high], "right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])


NO_TOKENS = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


class Groups:
    """Closed groups of one or more texts: every text's last byte is a common end."""

    def __init__(self, tokens: Tokens):
        self.tokens, self.ends = tokens, tokens.common()
        self.of_a, self.of_b = np.searchsorted(self.ends, tokens.a_end), np.searchsorted(self.ends, tokens.b_end)
        self.n_a, self.n_b = (np.bincount(of, minlength=len(self.ends)) for of in (self.of_a, self.of_b))

    def text(self, last: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as ``a1,a2|b1;`` and the place of each text's end in it; ``last``: its last group."""
        last_a, last_b = (np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool) for of in (self.of_a, self.of_b))
        # a group's left ids stand before its right ids
        place_a = np.arange(len(self.of_a)) + np.cumsum(np.append(0, self.n_b))[self.of_a]
        place_b = np.arange(len(self.of_b)) + np.cumsum(self.n_a)[self.of_b]
        ids = np.empty(len(self.of_a) + len(self.of_b), np.int64)
        ids[place_a], ids[place_b] = self.tokens.a, self.tokens.b
        mark = np.zeros(len(ids), np.int64)
        mark[place_a], mark[place_b] = last_a, 2 * last_b
        sizes = np.cumsum(np.searchsorted(_DIGITS, ids, "right") + 1)
        written = _written(max(16, int(ids.max(initial=0)).bit_length()))[mark, ids].tobytes().translate(None, b"\0")
        return written, sizes[np.cumsum(self.n_a + self.n_b)[last] - 1]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, pair, occurrences): pairs of left and right ids; a pair may stand more than once in a group."""
        many = self.n_a * self.n_b > _MANY
        repeat = np.where(many, 0, self.n_b)[self.of_a]
        # of a left token's links the i-th goes to the i-th right token of its group
        skip = np.cumsum(np.append(0, self.n_b))[self.of_a] - (np.cumsum(repeat) - repeat)
        right = np.repeat(skip, repeat)
        right += np.arange(len(right))
        pair = np.repeat(self.tokens.a << ID_BITS, repeat)
        pair |= self.tokens.b[right]
        out = [(np.repeat(self.of_a, repeat), pair, np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(many):
            a, n = np.unique(self.tokens.a[self.of_a == g], return_counts=True)
            b, m = np.unique(self.tokens.b[self.of_b == g], return_counts=True)
            out.append((np.full(len(a) * len(b), g), (a[:, None] << ID_BITS | b).ravel(), (n[:, None] * m).ravel()))
        return out[0] if len(out) == 1 else tuple(np.concatenate(c) for c in zip(*out, strict=True))


_DIGITS = np.array([0, *(10**n for n in range(1, 7))])  # an id has as many digits as there are values up to it


@lru_cache(maxsize=2)
def _written(bits: int) -> np.ndarray:
    """Every id of so many bits as text, with what follows it: an id of its side, the other side, the next group."""
    ids = np.arange(1 << bits).astype("S7")
    return np.array([np.char.add(ids, mark) for mark in (b",", b"|", b";")])


def summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray):
    """(owner, pair, times) with each pair of an owner once, sorted."""
    key = owner << (2 * ID_BITS)  # below 2 ** 23 owners in a block
    key |= pair
    order = np.argsort(key)
    key, times = key[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key, times = key[at], np.add.reduceat(times, at) if len(at) else times
    return key >> (2 * ID_BITS), key & ((1 << 2 * ID_BITS) - 1), times


# ---- short texts -----------------------------------------------------------------

_BLOCK = ("block long, ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
          "shas array<string>, kinds array<bigint>, pairs array<bigint>, docs array<int>, of binary, times binary")


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, "<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), "<u4").astype(np.int64)


def _blocks(left: str, right: str, block_bytes: int):
    def block(number: int, ids: list, chosen: list[tuple]):
        """``chosen``: per document None, or its bytes' number and the two id lists."""
        whole = [i for i, c in enumerate(chosen) if c is not None]
        sizes = np.array([chosen[i][0] for i in whole], np.int64)
        a, b = sides(left, right)
        ta = np.concatenate([np.zeros(0, np.int64), *(np.array(chosen[i][1], np.int64) for i in whole)])
        tb = np.concatenate([np.zeros(0, np.int64), *(np.array(chosen[i][2], np.int64) for i in whole)])
        groups = Groups(Tokens(ta, np.cumsum(a.sizes[ta]), tb, np.cumsum(b.sizes[tb])))
        last = np.searchsorted(groups.ends, np.cumsum(sizes))  # each document's last group
        doc_of = np.repeat(np.arange(len(whole)), np.diff(last, prepend=-1))
        counts = np.zeros((4, len(ids)), np.int64)
        for row, values in enumerate((groups.n_a, groups.n_b, np.ones(len(groups.ends)), groups.n_a * groups.n_b)):
            counts[row, whole] = np.bincount(doc_of, values, minlength=len(whole)) if len(whole) else 0
        written, ends = groups.text(last)
        shas, at = [""] * len(ids), 0
        for i, end in zip(whole, ends.tolist(), strict=True):
            shas[i] = hashlib.sha256(memoryview(written)[at:end - 1]).hexdigest()
            at = end
        group, pair, times = groups.links()
        doc, pair, times = summed(doc_of[group], pair, times)
        pairs, of, docs = np.unique(pair, return_inverse=True, return_counts=True)
        kinds = np.zeros(len(ids), np.int64)
        kinds[whole] = np.bincount(doc, minlength=len(whole))
        deltas = np.diff(of, prepend=0)
        deltas[np.flatnonzero(np.diff(doc, prepend=-1))] = of[np.flatnonzero(np.diff(doc, prepend=-1))]  # anew in each document
        lists = [pa.array([v], pa.list_(pa.int64())) for v in (ids, *counts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *lists, pa.array([shas], pa.list_(pa.string())), pa.array([kinds], pa.list_(pa.int64())),
             pa.array([pairs], pa.list_(pa.int64())), pa.array([docs.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([_packed(deltas)], pa.binary()), pa.array([_packed(times)], pa.binary())],
            ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "shas", "kinds", "pairs", "docs", "of", "times"])

    def run(batches):
        a, b = sides(left, right)
        part, done, ids, chosen, size = partition_id(), 0, [], [], 0
        for batch in parts(batches, 256):
            own = texts(batch)
            ids += batch.column("doc_id").to_pylist()
            for text, x, y in zip(own, a.ids([" " + t for t in own]), b.ids(own), strict=True):
                raw = b" " + text.encode()
                fits = text and _joined(a, x, raw) and _joined(b, y, raw)
                chosen.append((len(raw), np.array(x, np.int32), np.array(y, np.int32)) if fits else None)
                size += len(raw)
            if size >= block_bytes:
                yield block((part << 32) | done, ids, chosen)
                done, ids, chosen, size = done + 1, [], [], 0
        if ids:
            yield block((part << 32) | done, ids, chosen)
    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _weighed(key, block: pa.Table, totals: pa.Table) -> pa.Table:
    """A block's documents with the totals of its pairs."""
    if not block.num_rows:  # totals without a block do not occur
        return pa.table({c: pa.array([], pa.string() if c == "groups_sha256" else pa.int64()) for c in [f.split()[0] for f in _RESULT.split(", ")]})
    row = {c: block.column(c)[0].as_py() for c in block.column_names}
    count, best = np.zeros(totals.num_rows, np.int64), np.zeros(totals.num_rows, np.int64)
    no = totals.column("no").to_numpy()
    count[no], best[no] = totals.column("count").to_numpy(), totals.column("best").to_numpy()
    kinds = np.array(row["kinds"], np.int64)
    size = int(kinds.sum())
    deltas, times = _unpacked(row["of"], size), _unpacked(row["times"], size)
    ends = np.cumsum(kinds)
    total = np.cumsum(deltas)
    of = total - np.repeat(np.append(0, total)[ends - kinds], kinds)
    out = {}
    for name, values in (("n_best", times * (count[of] == best[of])), ("count_sum", times * count[of])):
        running = np.append(0, np.cumsum(values))
        out[name] = running[ends] - running[ends - kinds]
    columns = {"doc_id": row["ids"], **{c: row[c] for c in ("n_a", "n_b", "n_groups", "n_links")}, **out}
    return pa.table({**{c: pa.array(v, pa.int64()) for c, v in columns.items()}, "groups_sha256": pa.array(row["shas"], pa.string())})


# ---- long texts ------------------------------------------------------------------

@dataclass
class Fragment:
    """Tokens of a byte range.  ``closed``: whether a common end lies inside; then ``prefix`` ends at the
    first and ``suffix`` starts after the last; otherwise ``prefix`` holds all tokens."""
    closed: bool
    prefix: Tokens
    suffix: Tokens

    @staticmethod
    def of(tokens: Tokens) -> tuple[Fragment, Tokens]:
        """The fragment of tokens, and the tokens of its closed groups."""
        ends = tokens.common()
        if not len(ends):
            return Fragment(False, tokens, NO_TOKENS), NO_TOKENS
        return (Fragment(True, tokens.between(-1, ends[0]), tokens.between(ends[-1], np.inf)), tokens.between(ends[0], ends[-1]))

    def __add__(self, other: Fragment) -> tuple[Fragment, Tokens]:
        """The composition, and the tokens of the groups that close by it."""
        middle = (self.suffix if self.closed else self.prefix) + other.prefix
        whole, groups = Fragment.of(middle)
        if not whole.closed:
            return (Fragment(True, self.prefix, middle) if self.closed else whole), NO_TOKENS
        if self.closed:  # the middle starts after a common end: its first group is closed as well
            groups, whole = whole.prefix + groups, Fragment(True, self.prefix, whole.suffix)
        if other.closed:  # the middle ends at a common end
            whole = Fragment(True, whole.prefix, other.suffix)
        return whole, groups


_OPEN = [f"{part}_{name}" for part in ("prefix", "suffix") for name in ("a", "a_end", "b", "b_end")]
_FRAGMENT = "row long, no long, closed boolean, " + ", ".join(f"{c} array<bigint>" for c in _OPEN)
# closed groups leave with the end of their first group, as text, counts and summed pairs
_PART = ("row long, no long, fits boolean, at long, text binary, n_a long, n_b long, n_groups long, n_links long, pairs array<bigint>, "
         "times array<bigint>, closed boolean, " + ", ".join(f"{c} array<bigint>" for c in _OPEN))
_LIST = pa.list_(pa.int64())


def _part(row: int, no: int | None, fits: bool, tokens: Tokens, fragment: Fragment | None) -> pa.RecordBatch:
    """Closed groups, and the fragment that goes on in the reduction (none: ``no`` is null)."""
    groups = Groups(tokens)
    written = groups.text(np.array([len(groups.ends) - 1]))[0] if len(groups.ends) else b""
    _, pair, times = groups.links()
    _, pair, times = summed(np.zeros(len(pair), np.int64), pair, times)
    opened = [*fragment.prefix.arrays(), *fragment.suffix.arrays()] if fragment else [None] * 8
    counts = (groups.n_a.sum(), groups.n_b.sum(), len(groups.ends), (groups.n_a * groups.n_b).sum())
    return pa.RecordBatch.from_arrays(
        [pa.array([row]), pa.array([no], pa.int64()), pa.array([fits]), pa.array([int(groups.ends[0]) if len(groups.ends) else 0]),
         pa.array([written], pa.binary()), *(pa.array([int(c)]) for c in counts), pa.array([pair], _LIST), pa.array([times], _LIST),
         pa.array([bool(fragment and fragment.closed)]), *(pa.array([v], _LIST) for v in opened)],
        ["row", "no", "fits", "at", "text", "n_a", "n_b", "n_groups", "n_links", "pairs", "times", "closed", *_OPEN])


def cuts(raw: bytes, pattern: re.Pattern, chunk: int) -> list[int]:
    """Where the byte ranges of about ``chunk`` bytes begin; a range is empty where no cut is allowed."""
    out = [0]
    for nominal in range(chunk, len(raw), chunk):
        found = pattern.search(raw, max(nominal - 1, out[-1]))
        out.append(found.end() if found else len(raw))
    return out


def _ranges(left: str, right: str, chunk: int):
    """Byte ranges of long texts."""
    def run(batches):
        right_cut = _RIGHT_CUT if sides(left, right)[1].cuttable else re.compile(b"(?!)")
        part, row = partition_id(), 0
        for batch in parts(batches, 16):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                raw = b" " + text.encode()
                a, b = (cuts(raw, p, chunk) for p in (_LEFT_CUT, right_cut))
                for no, (i, j, k, m) in enumerate(zip(a, [*a[1:], len(raw)], b, [*b[1:], len(raw)], strict=True)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(part << 32) | row]), pa.array([doc_id], pa.int64()), pa.array([no]), pa.array([i]),
                         pa.array([raw[i:j].decode()]), pa.array([k]), pa.array([raw[k:m].decode()])],
                        ["row", "doc_id", "no", "a_at", "a_text", "b_at", "b_text"])
                row += 1
    return run


def _fragments(left: str, right: str):
    def run(batches):
        a, b = sides(left, right)
        for batch in parts(batches, 16):
            for row in batch.to_pylist():
                ids_a = a.ids([row["a_text"]])[0] if row["a_text"] else []
                ids_b = b.ids([row["b_text"][1:]])[0] if row["b_text"] else []
                fits = _joined(a, ids_a, row["a_text"].encode()) and _joined(b, ids_b, row["b_text"].encode())
                x, y = (np.array(v if fits else [], np.int64) for v in (ids_a, ids_b))
                fragment, closed = Fragment.of(Tokens(x, row["a_at"] + np.cumsum(a.sizes[x]), y, row["b_at"] + np.cumsum(b.sizes[y])))
                yield _part(row["row"], row["no"], fits, closed, fragment)
    return run


def _composed(key, rows):
    """Neighbouring fragments of a document as one."""
    rows = rows.sort_by("no").to_pylist()
    whole, out = None, []
    for row in rows:
        own = Fragment(row["closed"], *(Tokens(*(np.array(row[f"{p}_{n}"], np.int64) for n in ("a", "a_end", "b", "b_end"))) for p in ("prefix", "suffix")))
        if whole is None:
            whole = own
        else:
            whole, closed = whole + own
            out.append(_part(row["row"], None, True, closed, None))
    out.append(_part(rows[0]["row"], rows[0]["no"] // FAN, True, NO_TOKENS, whole))
    return pa.Table.from_batches(out)


def _finished(batches):
    """A document's last fragment: its prefix starts at the first byte and is a group."""
    for batch in batches:
        for row in batch.select(["row", *_OPEN[:4]]).to_pylist():
            yield _part(row["row"], None, True, Tokens(*(np.array(row[c], np.int64) for c in _OPEN[:4])), None)


def _hashed(batches):
    """Group texts sorted by document and place: one digest a document, whatever its length."""
    row, digest, first = None, None, True
    for batch in batches:
        for of, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if of != row:
                if row is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([digest.hexdigest()])], ["row", "sha"])
                row, digest, first = of, hashlib.sha256(), True
            digest.update(text[:-1] if first else b";" + text[:-1])
            first = False
    if row is not None:
        yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([digest.hexdigest()])], ["row", "sha"])


def _long(docs: DataFrame, left: str, right: str, chunk: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, parts, pairs) of long texts: ``row, doc_id``; closed groups; ``row, pair, times`` with each pair once."""
    ranges = stored(docs.mapInArrow(_ranges(left, right, chunk), "row long, doc_id long, no long, a_at long, a_text string, b_at long, b_text string"),
                    "byte-ranges")
    first = stored(ranges.repartition("row", "no").mapInArrow(_fragments(left, right), _PART), "fragments")
    bad = first.where("NOT fits").select("row").distinct()
    fitting = first.join(bad, "row", "left_anti")
    most = fitting.agg(F.max("no")).first()[0]
    pieces, level = fitting, fitting
    while most is not None and most > 0:
        level = stored(level.where("no IS NOT NULL").withColumn("of", F.floor(F.col("no") / FAN)).groupBy("row", "of")
                       .applyInArrow(_composed, _PART), "fragments")
        pieces = pieces.unionByName(level)
        most //= FAN
    closed = pieces.unionByName(level.where("no IS NOT NULL").mapInArrow(_finished, _PART)).where("n_groups > 0")
    each = closed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    pairs = each.groupBy("row", F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("times"))
    return ranges.where("no = 0").select("row", "doc_id"), closed, pairs


def align(docs: DataFrame, left: str = LEFT, right: str = RIGHT, long_bytes: int = LONG, chunk: int = CHUNK,
          block_bytes: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b`` (tokens of space + text by the left tokenizer, of the
    text by the right one, which adds the space), ``n_groups``, ``n_links`` (left-right pairs of
    tokens that share a group), ``n_best`` (links whose id pair has the highest count of its left
    id, ties included), ``count_sum`` (the counts of all links) and ``groups_sha256`` (of the groups
    as ``a1,a2|b1;a3|b2,b3``).  A pair's count: how many documents hold it linked.

    Texts that are null, empty, or do not come back from either tokenizer's tokens (changed white
    space, U+2581) have zeros and an empty digest and count for no pair.  Null and repeated doc_ids
    keep a row each and count as documents of their own; an empty table gives no rows; other columns
    are ignored.  Texts over ``long_bytes`` are aligned in byte ranges of about ``chunk`` bytes; a text
    without a place to cut is one range.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    big = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    blocks = stored(docs.where(~big).mapInArrow(_blocks(left, right, block_bytes), _BLOCK), "aligned-blocks")
    rows, closed, long_pairs = _long(docs.where(big), left, right, chunk)
    long_pairs = stored(long_pairs, "long-pairs")
    in_blocks = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("no", "p")).select("block", "no", "p.pairs", "p.docs")
    total = (in_blocks.select(F.col("pairs").alias("pair"), "docs").unionByName(long_pairs.select("pair", F.lit(1).alias("docs")))
             .groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", ID_BITS)))
    totals = stored(total, "pair-totals")
    scored = totals.join(totals.groupBy("a").agg(F.max("count").alias("best")), "a").select("pair", "count", "best")
    back = in_blocks.select(F.col("block").alias("of"), "no", F.col("pairs").alias("pair")).join(scored, "pair").select("of", "no", "count", "best")
    short = (blocks.drop("pairs", "docs").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_weighed, _RESULT))
    weights = (long_pairs.join(scored, "pair").groupBy("row")
               .agg(F.sum(F.when(F.col("count") == F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    counts = closed.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")))
    digests = (closed.select("row", "at", "text").repartition("row").sortWithinPartitions("row", "at").mapInArrow(_hashed, "row long, sha string"))
    whole = rows.join(counts, "row", "left").join(weights, "row", "left").join(digests, "row", "left")
    zero = F.lit(0).cast("long")
    return short.unionByName(whole.select("doc_id", *(F.coalesce(c, zero).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                                          F.coalesce("sha", F.lit("")).alias("groups_sha256")))
