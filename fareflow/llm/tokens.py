"""Token ids of whole texts, as the tokenizers library gives them, at dictionary speed.

Both public vocabularies cut a text into pre-tokens before any merge, and the merges of a
pre-token do not depend on its neighbours.  A worker therefore keeps the ids of the words and
pre-tokens it has met and looks repeats up.  The cut is done here only where it provably equals
the library's (see ``TextIds.ids``); every other text or word goes through the library itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import regex

from fareflow.llm.common import tokenizer_file
from fareflow.llm.words import Units, batches_of, units

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The white space and the two cut patterns of the public vocabularies.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BYTE_LEVEL_CUT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                  rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# The second pattern on one word of characters below PLAIN_BELOW, with Python's classes (whose
# letters include these six number characters).
PLAIN_WORD_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[\d\xb2\xb3\xb9\xbc-\xbe]|[\W_]+"
WORD = rf"[^{SPACE}]+"
# Texts with one of these may hold pre-tokens other than words.units: an apostrophe, characters
# from U+0080 to U+00BF or from U+0240 on, the two signs among the letters of U+00C0 to
# U+00FF, the dotted capital I (two characters in lower case), a special string, a control character that Python takes for white space.
_ODD = np.zeros(256, np.uint8)
_ODD[[0x27, *range(0x1C, 0x20), 0xC2, *range(0xC9, 0x100)]] = 1
_ODD[[0x97, 0xB7, 0xB0, ord("|")]] = 2  # odd after these bytes only
_ODD = _ODD.tobytes()
_AFTER = np.zeros(256, np.uint8)
_AFTER[[0x97, 0xB7, 0xB0, ord("|")]] = 0xC3, 0xC3, 0xC4, ord("<")


def odd_texts(cut: Units) -> np.ndarray:
    """Whether each text of the batch holds something odd."""
    buffer = np.frombuffer(cut.bytes, np.uint8)
    kind = np.frombuffer(cut.bytes.translate(_ODD), np.uint8)
    if not kind.any():
        return np.zeros(len(cut.text_end), bool)
    at = np.flatnonzero(kind)
    at = at[(kind[at] == 1) | (buffer[at - 1] == _AFTER[buffer[at]])]
    odd = np.zeros(len(cut.text_end), bool)
    odd[np.searchsorted(cut.text_end, at, "right")] = True
    return odd


# Python's str.split() also splits at these four, which the tokenizers treat as text.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
# Below this character nothing is changed by NFC, and lower case is the same everywhere.
PLAIN_BELOW = "\u0250"

# The byte-level alphabet: a printable byte is itself, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


def byte_level(piece: str) -> str:
    if piece.isascii() and piece.isprintable() and " " not in piece:
        return piece
    return piece.encode().decode("latin-1").translate(BYTE_LEVEL)


@lru_cache(maxsize=4)
def load(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name))


@lru_cache(maxsize=4)
def cut_kind(name: str) -> str:
    """'byte_level' or 'word_end' where this module knows the cut, else 'other'."""
    spec = json.loads(load(name).to_str())
    pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
    plain = spec["truncation"] is None and spec["padding"] is None and not any(
        t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or "<|" not in t["content"]
        for t in spec["added_tokens"])
    if not plain:
        return "other"
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not norm:
        return "byte_level"
    steps = [(n["type"], n.get("pattern"), n.get("content")) for n in norm.get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    if (steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"] and not cuts[1]["use_regex"]
            and cuts[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}):
        return "word_end"
    return "other"


class Bounded(dict):
    """A look-up table that starts anew when it is full, so that a worker's memory is bounded."""

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _id_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class UnitTable:
    """Ids of short units (``LONGEST`` bytes, ``MOST`` ids), looked up for many units at once.

    A unit's hash names its one slot, which keeps the unit stored last: memory is fixed, 42 bytes a slot.  The
    slot's size and bytes tell whether it holds the unit asked for."""

    LONGEST, MOST = 16, 6

    def __init__(self, bits: int = 20):
        self.shift = np.uint64(64 - bits)
        self.size, self.n = np.zeros(1 << bits, np.uint8), np.zeros(1 << bits, np.uint8)
        self.head = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.ids = np.zeros((self.MOST, 1 << bits), "<u4")

    def find(self, cut: Units, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of the units, and whether they hold them."""
        slot = (cut.hash[of] >> self.shift).astype(np.int64)
        held = self.size[slot] == cut.size[of]
        for own, asked in zip(self.head, cut.head, strict=True):
            held &= own[slot] == asked[of]
        return slot, held

    def put(self, cut: Units, of: np.ndarray, slot: np.ndarray, ids: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        """Store the units that are short enough; the ids of each are ``n`` of ``ids`` from ``first`` on."""
        fit = np.flatnonzero((cut.size[of] <= self.LONGEST) & (n > 0) & (n <= self.MOST))
        fit = fit[np.unique(slot[fit], return_index=True)[1]]  # one unit a slot
        of, slot, first, n = of[fit], slot[fit], first[fit], n[fit]
        self.size[slot], self.n[slot] = cut.size[of], n
        for own, given in zip(self.head, cut.head, strict=True):
            own[slot] = given[of]
        for k in range(self.MOST):
            own = n > k
            self.ids[k, slot[own]] = ids[first[own] + k]

    def write(self, slot: np.ndarray, out: np.ndarray, at: np.ndarray) -> None:
        """Write the ids in the slots to ``out``, from the places ``at`` on."""
        for k in range(self.MOST):
            if k:
                more = self.n[slot] > k
                slot, at = slot[more], at[more]
            out[at + k] = self.ids[k, slot]


class TextIds:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, name: str, limit: int = 250_000):
        self.tokenizer = load(name)
        self.kind = cut_kind(name)
        self.pieces = Bounded(self._piece, limit)
        self.words = Bounded(self._word, limit)
        self.table = UnitTable()
        self.units: dict[bytes, bytes] = {}  # what the table does not hold
        self.units_limit = 250_000
        self._cut = re.compile(PLAIN_WORD_CUT)
        self._split = regex.compile(WORD)

    def _library(self, text: str) -> bytes:
        return _id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        return _id_bytes([t.id for t in self.tokenizer.model.tokenize(byte_level(piece))])

    def _word(self, word: str) -> bytes:
        if "<|" in word or "\x85" in word or "\xa0" in word or max(word) >= PLAIN_BELOW:
            return self._library(word)
        word = word.lower()
        return self.pieces[word] if word.isalpha() else b"".join([self.pieces[p] for p in self._cut.findall(word)])

    def split(self, text: str) -> list[str]:
        return self._split.findall(text) if any(c in text for c in NOT_SPACE) else text.split()

    def ids(self, text: str) -> bytes:
        """With the word-end cut white space is dropped and no pre-token spans it, so the words'
        ids follow one another; any other tokenizer encodes the whole text."""
        if self.kind != "word_end":
            return self._library(text)
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def all_ids(self, texts: list[str], seen=None, most_bytes: int = 4 << 20) -> list[np.ndarray]:
        """``ids`` of many texts, as arrays of unsigned 32-bit integers, cut in batches of ``most_bytes``.

        With the word-end cut, a text that is not ``odd_texts`` is cut into exactly
        the units of ``words.units``; the ids of a unit that the table does not hold are looked up once per batch.  ``seen``
        is called with (first text, units) of every batch.
        """
        out: list[np.ndarray] = []
        for first, last, raw in batches_of(texts, most_bytes):
            if self.kind == "word_end" or seen:
                cut = units(raw)
                if seen:
                    seen(first, cut)
            if self.kind == "word_end":
                odd = odd_texts(cut)
                out += self._unit_ids(cut, odd)
            else:
                odd = np.ones(len(raw), bool)
                out += [None] * len(raw)
            for i in np.flatnonzero(odd):
                out[first + i] = np.frombuffer(self.ids(texts[first + i]), "<u4")
        return out

    def _unit_ids(self, cut: Units, odd: np.ndarray) -> list[np.ndarray]:
        plain = np.flatnonzero(np.repeat(~odd, np.diff(cut.first_of)))
        slot, held = self.table.find(cut, plain)
        lost = np.flatnonzero(~held)
        new = plain[lost]
        codes, distinct = pd.factorize(cut.hash[new])
        place = np.empty(len(distinct), np.int64)
        place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # first place of each
        if not cut.same(new, new[place][codes]):  # two units with one hash
            odd[:] = True
            return [None] * len(odd)
        found = self._looked_up([cut.bytes[a:a + n] for a, n in zip(cut.start[new[place]].tolist(), cut.size[new[place]].tolist(), strict=True)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, offsets = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        size = self.table.n[slot].astype(np.int64)
        size[lost] = more = sizes[codes]
        ends = np.cumsum(size)
        ids = np.empty(int(size.sum()), "<u4")
        self.table.write(slot[held], ids, (ends - size)[held])
        step = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
        ids[np.repeat((ends - size)[lost], more) + step] = flat[np.repeat(offsets[codes], more) + step]
        self.table.put(cut, new[place], slot[lost][place], flat, offsets, sizes)  # after the slots were read
        of_text = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(cut.first_of)))])  # in plain units
        bounds = np.concatenate([[0], ends])[of_text]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _looked_up(self, units: list[bytes]) -> list[bytes]:
        known, tokenize = self.units, self.tokenizer.model.tokenize
        found = list(map(known.get, units))
        if len(known) > self.units_limit:
            known.clear()
        for i, ids in enumerate(found):
            if ids is None:
                unit = units[i]
                text = unit.decode() if unit.isalpha() else byte_level(unit.decode().lower())  # ASCII is in lower case
                found[i] = ids = array("I", [t.id for t in tokenize(text)]).tobytes()
                if len(unit) > self.table.LONGEST or len(ids) > 4 * self.table.MOST:
                    known[unit] = ids
        return found


@lru_cache(maxsize=2)
def text_ids(name: str) -> TextIds:
    """One per worker process, kept between tasks."""
    return TextIds(name)


class PreTokens:
    """The pre-tokens of a text, each standing for itself, and the number of pieces of one.

    A special string inside a text is a piece of its own (the library's default); it is
    returned as a pre-token like any other and counts one.
    """

    def __init__(self, name: str):
        self.tokenizer = load(name)
        self.kind = cut_kind(name)
        self.specials = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self._cut = regex.compile(BYTE_LEVEL_CUT)
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")"
                                      if self.specials else "(?!)")

    def cut(self, text: str) -> list[str]:
        if self.kind == "byte_level":
            if "<|" not in text:
                return self._cut.findall(text)
            out: list[str] = []
            for part in self._special.split(text):
                out += [part] if part in self.specials else self._cut.findall(part)
            return out
        return [text] if text else []

    def count(self, piece: str) -> int:
        if self.kind == "byte_level" and piece not in self.specials:
            return len(self.tokenizer.model.tokenize(byte_level(piece)))
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def pre_tokens(name: str) -> PreTokens:
    return PreTokens(name)
