"""Words of many texts at once, as numpy arrays.

The texts are joined to one byte buffer.  A unit is a run of letters, a run of marks, or one
digit; white space parts units and belongs to none.  A unit's bytes (ASCII letters in lower case)
are read as 8-byte integers, which give it a 64-bit hash and an exact comparison with another.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

SPACE, LETTER, DIGIT, MARK = range(4)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CLASS = bytes(SPACE if c in (9, 10, 11, 12, 13, 32) else LETTER if c >= 128 or chr(c).isalpha() else DIGIT if 48 <= c <= 57 else MARK
              for c in range(256))
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
LONG = 128  # bytes from which a unit is hashed as a whole


@dataclass
class Units:
    bytes: bytes  # the buffer, ASCII letters in lower case
    start: np.ndarray
    size: np.ndarray
    kind: np.ndarray  # LETTER, DIGIT or MARK
    hash: np.ndarray
    head: tuple[np.ndarray, np.ndarray]  # bytes 0 to 7 and 8 to 15 of units shorter than LONG
    first_of: np.ndarray  # of each text the first unit; one more for the end
    text_end: np.ndarray  # in the buffer

    def same(self, of: np.ndarray, other: np.ndarray) -> bool:
        """Whether units ``of`` have the bytes of units ``other``, pairwise."""
        if (self.size[of] != self.size[other]).any():
            return False
        if any((eight[of] != eight[other]).any() for eight in self.head):
            return False
        more = np.flatnonzero(self.size[of] > 16)
        left, right = of[more], other[more]
        for _, a, b in zip(*_eights(self.bytes, self.start[left], self.size[left], self.start[right])):
            if (a != b).any():
                return False
        far = np.flatnonzero(self.size[of] >= LONG)
        return all(self.unit(of[i]) == self.unit(other[i]) for i in far)

    def unit(self, i: int) -> bytes:
        return self.bytes[self.start[i]:self.start[i] + self.size[i]]


def _eights(buffer: bytes, start: np.ndarray, size: np.ndarray, *others: np.ndarray):
    """Per 8 bytes of units shorter than LONG: which units reach them, and these bytes as integers."""
    windows = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    of, values = [], [[] for _ in range(1 + len(others))]
    at = np.flatnonzero(size < LONG)
    for offset in range(0, LONG, 8):
        at = at[size[at] > offset] if offset else at
        if not len(at):
            break
        mask = _MASK[np.minimum(size[at] - offset, 8)]
        of.append(at)
        for out, begin in zip(values, (start, *others), strict=True):
            out.append(windows[begin[at] + offset] & mask)
    return of, *values


def _hashes(buffer: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    out, head = size.astype(np.uint64), (np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64))
    for number, (at, eight) in enumerate(zip(*_eights(buffer, start, size))):
        if number < 2:
            head[number][at] = eight
        h = (out[at] ^ eight) * _MULTIPLY
        out[at] = h ^ (h >> np.uint64(29))
    for i in np.flatnonzero(size >= LONG):
        out[i] = xxhash.xxh64_intdigest(buffer[start[i]:start[i] + size[i]])
    return out * _MULTIPLY, head


def units(raw: list[bytes]) -> Units:
    """Units of the texts, given as UTF-8."""
    buffer = (b"\n".join(raw) + b"\n").translate(LOWER)
    kind = np.frombuffer(buffer.translate(CLASS), np.uint8)
    change = np.ones(len(buffer), bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= kind == DIGIT
    start = np.flatnonzero(change)
    size = np.diff(start, append=len(buffer))
    kind = kind[start]
    own = kind != SPACE
    start, size, kind = start[own], size[own], kind[own]
    text_end = np.cumsum([len(r) + 1 for r in raw])
    buffer += bytes(8)
    return Units(buffer, start, size, kind, *_hashes(buffer, start, size), np.concatenate([[0], np.searchsorted(start, text_end)]), text_end)


def batches_of(texts: list[str], most_bytes: int = 4 << 20):
    """(first, last, UTF-8 texts) of runs of at most ``most_bytes``, or one longer text."""
    at, part, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode()
        if part and size + len(raw) >= most_bytes:
            yield at, i, part
            at, part, size = i, [], 0
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield at, len(texts), part
