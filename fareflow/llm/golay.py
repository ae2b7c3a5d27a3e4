"""The binary Golay code (23, 12): every 23-bit word lies within 3 bits of exactly one codeword."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a fixed value of the code


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each word modulo the generator polynomial."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(bit) & np.uint32(1), rest ^ np.uint32(GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """The one pattern of at most 3 bits for each of the 2,048 syndromes."""
    patterns = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)]
    table = np.zeros(1 << 11, np.uint32)
    table[syndrome(np.array(patterns))] = patterns
    return table


def nearest(words: np.ndarray) -> np.ndarray:
    """12-bit index of the nearest codeword of each 23-bit word."""
    words = words.astype(np.uint32)
    return (words ^ _errors()[syndrome(words)]) >> np.uint32(11)


def nearby(words: np.ndarray, bits: int) -> np.ndarray:
    """Per word, the codeword indices of itself and of its ``bits`` one-bit neighbours, shape (n, 6).

    The word's own comes first; where there are fewer than six, it fills the rest.  There are never
    more: only a word 3 bits from its codeword has neighbours with other codewords, these
    lie 4 bits from it, and each takes four of the 20 other bits.
    """
    flips = np.array([0, *(1 << b for b in range(bits))], np.uint32)
    near = nearest(words.astype(np.uint32)[:, None] ^ flips)
    own = near[:, :1].copy()
    near.sort(axis=1)
    new = near != own
    new[:, 1:] &= near[:, 1:] != near[:, :-1]
    out = np.repeat(own, 6, axis=1)
    row, column = np.nonzero(new)
    out[row, np.cumsum(new, axis=1)[row, column]] = near[row, column]
    return out
