"""The perfect binary Golay code (23, 12, 7) as a fuzzy hash of 23-bit words.

Every word lies within 3 bits of exactly one codeword. A word that lies 3 bits
away can step towards another codeword with one more error; those it would reach
are at 4 bits, and there are five of them. So the index of the nearest codeword,
with the five further ones where the distance is 3, is a set of keys of which any
two words at most one bit apart share one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
GENERATOR = 0xAE3  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


_BITS = np.array([_remainder(1 << b) for b in range(LENGTH)], dtype=np.int64)


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder modulo the generator; it is linear, so one bit at a time."""
    out = np.zeros(len(words), dtype=np.int64)
    for bit in range(LENGTH):
        out ^= np.where(words >> bit & 1, _BITS[bit], 0)
    return out


def _error_patterns() -> np.ndarray:
    """For each syndrome the error of up to 3 bits and, for 3, the five of 4 bits; -1: none."""
    table = np.full((1 << (LENGTH - DATA), KEYS), -1, dtype=np.int64)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            syndrome = int(np.bitwise_xor.reduce(_BITS[list(bits)])) if bits else 0
            table[syndrome, 0] = sum(1 << b for b in bits)
    used = np.ones(len(table), dtype=np.int64)
    for bits in combinations(range(LENGTH), 4):
        syndrome = int(np.bitwise_xor.reduce(_BITS[list(bits)]))
        table[syndrome, used[syndrome]] = sum(1 << b for b in bits)
        used[syndrome] += 1
    return table


_ERRORS = _error_patterns()


def codeword_keys(words: np.ndarray) -> np.ndarray:
    """Codeword indices of each word, ``KEYS`` columns; -1 where there are fewer."""
    words = np.asarray(words, dtype=np.int64)
    errors = _ERRORS[syndromes(words)]
    indices = (words[:, None] ^ errors) >> (LENGTH - DATA)
    return np.where(errors < 0, -1, indices)
