"""The perfect binary Golay code (23, 12, 7) as a fuzzy hash of 23-bit words.

Every word lies within three bits of exactly one of the 4096 codewords.  The keys of a word are the codewords nearest to
the word and to its 23 neighbours: one key, or six.  Two words that differ in two bits at most have a neighbour (or
themselves) in common, hence also a key.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
BITS, CHECKS = 23, 11


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of division by the generator."""
    left = words.astype(np.uint32)
    for bit in range(BITS - 1, CHECKS - 1, -1):
        left ^= np.where(left >> np.uint32(bit) & np.uint32(1), np.uint32(GENERATOR << (bit - CHECKS)), np.uint32(0))
    return left


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """The error of at most three bits for each of the 2048 syndromes."""
    patterns = np.array([sum(1 << b for b in c) for k in range(4) for c in combinations(range(BITS), k)], np.uint32)
    table = np.zeros(1 << CHECKS, np.uint32)
    table[syndromes(patterns)] = patterns
    return table


@lru_cache(maxsize=1)
def _unit_syndromes() -> np.ndarray:
    return syndromes(np.array([1 << b for b in range(BITS)], np.uint32))


def decode(words: np.ndarray) -> np.ndarray:
    """Index (the 12 message bits) of the nearest codeword."""
    return (words ^ _errors()[syndromes(words)]) >> CHECKS


def keys(words: np.ndarray) -> np.ndarray:
    """n x 24 codeword indices of the words and their neighbours, sorted; a word has one or six different ones."""
    words = words.astype(np.uint32)
    flips = np.array([0, *(1 << b for b in range(BITS))], np.uint32)
    syn = syndromes(words)[:, None] ^ np.concatenate([[np.uint32(0)], _unit_syndromes()])[None, :]
    near = (words[:, None] ^ flips[None, :] ^ _errors()[syn]) >> np.uint32(CHECKS)
    return np.sort(near, axis=1)


def distinct_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs without repetition."""
    k = keys(words)
    new = np.ones(k.shape, bool)
    new[:, 1:] = k[:, 1:] != k[:, :-1]
    rows, _ = np.nonzero(new)
    return rows, k[new]
