"""The binary Golay code (23, 12): nearest codewords of short bit strings.

The code is perfect: each of the 2**23 strings lies within three bits of exactly one codeword.
Two strings at most two bits apart share a string at most one bit from either, and so share the
codeword nearest to it. The codewords nearest to a string and to its one-bit neighbours, one or six
of them, are therefore keys that tolerate two wrong bits.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0xC75
BITS = 23
CHECK_BITS = 11


def _syndrome(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 bits and of the high 11 bits, and the error each syndrome means."""
    single = [_syndrome(1 << b) for b in range(BITS)]

    def spanned(bits: range) -> np.ndarray:
        out = np.zeros(1 << len(bits), dtype=np.uint32)
        for k, b in enumerate(bits):
            out[1 << k : 2 << k] = out[: 1 << k] ^ np.uint32(single[b])
        return out

    errors = np.zeros(1 << CHECK_BITS, dtype=np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            s = 0
            for b in bits:
                s ^= single[b]
            errors[s] = sum(1 << b for b in bits)
    return spanned(range(12)), spanned(range(12, BITS)), errors


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    low, high, errors = tables()
    words = words.astype(np.uint32)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[syndrome]) >> CHECK_BITS


def nearby(words: np.ndarray, width: int) -> np.ndarray:
    """Codeword indices of each word and of its neighbours one bit off in the low ``width`` bits.

    One row per word and ``width + 1`` columns, sorted; repeats in a row are -1.
    """
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    found = nearest(words.astype(np.uint32)[:, None] ^ flips).astype(np.int64)
    found.sort(axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
