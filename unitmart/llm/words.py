"""Words of whole Arrow text columns as numpy arrays, without a Python loop.

A word is a run of bytes whose class is not "break". The 64-bit hash of a
word is a polynomial over (mapped) bytes, read off a running sum, then mixed;
it depends on the word alone, never on its place.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .common import text_bytes

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_RNG = np.random.default_rng(20240607)
# one fixed odd number per byte value
BYTE_CODE = (_RNG.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# white space of the word contracts: space and \t \n \v \f \r
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# for letter tokens: ASCII non-letters break, A-Z are mapped to a-z
NON_LETTER = np.zeros(256, bool)
NON_LETTER[:128] = True
NON_LETTER[[*range(65, 91), *range(97, 123)]] = False
LOWER = np.arange(256)
LOWER[65:91] += 32


class Words(NamedTuple):
    raw: np.ndarray      # bytes of all rows
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # byte after it
    bounds: np.ndarray   # first word of each row, and the total
    hash: np.ndarray     # uint64 of each word

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, p in enumerate((_P, _PINV)):
            full = np.full(n, p, np.uint64)
            full[0] = 1
            _powers[i] = np.cumprod(full, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums of per-byte codes; ``span_hash`` reads spans."""
    up, _ = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:len(codes)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def split_words(arr: pa.Array, breaks: np.ndarray = WHITE, code: np.ndarray = BYTE_CODE) -> Words:
    raw, offsets = text_bytes(arr)
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return Words(raw, z, z, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = ~breaks[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(start, offsets)
    return Words(raw, start, end, bounds, span_hash(prefix_sums(code[raw]), start, end))


def gram_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, by its first word (length n-k+1; runs
    over row borders are included and have to be masked by the caller)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(word_hash)
    at = np.arange(n)
    return span_hash(sums, at, at + k)


def run_starts(bounds: np.ndarray, n: int, k: int) -> np.ndarray:
    """Whether ``k`` consecutive words of one row start at each of n-k+1 places."""
    m = max(n - k + 1, 0)
    ok = np.zeros(m + 1, np.int64)
    first, last = bounds[:-1], bounds[1:] - k + 1
    good = last > first
    np.add.at(ok, first[good], 1)
    np.add.at(ok, last[good], -1)
    return np.cumsum(ok[:m]) > 0
