"""A compressed FM-index over number sequences, searched in batches.

The sequences are joined with a separator each and their suffixes are sorted
by prefix doubling. The Burrows-Wheeler transform is kept as a wavelet tree in
levels: one bit a symbol and level, packed into 64-bit words with a running
count for each, so a rank is a lookup and a population count. Backward search
takes a batch of patterns one symbol to the left at a time.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]]).astype(np.int32)
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class WaveletTree:
    """Ranks of symbols below ``2**levels``, highest bit first; at each level
    the symbols with a zero bit move before those with a one."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            b = Bits(bit.astype(np.uint8))
            self.bits.append(b)
            self.zeros.append(len(symbols) - b.ones)
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def ranks(self, symbol: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How often each symbol is before its place, given ``first``: where
        the symbol's occurrences begin at the bottom of the tree."""
        for level, (b, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            r = b.rank(at)
            at = np.where(one, zeros + r, at - r)
        return at - first


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first ``depth`` symbols at least (a power of two)."""
    rank, have, n = text.astype(np.int64), 1, len(text)
    order = np.argsort(rank, kind="stable")
    while have < depth:
        after = np.zeros(n, np.int64)
        after[:max(n - have, 0)] = rank[have:] + 1
        both = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(both, kind="stable")
        s = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
        if rank[order[-1]] == n - 1:
            break
        have *= 2
    return order


class FMIndex:
    """Over sequences given as one array of values and their lengths."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray, depth: int):
        alphabet, coded = np.unique(values, return_inverse=True)
        ends = np.cumsum(lengths)
        # 0 separates sequences
        self.text = np.insert(coded.astype(np.int64) + 1, ends, 0)
        self.start = np.concatenate([[0], ends[:-1]]) + np.arange(len(lengths))
        size = 1
        while size < depth:
            size *= 2
        self.suffixes = sort_suffixes(self.text, size)
        last = self.text[self.suffixes - 1]
        symbols = len(alphabet) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=symbols))])
        self.tree = WaveletTree(last, max(int(symbols - 1).bit_length(), 1))
        every = np.arange(symbols)
        self.bottom = self.tree.ranks(every, np.zeros(symbols, np.int64), np.zeros(symbols, np.int64))

    def search(self, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the patterns ``text[b:b+length]``, by backward
        search from their last symbols."""
        c = self.text[begin + length - 1]
        low, high = self.first[c], self.first[c + 1]
        n = len(begin)
        for k in range(length - 2, -1, -1):
            c = self.text[begin + k]
            both = self.tree.ranks(np.concatenate([c, c]), np.concatenate([low, high]),
                                   np.concatenate([self.bottom[c]] * 2))
            low, high = self.first[c] + both[:n], self.first[c] + both[n:]
        return low, high
