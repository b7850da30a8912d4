"""FM-index over integer word sequences, in numpy: wavelet-matrix ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 32  # every SAMPLE-th position of a run keeps its suffix position


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the first round already compares as many symbols as fit 63 bits."""
    n = len(s)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(s.max() + 1).bit_length())
    k = max(1, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(k):
        key <<= bits
        key[:n - j] |= s[j:] + 1 if j < n else 0
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while rank.max() < n - 1:
        follow = np.zeros(n, dtype=np.int64)
        if k < n:
            follow[:n - k] = rank[k:] + 1
        rank = np.unique(rank * (n + 1) + follow, return_inverse=True)[1].astype(np.int64)
        k *= 2
    sa = np.empty(n, dtype=np.int64)
    sa[rank] = np.arange(n)
    return sa


class BitRank:
    """Bit vector with constant-time rank: 64-bit words and the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        pad = -len(bits) % 64 + 64
        self.words = np.packbits(np.concatenate([bits.astype(np.uint8), np.zeros(pad, np.uint8)]),
                                 bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """Wavelet matrix over a sequence of symbols below ``sigma``."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (s >> shift) & 1 == 1
            zeros = len(s) - int(bits.sum())
            self.levels.append((shift, BitRank(bits), zeros))
            s = np.concatenate([s[~bits], s[bits]])
        self.base = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((c >> shift) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs among the first ``i`` symbols."""
        return self._down(c, i) - self.base[c]

    def get(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            c |= one.astype(np.int64) << shift
            i = np.where(one, zeros + ones, i - ones)
        return c


class FMIndex:
    """Index over runs of symbols 1..sigma-1. A run ends with a separator of its own, so suffixes compare
    within their run; separators are symbol 0 of the transform, and no pattern holds one."""

    def __init__(self, runs: list[np.ndarray], sigma: int):
        r = len(runs)
        lengths = np.array([len(x) for x in runs], dtype=np.int64)
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        n = int(lengths.sum()) + r
        ends = self.starts + lengths
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = np.concatenate(runs)
        ordered = text + (r - 1)  # word symbols come after the r separators
        ordered[ends] = np.arange(r)
        sa = suffix_array(ordered)
        self.wavelet = Wavelet(text[sa - 1] if n else text, sigma)  # the symbol before position 0 is a separator
        counts = np.bincount(text, minlength=sigma)
        self.less = np.cumsum(counts) - counts
        self.size = n
        marked = np.zeros(n, dtype=bool)
        offset = np.arange(n) - np.repeat(self.starts, lengths + 1)
        marked[offset % SAMPLE == 0] = True
        marked = marked[sa]
        self.marked, self.samples = BitRank(marked), sa[marked]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, right-aligned): ids of those that occur, and their row ranges."""
        ids = np.flatnonzero(lengths > 0)
        low, high = np.zeros(len(ids), dtype=np.int64), np.full(len(ids), self.size, dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width = patterns.shape[1]
        for step in range(width + 1):
            over = lengths[ids] <= step
            done.append((ids[over], low[over], high[over]))
            ids, low, high = ids[~over], low[~over], high[~over]
            if not len(ids):
                break
            c = patterns[ids, width - 1 - step]
            low, high = self.less[c] + self.wavelet.rank(c, low), self.less[c] + self.wavelet.rank(c, high)
            found = low < high
            ids, low, high = ids[found], low[found], high[found]
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))  # type: ignore[return-value]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: walk back until a sampled position (run starts are sampled)."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.marked.get(at)
            out[todo[hit]] = self.samples[self.marked.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            c = self.wavelet.get(at)
            at = self.less[c] + self.wavelet.rank(c, at)
            steps += 1
        return out

    def occurrences(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, run, offset in run) of every occurrence of every pattern."""
        ids, low, high = self.ranges(patterns, lengths)
        counts = high - low
        rows = np.repeat(low, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.locate(rows)
        run = np.searchsorted(self.starts, at, side="right") - 1
        return np.repeat(ids, counts), run, at - self.starts[run]
