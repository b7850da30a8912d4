"""Elias-Fano encoding of a non-decreasing integer sequence, with a sampled select structure.

Each value keeps its ``low`` lowest bits in a packed array; the rest is written in unary in a bit vector
(value i sets bit (value >> low) + i). ``select`` finds the i-th one from the place of every 256th one (32 bits each)
and popcounts from there, so a single value is read without decoding the sequence and without 64-bit tables.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = struct.Struct("<QBQQ")  # values, low bits, bytes of the low array, words of the high vector


class EliasFano:
    def __init__(self, n: int, low: int, lows: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low, self.lows, self.high, self.samples = n, low, lows, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values``: non-negative, non-decreasing."""
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low, dtype=np.uint64)
        lows = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, dtype=np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        return cls(n, low, lows, high, ones[::STEP].astype("<u4"))

    def select(self, i: int) -> int:
        """Value number ``i``."""
        word, within = divmod(int(self.samples[i // STEP]), 64)
        bits = int(self.high[word]) >> within << within  # from the sampled one on
        need = i % STEP
        while need >= bits.bit_count():
            need -= bits.bit_count()
            word += 1
            bits = int(self.high[word])
        for _ in range(need):
            bits &= bits - 1
        place = word * 64 + (bits & -bits).bit_length() - 1
        low = 0
        for k in range(i * self.low, (i + 1) * self.low):
            low |= (int(self.lows[k // 8]) >> k % 8 & 1) << k - i * self.low
        return place - i << self.low | low

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.int64) << self.low
        if self.low:
            bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))
        return out

    def to_bytes(self) -> bytes:
        return b"".join([_HEAD.pack(self.n, self.low, len(self.lows), len(self.high)), self.lows.tobytes(),
                         self.high.tobytes(), self.samples.tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, low, n_low, n_high = _HEAD.unpack_from(raw)
        at = _HEAD.size
        lows = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, "<u8", n_high, at + n_low)
        return cls(n, low, lows, high, np.frombuffer(raw, "<u4", -(-n // STEP), at + n_low + 8 * n_high))
