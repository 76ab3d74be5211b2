"""Elias-Fano sequences in memory-mapped files, with vectorised successor search."""

from __future__ import annotations

import numpy as np

from wayside.llm.common import save_array

STEP = 1 << 16
#: Place of the r-th zero bit (r from 0) of each byte.
_ZERO_AT = np.array([[next((i for i in range(8) if not b >> i & 1 and bin(~b & ((1 << i) - 1)).count("1") == r), 0) for r in range(8)] for b in range(256)], np.uint8)


def write_sequence(prefix: str, values: np.ndarray, universe: int) -> None:
    """Strictly or weakly increasing values below universe: low bits packed, high bits in unary."""
    n = len(values)
    low_bits = min(56, max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1))  # one 8-byte read covers 57 bits
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    bits = np.zeros(((int(high[-1]) if n else 0) + n + 2 + 63) // 64 * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))]).astype(np.uint64)
    packed = np.zeros((n * low_bits + 7) // 8 + 16, np.uint8)
    for lo in range(0, n, STEP):  # STEP is a multiple of 8, so every slice starts on a byte
        part = values[lo : lo + STEP]
        matrix = (part[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        piece = np.packbits(matrix.ravel(), bitorder="little")
        packed[lo * low_bits // 8 : lo * low_bits // 8 + len(piece)] = piece
    save_array(prefix + ".meta.npy", np.array([n, low_bits], np.int64))
    save_array(prefix + ".low.npy", packed)
    save_array(prefix + ".high.npy", words)
    save_array(prefix + ".zeros.npy", zeros)


class Sequence:
    """A written sequence, mapped into memory."""

    def __init__(self, prefix: str):
        self.n, self.low_bits = np.load(prefix + ".meta.npy").tolist()
        self.low, self.high, self.zeros = (np.load(f"{prefix}.{x}.npy", mmap_mode="r") for x in ("low", "high", "zeros"))
        self.high_bytes = self.high.view(np.uint8)

    def low_part(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        at = (bit >> 3)[:, None] + np.arange(8)
        word = np.ascontiguousarray(self.low[at]).view(np.uint64)[:, 0]
        return (word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def below(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part under each of these."""
        out = np.zeros(len(high), np.int64)
        want = high - 1  # the zero that ends the run of high - 1
        inside = (want >= 0) & (want < int(self.zeros[-1]))
        out[want >= int(self.zeros[-1])] = self.n
        k = want[inside]
        block = np.searchsorted(self.zeros, k.astype(np.uint64), "right") - 1
        rest = (k - self.zeros[block].astype(np.int64)).astype(np.uint8)
        octets = np.ascontiguousarray(self.high[block]).view(np.uint8).reshape(-1, 8)
        upto = np.cumsum(np.bitwise_count(~octets), axis=1, dtype=np.uint8)
        which = (upto <= rest[:, None]).sum(1)
        row = np.arange(len(k))
        inner = rest - np.where(which > 0, upto[row, which - 1], 0)
        place = which * 8 + _ZERO_AT[octets[row, which], inner]
        out[inside] = block * 64 + place - k
        return np.minimum(out, self.n)

    def run_end(self, start: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the run of values with this high part, which starts here, ends."""
        bit = start + high
        at = (bit >> 3)[:, None] + np.arange(8)
        octets = self.high_bytes
        word = np.ascontiguousarray(octets[np.minimum(at, len(octets) - 1)]).view(np.uint64)[:, 0] >> (bit & 7).astype(np.uint64)
        ones = np.bitwise_count(word & ~(word + np.uint64(1))).astype(np.int64)
        end = np.minimum(start + ones, self.n)
        long = np.flatnonzero(ones >= 56)
        end[long] = self.below(high[long] + 1)
        return end

    def successor(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value at or above each, within [lo, hi) where given, and whether it is equal."""
        position, equal = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        for at in range(0, len(values), STEP):
            s = slice(at, at + STEP)
            v = values[s].astype(np.uint64)
            high = (v >> np.uint64(self.low_bits)).astype(np.int64)
            want = v & np.uint64((1 << self.low_bits) - 1)
            a = self.below(high)
            b = self.run_end(a, high)
            if lo is not None:
                a, b = np.maximum(a, lo[s]), np.maximum(np.maximum(a, lo[s]), np.minimum(b, hi[s]))
            end = b.copy()
            while (open_ := np.flatnonzero(a < b)).size:
                mid = (a[open_] + b[open_]) >> 1
                less = self.low_part(mid) < want[open_]
                a[open_[less]] = mid[less] + 1
                b[open_[~less]] = mid[~less]
            position[s] = a
            hit = np.flatnonzero(a < end)
            equal[s.start + hit] = self.low_part(a[hit]) == want[hit]
        return position, equal
