"""Elias-Fano sequences: sorted numbers in about 2 + log2(range / count) bits each, with selection.

The low bits are packed as they are; the high parts are a bit vector with a one for each number,
placed at (high part + index). Every ``SAMPLE``-th one's position is kept, so a number is found by
looking at a short stretch of the vector.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<qqqqq")


def encode(values: np.ndarray) -> bytes:
    """``values``: sorted int64; the smallest is kept apart, so negative numbers are fine."""
    n = len(values)
    base = int(values[0]) if n else 0
    v = values.astype(np.uint64) - np.uint64(base & (2**64 - 1))
    top = int(v[-1]) if n else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    low = v & np.uint64((1 << low_bits) - 1)
    packed = b"".join(
        np.packbits(((part[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        for part in np.split(low, range(8192, n, 8192))
    )
    ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros((int(ones[-1]) + 8) // 8 * 8 if n else 0, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    samples = ones[::SAMPLE].astype("<u4" if len(bits) < 2**32 else "<u8")
    return _HEAD.pack(n, base, low_bits, len(high), samples.itemsize) + packed + high + samples.tobytes()


class EliasFano:
    """Reads an encoded sequence; ``select`` works on the packed form."""

    def __init__(self, data: bytes):
        self.n, self.base, self.low_bits, high_bytes, width = _HEAD.unpack_from(data)
        at = _HEAD.size
        low_bytes = (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(data, np.uint8, low_bytes, at)
        self.high = np.frombuffer(data, np.uint8, high_bytes, at + low_bytes)
        self.samples = np.frombuffer(data, f"<u{width}", -(-self.n // SAMPLE), at + low_bytes + high_bytes)

    def __len__(self) -> int:
        return self.n

    def select(self, first: int, last: int | None = None) -> np.ndarray:
        """The numbers at places first to last - 1 (one number if ``last`` is left out)."""
        last = first + 1 if last is None else last
        if last <= first:
            return np.zeros(0, np.int64)
        block = first // SAMPLE
        start = int(self.samples[block]) // 8
        end = -(-last // SAMPLE)
        stop = int(self.samples[end]) // 8 + 1 if end < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        ones = ones[ones >= int(self.samples[block])]
        places = np.arange(first, last)
        high = ones[places - block * SAMPLE] - places
        bit = places[:, None] * self.low_bits + np.arange(self.low_bits)
        low = ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64)
        low = (low << np.arange(self.low_bits)).sum(axis=1) if self.low_bits else np.zeros(len(places), np.int64)
        return ((high << self.low_bits) | low) + self.base
