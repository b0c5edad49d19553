"""Text columns as flat numpy arrays, a few megabytes at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: nothing to trim
    _libc = None

SLICE_BYTES = 1 << 20


def texts_of(column: pa.Array) -> pa.LargeStringArray:
    """The column as large strings without nulls (null is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def flat(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes, n + 1 offsets from 0)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(texts: pa.LargeStringArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """(first row, rows) with about ``most`` bytes each; a longer text is a slice of its own."""
    _, at = flat(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield first, texts.slice(first, last - first)
        first = last
    release()


BLOCK_BYTES = 4 << 20


def blocks(texts: pa.LargeStringArray, border: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets of the texts in them, number of the first text), about ``most`` bytes at a time.

    Cuts lie between texts or, in a longer text, behind a byte for which ``border`` (a table of 256) is set.
    """
    data, at = flat(texts)
    begin = 0
    while begin < len(data):
        end = len(data)
        if end - begin > most:
            end = _cut(data, at, border, begin, begin + most)
        first = int(np.searchsorted(at, begin, side="right")) - 1
        last = int(np.searchsorted(at, end, side="left"))
        yield data[begin:end], np.clip(at[first : last + 1], begin, end) - begin, first
        begin = end


def _cut(data: np.ndarray, at: np.ndarray, border: np.ndarray, begin: int, target: int) -> int:
    """The last end of a text in (begin, target], else of a part of a text, else the first one after it."""
    text = int(at[np.searchsorted(at, target, side="right") - 1])
    if text > begin:
        return text
    parts = np.flatnonzero(border[data[begin:target]])
    if len(parts):
        return begin + int(parts[-1]) + 1
    ends = int(at[np.searchsorted(at, target, side="left")])
    while target < ends:
        stop = min(2 * target - begin, ends)
        parts = np.flatnonzero(border[data[target:stop]])
        if len(parts):
            return target + int(parts[0]) + 1
        target = stop
    return ends


def release() -> None:
    """Give freed memory back to the system; an idle worker would keep it."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def strings(data: np.ndarray, cuts: np.ndarray) -> pa.LargeStringArray:
    """The texts between consecutive cuts as an array, without a copy."""
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def words(texts: pa.LargeStringArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space, A-Z in lower case: (code of each word, distinct words, n + 1 offsets of the texts)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    values = lists.flatten()
    bare = pc.not_equal(values, "")
    kept = bare.to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(kept)])
    offsets = lists.offsets.to_numpy()
    offsets = at[offsets - offsets[0]] if len(offsets) else np.zeros(1, np.int64)
    coded = values.filter(bare).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, offsets


def hashes(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process: bytes times a factor of their place, summed."""
    data, at = flat(distinct.cast(pa.large_string()))
    n = np.diff(at)
    place = ragged(np.zeros(len(n), np.int64), n)
    factor = mix(np.arange(1, int(n.max(initial=0)) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    terms = np.concatenate([(data.astype(np.uint64) + np.uint64(1)) * factor[place], np.zeros(1, np.uint64)])
    total = np.add.reduceat(terms, at[:-1]) if len(n) else np.zeros(0, np.uint64)
    return mix(np.where(n > 0, total, np.uint64(0)) + n.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.LargeStringArray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word n-grams, repeats included, and n + 1 offsets.

    A text of fewer words, but at least one, has one shingle: all of them. One without words has none.
    """
    codes, distinct, at = words(texts)
    own = hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(at)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(count)])
    first = ragged(at[:-1], count)
    limit = np.repeat(at[1:], count)
    h = np.zeros(len(first), np.uint64)
    for k in range(size):
        there = first + k < limit
        word = own[np.minimum(first + k, len(own) - 1)] if len(own) else h
        h = np.where(there, mix(h + word + np.uint64(k + 1)), h)
    return h, out
