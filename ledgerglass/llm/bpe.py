"""Byte-pair tokenizers over whole columns: each distinct piece of text is encoded once.

A text may be cut before a single space, and around a single line feed, that stands between two
characters other than white space, and where letters, digits and marks meet (but not after an
apostrophe): both tokenizers' first step splits there anyway and looks at nothing beyond. Only
characters up to U+017F count here; others stay uncut. The pieces repeat far more often than texts
do, so a worker keeps their ids. The result equals encoding the whole text (tests compare both).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerglass.llm.arrays import flat, ragged, slices, strings, texts_of

#: Pieces that a worker remembers before it starts over.
MOST_PIECES = 3 << 18

#: Kind of an ASCII character: 1 letter, 2 digit, 3 mark, 0 anything else.
_KIND = np.array([1 if chr(i).isalpha() else 2 if chr(i).isdigit() else 3 if 32 < i < 127 else 0 for i in range(128)] + [0] * 128, np.uint8)

_encoders: dict[str, "Encoder"] = {}


def _cuts(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Sorted byte positions where pieces begin, and the end; texts marked ``whole`` stay in one piece."""
    n = len(data)
    if n == 0:
        return np.zeros(1, np.int64)
    graph = (data > 0x20) & (data < 0x7F)
    # A two-byte character from U+00C0 on is no white space.
    lead = (data >= 0xC3) & (data < 0xE0)
    before = graph.copy()
    before[1:] |= lead[:-1]
    after = graph | lead
    lone = (data == 0x20) | (data == 0x0A)
    lone[1:] &= before[:-1]
    lone[0] = False
    lone[:-1] &= after[1:]
    lone[-1] = False
    starts = np.zeros(n + 1, bool)
    starts[:-1] |= lone
    kind = _KIND[data]
    wide = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)
    # The signs for times and division are no letters; U+0130 gets a combining mark in lower case.
    odd = ((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))) | ((data[:-1] == 0xC4) & (data[1:] == 0xB0))
    kind[:-1][wide & ~odd] = 1
    kind[1:][wide & ~odd] = 1
    apart = (kind[:-1] != kind[1:]) & (kind[:-1] > 0) & (kind[1:] > 0)
    starts[1:-1] |= apart & (data[:-1] != 0x27)
    starts[1:] |= lone & (data == 0x0A)
    for i in np.flatnonzero(whole):
        starts[offsets[i] : offsets[i + 1]] = False
    starts[offsets] = True
    starts[0] = starts[n] = True
    return np.flatnonzero(starts)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _add(self, pieces: list[str]):
        if not pieces:
            return
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        at, ends = len(self.known), self.used + np.cumsum(lengths)
        while at + len(pieces) >= len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while ends[-1] >= len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        if ends[-1] > self.used:
            self.ids[self.used : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self.starts[at : at + len(pieces)] = ends - lengths
        self.lengths[at : at + len(pieces)] = lengths
        self.known.update(zip(pieces, range(at, at + len(pieces))))
        self.used = int(ends[-1])

    def encode(self, texts: pa.LargeStringArray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, each text's followed by ``end``; n + 1 offsets)."""
        data, offsets = flat(texts)
        whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        cuts = _cuts(data, offsets, whole)
        pieces = strings(data, cuts).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) + len(distinct) > MOST_PIECES:
            self.clear()
        self._add([p for p in distinct if p not in self.known])
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[pieces.indices.to_numpy()]
        self.starts[-1], self.lengths[-1], self.ids[-1] = len(self.ids) - 1, 1, end  # the last places serve the end
        ends = np.searchsorted(cuts, offsets)
        at = np.insert(at, ends[1:], len(self.starts) - 1)
        lengths = self.lengths[at]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ragged(self.starts[at], lengths)], before[ends + np.arange(len(ends))]


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(column: pa.Array, path: str, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets) for consecutive rows of a column, a slice at a time."""
    for first, part in slices(texts_of(column)):
        yield first, *encoder(path).encode(part, end)
