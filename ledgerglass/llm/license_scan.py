"""License scan: winnowed fingerprints pick candidates, banded alignment measures them.

A template's word k-grams are winnowed: of every ``WINDOW`` consecutive hashes the smallest is kept. The kept
hashes form an inverted index. All k-grams of a text are looked up in it, so a copied run of at least
``K + WINDOW - 1`` words is always seen. Hits of a template near one diagonal make a candidate, and a
local alignment of the template with the words along that diagonal gives the words that match, in order.

Words are runs of letters and digits, A-Z in lower case; bytes above 127 count as letters. Templates are a
parameter; their index is checked against ``MOST_WORDS`` and shipped to the tasks.

Defined results: null and empty texts have no license; a template found twice is reported twice; a text that holds
a short notice inside a longer one of the same license reports both templates; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerglass.llm.arrays import flat, mix, ragged, slices, texts_of
from ledgerglass.llm.shared import bounded_batches

K = 3
WINDOW = 2
LEAST_COVERAGE = 0.7
MOST_WORDS = 1 << 20
MATCHES = "license string, template string, coverage double, matched long, template_words long, span_start long, span_end long"

#: Fixed values: (license, name of the template, text). The wording is that of the licenses' own notices.
TEMPLATES = (
    ("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "line", "Released under the MIT License."),
    (
        "MIT",
        "text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "line", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("CC-BY-NC-4.0", "line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "deed", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "deed", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "ISC",
        "text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission.",
    ),
)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte and end of each word, n + 1 offsets of the texts in words)."""
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    letter = ((lower >= 97) & (lower <= 122)) | ((lower >= 48) & (lower <= 57)) | (lower >= 128)
    before = np.concatenate([[False], letter[:-1]]) if len(letter) else letter
    before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(letter & ~before)
    after = np.concatenate([letter[1:], [False]]) if len(letter) else letter
    last = at[1:-1][at[1:-1] > 0] - 1
    after[last[last < len(data)]] = False
    ends = np.flatnonzero(letter & ~after) + 1
    n = ends - starts
    place = ragged(np.zeros(len(n), np.int64), n)
    factor = mix(np.arange(1, int(n.max(initial=0)) + 1, dtype=np.uint64)) | np.uint64(1)
    terms = (lower[letter].astype(np.uint64) + np.uint64(1)) * factor[place]
    h = np.add.reduceat(terms, np.cumsum(n) - n) if len(n) else np.zeros(0, np.uint64)
    return mix(h + n.astype(np.uint64)), starts, ends, np.searchsorted(starts, at)


def word_grams(words: np.ndarray, k: int = K) -> np.ndarray:
    h = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        h = mix(h + words[i : len(words) - k + 1 + i] + np.uint64(i))
    return h


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash of each window, the last of equal ones."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


@dataclass
class Index:
    words: list[np.ndarray]
    names: list[tuple[str, str]]
    least: np.ndarray
    gram: np.ndarray
    template: np.ndarray
    place: np.ndarray


def build_index(templates: tuple[tuple[str, str, str], ...] = TEMPLATES) -> Index:
    texts = texts_of(pa.array([t for _, _, t in templates], pa.string()))
    h, _, _, at = word_hashes(*flat(texts))
    if len(h) > MOST_WORDS:
        raise ValueError(f"the templates have {len(h)} words, at most {MOST_WORDS} fit; scan in parts")
    words = [h[a:b] for a, b in zip(at[:-1], at[1:])]
    grams = [word_grams(w) for w in words]
    kept = [winnow(g) for g in grams]
    gram = np.concatenate([g[p] for g, p in zip(grams, kept)])
    order = np.argsort(gram, kind="stable")
    template = np.repeat(np.arange(len(words)), [len(p) for p in kept])
    least = np.array([max(1, len(p) // 4) for p in kept])
    return Index(words, [(a, b) for a, b, _ in templates], least, gram[order], template[order], np.concatenate(kept)[order])


def align(template: np.ndarray, region: np.ndarray, low: int, wide: int) -> tuple[int, int, int]:
    """(equal words, start, end in the region) of the best local alignment: 2 for equal words, -1 for each change or gap.

    Word i of the template meets the region's words ``low + i`` to ``low + i + wide - 1`` only, a band of ``wide``
    diagonals; places outside the region match nothing. The table has a row per word and a cell per diagonal.
    """
    n, m = len(region), len(template)
    before, after = max(0, -low), max(0, low + m - 1 + wide - n)
    words = np.concatenate([np.zeros(before, region.dtype), region, np.zeros(after, region.dtype)])
    real = np.zeros(len(words), bool)
    real[before : before + n] = True
    shift = low + before
    score, step = np.zeros((m + 1, wide), np.int32), np.arange(wide)
    for i in range(m):
        here = slice(shift + i, shift + i + wide)
        pair = score[i] + np.where((words[here] == template[i]) & real[here], 2, -1)
        skip = np.append(score[i, 1:] - 1, -1)
        new = np.maximum(np.maximum(pair, skip), 0)
        score[i + 1] = np.maximum.accumulate(new + step) - step
    i, d = (int(x) for x in np.unravel_index(int(np.argmax(score)), score.shape))
    end, equal = i + d, 0
    while i and score[i, d] > 0:
        j = shift + i - 1 + d
        same = bool(words[j] == template[i - 1] and real[j])
        if score[i, d] == score[i - 1, d] + (2 if same else -1):
            equal += same
            i -= 1
        elif d + 1 < wide and score[i, d] == score[i - 1, d + 1] - 1:
            i, d = i - 1, d + 1
        else:
            d -= 1
    clip = lambda x: min(max(low + x, 0), n)
    return equal, clip(i + d), clip(end)


def _stretches(diagonal: np.ndarray, place: np.ndarray, width: int, least: int) -> Iterator[tuple[int, int]]:
    """Runs of one candidate's hits (by diagonal) that span at most two bands and show enough places of the template.

    A phrase that a text repeats gives hits on ever new diagonals; they are cut into stretches of bounded span,
    which overlap by a band, and a phrase alone shows too few places.
    """
    a = 0
    while a < len(diagonal):
        b = int(np.searchsorted(diagonal, diagonal[a] + 2 * width, side="right"))
        if b - a >= least and len(np.unique(place[a:b])) >= least:
            yield a, b
        if b == len(diagonal):
            return
        a = max(a + 1, int(np.searchsorted(diagonal, diagonal[a] + width, side="right")))


def search(words: np.ndarray, at: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, template, equal words, first and end word in the text) of the matches."""
    grams = word_grams(words)
    first = np.searchsorted(index.gram, grams, side="left")
    there = np.flatnonzero(index.gram[np.minimum(first, len(index.gram) - 1)] == grams)
    text = np.searchsorted(at, there, side="right") - 1
    there, text = there[there + K <= at[text + 1]], text[there + K <= at[text + 1]]
    count = np.searchsorted(index.gram, grams[there], side="right") - first[there]
    entry = ragged(first[there], count)
    hit, text = np.repeat(there, count), np.repeat(text, count)
    template, place = index.template[entry], index.place[entry]
    length = np.array([len(w) for w in index.words])
    width = np.maximum(3, length // 8)
    diagonal = hit - at[text] - place + length[template]
    order = np.lexsort((diagonal, template, text))
    text, template, diagonal, place = text[order], template[order], diagonal[order], place[order]
    # Hits of one candidate: along the diagonals, no gap wider than the template's band.
    apart = (np.diff(text) != 0) | (np.diff(template) != 0) | (np.diff(diagonal) > width[template][1:]) if len(text) else np.zeros(0, bool)
    starts = np.flatnonzero(np.concatenate([[True], apart])) if len(text) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(text))
    for a, b in zip(starts.tolist(), ends.tolist()):
        t, k = int(text[a]), int(template[a])
        m, w, found = len(index.words[k]), int(width[k]), []
        for x, y in _stretches(diagonal[a:b], place[a:b], w, int(index.least[k])):
            low, span = int(diagonal[a + x]) - m - w, int(diagonal[a + y - 1] - diagonal[a + x])
            begin, stop = max(0, low), min(int(at[t + 1] - at[t]), low + m + span + 2 * w)
            equal, i, j = align(index.words[k], words[at[t] + begin : at[t] + stop], low - begin, span + 2 * w + 1)
            found.append((-equal, int(at[t]) + begin + i, int(at[t]) + begin + j))
        kept: list[tuple[int, int, int]] = []
        for equal, i, j in sorted(found):  # stretches overlap: of overlapping matches the one with most words counts
            if all(j <= y or z <= i for _, y, z in kept):
                kept.append((equal, i, j))
                yield t, k, -equal, i, j


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str, str], ...] = TEMPLATES, least: float = LEAST_COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, template, coverage, matched words, span in code points."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(build_index(templates))
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, {MATCHES}"
    fields = ["doc_id", *(x.split()[0] for x in MATCHES.split(", "))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for first, part in slices(texts_of(batch.column(1)), 2 << 20):
                data, at = flat(part)
                words, starts, ends, word_at = word_hashes(data, at)
                rows = []
                for t, k, equal, i, j in search(words, word_at, index):
                    if equal < least * len(index.words[k]):
                        continue
                    begin, stop = (int(np.count_nonzero((data[at[t] : p] & 0xC0) != 0x80)) for p in (starts[i], ends[j - 1]))
                    name = index.names[k]
                    rows.append((first + t, *name, equal / len(index.words[k]), equal, len(index.words[k]), begin, stop))
                if rows:
                    where, *rest = zip(*sorted(set(rows)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where)), *map(pa.array, rest)], fields)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)
