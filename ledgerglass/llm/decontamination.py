"""Benchmark decontamination: q-gram lemma filtering, then banded alignment.

A passage of length m within k edits of a region shares at least m + 1 - q (k + 1) of its q-grams with
the region, and a pair of equal q-grams (i in the passage, j in the text) of one alignment lies on diagonals
j - i that differ by at most k. A text first needs that many of a passage's places at all; that is counted per
(text, passage) from the text's distinct q-grams, so a beginning that thousands of passages share costs
its q-grams once and not once per place in the text. For what is left, pairs are counted in bands of 2 k + 1
diagonals, each beginning k + 1 after the one before; a band with fewer pairs can hold no match. A band with
enough is verified by an alignment of the whole passage along the band's diagonals.

One law gives a passage's edits: ``EDIT_RATE`` of its bytes, but no more than the lemma can bear, which is
one less than the q-grams of ``Q`` bytes that fit side by side. A passage shorter than ``Q`` has q-grams of its own length and
is found without edits.

The passages are the query side. Spark writes them as index files of ``BLOCK`` q-grams to the shared folder; tasks
gather texts and hold them against one file after the other, so the corpus is read once and memory is
bounded, whatever the size of the benchmark. Texts are compared in lower case (A-Z) with each run of white space as
one space, over UTF-8 bytes.

Defined results: null or empty texts and passages match nothing; matches of one passage in one text do not overlap (exact
ones count first, then of two the one with fewer edits, or the first); equal passages each report; repeated rows each report; an empty table gives no rows; columns beside
those named are ignored. A long text is handled in pieces that overlap by more than a match's length.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerglass.llm.arrays import flat, mix, ragged, release, slices, texts_of
from ledgerglass.llm.shared import bounded_batches, open_fs, shared_uri
from ledgerglass.sources.stage import stage

Q = 12
#: Edits allowed for each byte of a passage, within the lemma's bound.
EDIT_RATE = 0.06
#: Q-grams of the passages that are held at a time.
BLOCK = 1 << 20
#: Pairs of equal q-grams that are held at a time.
PAIRS = 1 << 21
#: Bytes of text that a task holds against one index file after the other.
GATHERED = 16 << 20
#: Bytes of text that are searched at a time.
PIECE = 1 << 20
FILTER_BITS = 22
MATCHES = "item_id long, span_start long, span_end long, edits long"


def normal(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    return pc.utf8_trim(pc.replace_substring_regex(pc.ascii_lower(texts), r"[\x20\x09-\x0D]+", " "), " ")


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q bytes from each position on, built from windows of doubling width."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    window, width, at = data.astype(np.uint64), 1, 0
    h = np.zeros(n, np.uint64)
    while width <= q:
        if q & width:
            h = mix(h + window[at : at + n]) if at else window[:n].copy()
            at += width
        if 2 * width <= min(q, 8):
            window = (window[:-width] << np.uint64(8 * width)) | window[width:]
        elif 2 * width <= q:
            window = mix(window[:-width]) + window[width:]
        width *= 2
    return h * np.uint64(0x9E3779B97F4A7C15)


def edits_within(passage: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best match of the whole passage inside the region, if within ``most``.

    Only the diagonals of the region count, and ``most`` on either side: a row of the alignment has as many cells as
    the region is longer than the passage (plus those). Start and end in the region are free. The minimum along a row
    is taken by a running minimum, so a row is a few array operations.
    """
    m, n = len(passage), len(region)
    wide = np.concatenate([np.full(most, 256, np.int16), region, np.full(max(0, m - n) + most, 256, np.int16)])
    width = len(wide) - m + 1
    step = np.arange(width)
    cost, begin = np.zeros(width, np.int64), step.copy()
    for i, c in enumerate(passage):
        swap = cost + (wide[i : i + width] != c)
        down = np.append(cost[1:] + 1, most + i + 2)
        diagonal = swap <= down
        new = np.where(diagonal, swap, down)
        start = np.where(diagonal, begin, np.append(begin[1:], width))
        # new[d] = min over l <= d of new[l] + (d - l)
        key = (new - step) * (width + 1) + step
        best = np.minimum.accumulate(key)
        place = best % (width + 1)
        cost, begin = (best - place) // (width + 1) + step, start[place]
        if cost.min() > most:
            return None
    j = int(np.argmin(cost))
    clip = lambda x: min(max(x - most, 0), n)
    return int(cost[j]), clip(int(begin[j])), clip(j + m)


def edits_of(length: int, rate: float = EDIT_RATE, q: int = Q) -> int:
    """How many edits a passage of so many bytes may have: the rate, but no more than the lemma bears."""
    return max(0, min(int(length * rate), length // q - 1))


@dataclass
class Block:
    """An inverted index of some passages' q-grams: distinct grams, and where each one's entries begin."""

    q: int
    ids: list[int]
    texts: list[bytes]
    edits: np.ndarray
    least: np.ndarray
    gram: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def own(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of each of a passage's grams, its place), by number."""
        if not hasattr(self, "_order"):
            self._order = np.argsort(self.item, kind="stable")
            self._ends = np.searchsorted(self.item[self._order], np.arange(len(self.ids) + 1))
            self._run = np.repeat(np.arange(len(self.gram)), np.diff(self.begin))
        some = self._order[self._ends[i] : self._ends[i + 1]]
        return self._run[some], self.place[some]

    def filter(self) -> np.ndarray:
        if not hasattr(self, "_bits"):
            self._bits = np.zeros(1 << FILTER_BITS, bool)
            self._bits[self.gram >> np.uint64(64 - FILTER_BITS)] = True
        return self._bits


def indexed(items: list[tuple[int, bytes]], q: int, rate: float = EDIT_RATE) -> Block:
    """The index of normalised passages, all of at least q bytes (or all of exactly q, if q is below ``Q``)."""
    lengths = np.array([len(t) for _, t in items])
    edits = np.array([edits_of(n, rate, q) if q == Q else 0 for n in lengths.tolist()])
    own = [grams(np.frombuffer(t, np.uint8), q) for _, t in items]
    gram = np.concatenate(own)
    item = np.repeat(np.arange(len(items)), [len(g) for g in own])
    place = np.concatenate([np.arange(len(g)) for g in own])
    order = np.argsort(gram, kind="stable")
    distinct, begin = np.unique(gram[order], return_index=True)
    return Block(q, [i for i, _ in items], [t for _, t in items], edits, lengths + 1 - q * (edits + 1), distinct, np.append(begin, len(gram)), item[order], place[order])


def blocks(items: Iterator[tuple[int, str]], rate: float = EDIT_RATE, q: int = Q) -> Iterator[Block]:
    """The passages in blocks of at most ``BLOCK`` q-grams (or one passage); short ones by their length."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    size: dict[int, int] = {}
    for item_id, text in items:
        raw = normal(texts_of(pa.array([text], pa.string())))[0].as_py().encode()
        if not raw:
            continue
        own = min(q, len(raw))
        if held.get(own) and size[own] + len(raw) > BLOCK:
            yield indexed(held.pop(own), own, rate)
        if own not in held:
            held[own], size[own] = [], 0
        held[own].append((item_id, raw))
        size[own] += len(raw)
    for own, some in held.items():
        yield indexed(some, own, rate)


# --- the search -----------------------------------------------------------------------------------


def _hits(data: np.ndarray, at: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, text, number of the gram) of the texts' q-grams that the index holds."""
    gram = grams(data, block.q)
    hit = np.flatnonzero(block.filter()[(gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    run = np.minimum(np.searchsorted(block.gram, gram[hit]), len(block.gram) - 1)
    known = block.gram[run] == gram[hit]
    hit, run = hit[known], run[known]
    text = np.searchsorted(at, hit, side="right") - 1
    inside = hit + block.q <= at[text + 1]
    return hit[inside], text[inside], run[inside]


def _alive(text: np.ndarray, run: np.ndarray, block: Block) -> Iterator[tuple[int, int]]:
    """(text, item) where the text has enough of the passage's places; pairs are made for some texts at a time."""
    n_runs, n_items = len(block.gram), len(block.ids)
    both = np.unique(text * n_runs + run)
    text, run = both // n_runs, both % n_runs
    count = block.begin[run + 1] - block.begin[run]
    load = np.cumsum(count)
    low = 0
    while low < len(text):
        before = int(load[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(load, before + PAIRS, side="right")))
        # a text's grams stay together; alone it has no more pairs than the index has entries
        last = text[min(high, len(text)) - 1]
        cut = int(np.searchsorted(text, last, side="left")) if high < len(text) else len(text)
        high = cut if cut > low else int(np.searchsorted(text, last, side="right"))
        entry = ragged(block.begin[run[low:high]], count[low:high])
        key, places = np.unique(np.repeat(text[low:high], count[low:high]) * n_items + block.item[entry], return_counts=True)
        enough = key[places >= block.least[key % n_items]]
        yield from zip((enough // n_items).tolist(), (enough % n_items).tolist(), strict=True)
        low = high


def search(data: np.ndarray, at: np.ndarray, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the matches in some normalised texts."""
    hit, text, run = _hits(data, at, block)
    for t, i in _alive(text, run, block):
        low, high = np.searchsorted(text, [t, t + 1])
        own = data[at[t] : at[t + 1]]
        whole = list(_exact(own.tobytes(), block.texts[i]))
        yield from ((t, i, start, end, 0) for start, end in whole)
        if not block.edits[i]:
            continue
        runs, places = block.own(i)
        first, last = np.searchsorted(runs, run[low:high], "left"), np.searchsorted(runs, run[low:high], "right")
        some = np.flatnonzero(last > first)
        spot, first, count = hit[low:high][some] - at[t], first[some], (last - first)[some]
        held = None
        for begin, stop in _windows(spot, count, len(block.texts[i]) + 4 * int(block.edits[i])):
            entry = ragged(first[begin:stop], count[begin:stop])
            for match in _matches(own, np.repeat(spot[begin:stop], count[begin:stop]), places[entry], block, i):
                before = bisect_left(whole, (match[1], 0))
                if before and whole[before - 1][1] > match[0]:
                    continue  # it overlaps an exact match
                if held and match[0] >= held[1]:
                    yield t, i, *held
                    held = None
                if held is None or match[2] < held[2]:
                    held = match
        if held:
            yield t, i, *held


def _exact(text: bytes, passage: bytes) -> Iterator[tuple[int, int]]:
    at = text.find(passage)
    while at >= 0:
        yield at, at + len(passage)
        at = text.find(passage, at + len(passage))


def _windows(spot: np.ndarray, count: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Runs of hits with about ``PAIRS`` pairs each, which overlap by more than a match's length."""
    load = np.cumsum(count)
    begin = 0
    while begin < len(spot):
        before = int(load[begin - 1]) if begin else 0
        stop = int(np.searchsorted(load, before + PAIRS, side="right"))
        stop = min(len(spot), max(stop, int(np.searchsorted(spot, spot[begin] + 3 * reach, side="right"))))
        yield begin, stop
        if stop == len(spot):
            return
        begin = max(begin + 1, int(np.searchsorted(spot, spot[stop - 1] - 2 * reach, side="left")))


def _matches(text: np.ndarray, spot: np.ndarray, place: np.ndarray, block: Block, i: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, edits) of matches with edits, in order of the bands that have enough pairs."""
    k, passage = int(block.edits[i]), block.texts[i]
    letters = np.frombuffer(passage, np.uint8)
    diagonal = spot - place + k  # not negative for a match at the text's start with up to k edits
    # A pair lies in two bands of 2 k + 1 diagonals, which begin k + 1 apart.
    band, pairs = np.unique(np.concatenate([diagonal // (k + 1), diagonal // (k + 1) - 1]), return_counts=True)
    for b in band[pairs >= block.least[i]].tolist():
        low = max(0, b * (k + 1) - 2 * k)
        high = min(len(text), (b + 2) * (k + 1) + len(passage) + k)
        region = text[low:high]
        found = None if passage in region.tobytes() else edits_within(letters, region, k)
        if found:
            yield low + found[1], low + found[2], found[0]


# --- index files and the pass over the corpus -----------------------------------------------------


def write_index(items: DataFrame, item_col: str, item_text: str, rate: float) -> list[str]:
    """Write the passages' index files to the shared folder; their addresses, one per about ``BLOCK`` q-grams."""
    uri = shared_uri(items.sparkSession, "passages")
    passages = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(uri)
        part = TaskContext.get().partitionId()
        rows = ((i, t) for batch in batches for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for n, block in enumerate(blocks(rows, rate)):
            name = f"passages-{part:06d}-{n:06d}"
            with fs.open_output_stream(f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}") as out:
                pickle.dump(block, out, protocol=5)
            fs.move(f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}", f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{uri}/{name}"])], names=["file"])

    return sorted(r.file for r in stage(passages.mapInArrow(write, "file string")).collect())


def _load(uri: str) -> Block:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as file:
        return pickle.loads(file.read_buffer())


def _gathered(batches: Iterator[pa.RecordBatch], column: int, files: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches brought together until they hold ``GATHERED`` bytes; as they are if one index file stays loaded anyway."""
    most = GATHERED if len(files) > 1 else 0
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _scanned(batch: pa.RecordBatch, column: int, files: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item id, start, end, edits) of a batch's matches."""
    texts = normal(texts_of(batch.column(column)))
    for uri in files:
        block = _LOADED.get(uri) or _load(uri)
        if len(files) == 1:  # one file serves all batches of the worker
            _LOADED.clear()
            _LOADED[uri] = block
        for first, part in slices(texts, PIECE):
            data, at = flat(part)
            for t, i, s, e, k in search(data, at, block):
                yield first + t, block.ids[i], s, e, k
    release()


_LOADED: dict[str, Block] = {}


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """One row per match: doc_id, item_id, span (bytes of the normalised text) and edits."""
    bounded_batches(docs.sparkSession)
    files = write_index(items, item_col, item_text, rate)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, 1, files):
            rows = list(_scanned(batch, 1, files))
            if rows:
                where, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(where)), *(pa.array(x, pa.int64()) for x in rest)], [batch.schema.names[0], "item_id", "span_start", "span_end", "edits"]
                )

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, {MATCHES}"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document with a passage: doc_id, the item ids found, how many, and the fewest edits."""
    found = find_passages(docs, items, **options)
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.count("*").alias("n_matches"), F.min("edits").alias("fewest_edits"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """The documents without any passage, all columns kept; no row leaves its partition."""
    bounded_batches(docs.sparkSession)
    files = write_index(items, item_col, item_text, rate)
    where = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, where, files):
            keep = np.ones(batch.num_rows, bool)
            for match in _scanned(batch, where, files):
                keep[match[0]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
