"""Spelling variant grouping with a trie of letter-group counts.

A word is the vector of its counts of ``GROUPS`` letter groups. One edit adds one letter (one count more: surplus),
drops one (one count less: deficit) or swaps one for another (both, or neither within a group). A trie holds the
vectors, one level per group; a search goes down it depth first and may spend a surplus and a deficit of one.
Words in the leaves that it reaches are verified letter by letter.

The trie is cut into subtrees by its first levels, and a subtree with more than ``most`` words is cut at the next
level, until all are small or all levels are used; words of one vector that are still too many are dealt into
blocks by a hash. Every word goes into its own subtree and, as a query, into each subtree that its budget reaches.
Of a pair, only the shorter word asks, or the one with the smaller vector, or the smaller word: pairs meet once.

Defined results: null text has no words; a null id counts as empty in the noise's hash; words that occur in
several rows, repeated rows included, add up; an empty table gives no rows; other columns are ignored. Long words
are verified one pair at a time, all others by numpy, some thousand pairs at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.llm.arrays import blocks, release, strings, texts_of
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.sources.stage import stage

GROUPS = 20
LEVELS = 4
MOST_IN_SUBTREE = 4096
NARROW = 48
#: query and word pairs below this number are compared by whole vectors instead of going further down
ENOUGH = 1 << 14
#: a chain of forms grows by a factor of at least 5 a step, so it has at most 27 steps below 2^63
DOUBLINGS = 5
NOISE = 199


def _group_table() -> np.ndarray:
    """Letter (Latin-1 code) to group: a to z are dealt round, letters with marks go to the group of their code."""
    codes = np.arange(256)
    return np.where((codes >= 97) & (codes < 123), (codes - 97) % GROUPS, codes % GROUPS).astype(np.uint8)


GROUP_OF = _group_table()
#: ASCII bytes that are no letters
BORDER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to A-Z, a-z or U+00C0 to U+00FF (these are 0xC3 and one byte more)."""
    upper = data & 0xDF
    letter = ((upper >= 0x41) & (upper <= 0x5A)) | (data == 0xC3)
    letter[1:] |= data[:-1] == 0xC3
    return letter


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """(runs of letters, A-Z in lower case; number of each one's text)."""
    inside = _letter_bytes(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < len(data)]
    first[begins] |= inside[begins]
    starts = np.flatnonzero(first)
    place = np.cumsum(inside, dtype=np.int64)
    cuts = np.append(place[starts] - 1, place[-1] if len(place) else 0)
    letters = data[inside]
    letters = np.where((letters >= 0x41) & (letters <= 0x5A), letters + 32, letters).astype(np.uint8)
    return strings(letters, cuts), np.searchsorted(at, starts, side="right") - 1


def _noisy(run: bytes, h: int) -> str:
    text = run.decode()
    cut = h % len(text)
    return text[:cut] + text[cut + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5, noise: int | None = None) -> DataFrame:
    """(word, n): words of at least ``shortest`` letters that occur ``least`` times or more.

    With ``noise``, a run loses a letter where that number divides the CRC of ``<id>:<run>``.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = texts_of(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for data, at, start in blocks(every, BORDER):
                runs, text = _runs(data, at)
                coded = runs.dictionary_encode()
                code, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
                if not len(code):
                    continue
                lost: list[str] = []
                kept = np.ones(len(code), bool)
                if noise:
                    seeds = [crc32(f"{i}:".encode()) for i in ids[start : start + len(at) - 1]]
                    both, place, which = np.unique(text * len(distinct) + code, return_index=True, return_inverse=True)
                    names = distinct.cast(pa.large_binary()).take(pa.array(code[place])).to_pylist()
                    h = np.fromiter((crc32(w, seeds[t]) for w, t in zip(names, text[place].tolist(), strict=True)), np.int64, len(both))
                    hit = h % noise == 0
                    kept = ~hit[which]
                    times = np.bincount(which, minlength=len(both))
                    for k in np.flatnonzero(hit).tolist():
                        lost += [_noisy(names[k], int(h[k]))] * int(times[k])
                n = np.bincount(code[kept], minlength=len(distinct))
                long_enough = pc.greater_equal(pc.utf8_length(distinct), shortest).to_numpy(zero_copy_only=False) & (n > 0)
                yield _counts(distinct.filter(pa.array(long_enough)), n[long_enough])
                lost = [w for w in lost if len(w) >= shortest]
                yield _counts(pa.array(lost, pa.string()), np.ones(len(lost), np.int64))
            release()

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")
    counted = docs.select(ids, F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counts(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"])


# --- the cut of the trie into subtrees ----------------------------------------------------------


def _count(level: int) -> Column:
    """The word's letters of one group, from its length without them."""
    members = "".join(chr(c) for c in range(97, 256) if GROUP_OF[c] == level and (c < 123 or c >= 0xC0))
    return (F.length("word") - F.length(F.translate("word", members, ""))).cast("int")


def _step() -> Column:
    """The counts that a query may go to, with what it has left: array<struct<count, surplus, deficit>>.

    Going to a smaller count spends the query's surplus, to a larger one its deficit.
    """
    own = F.col("_own")
    kind = lambda count, surplus, deficit: F.struct(count.alias("count"), surplus.alias("surplus"), deficit.alias("deficit"))
    same = kind(own, F.col("surplus"), F.col("deficit"))
    less = F.when((F.col("surplus") > 0) & (own > 0), kind(own - 1, F.col("surplus") - 1, F.col("deficit")))
    more = F.when(F.col("deficit") > 0, kind(own + 1, F.col("surplus"), F.col("deficit") - 1))
    return F.when(F.col("member"), F.array(same)).otherwise(F.array_compact(F.array(same, less, more)))


def _descend(rows: DataFrame, level: int) -> DataFrame:
    """Members go to the node of their own count, queries to all that their budget reaches.

    A query whose first change is downwards would look for a smaller vector: there the other word asks.
    """
    down = rows.withColumn("_own", _count(level)).withColumn("_to", F.explode(_step()))
    down = down.where((F.col("_to.surplus") >= F.col("_to.deficit")))
    return down.withColumns(
        {"path": F.concat_ws(",", "path", F.col("_to.count").cast("string")), "surplus": F.col("_to.surplus"), "deficit": F.col("_to.deficit")}
    ).drop("_to", "_own")


def _subtrees(words: DataFrame, most: int) -> DataFrame:
    """(word, n, member, surplus, deficit, path, _members): rows dealt to subtrees of at most ``most`` words."""
    rows = words.select("word", "n").withColumn("member", F.explode(F.array(F.lit(True), F.lit(False)))).withColumns({"surplus": F.lit(1), "deficit": F.lit(1), "path": F.lit("")})
    for level in range(LEVELS):
        rows = _descend(rows, level)
    done, level = None, LEVELS
    while True:
        rows = stage(rows)
        sizes = rows.groupBy("path").agg(F.count_if("member").alias("_members"), F.count("*").alias("_rows"))
        sizes = stage(sizes.where("_members > 0").select(F.col("path").alias("_path"), "_members"))
        placed = rows.join(sizes, F.col("path") == F.col("_path")).drop("_path")
        large = placed.where(F.col("_members") > most).drop("_members")
        if level == GROUPS or sizes.where(F.col("_members") > most).isEmpty():
            return placed if done is None else done.unionByName(placed)
        small = placed.where(F.col("_members") <= most)
        done = small if done is None else done.unionByName(small)
        rows, level = _descend(large, level), level + 1


# --- the search in one subtree ------------------------------------------------------------------


def _vectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts of the letter groups, lengths)."""
    size = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    slot = np.repeat(np.arange(len(words)), size) * GROUPS + GROUP_OF[letters]
    return np.bincount(slot, minlength=len(words) * GROUPS).reshape(-1, GROUPS), size


def _codes(words: np.ndarray) -> np.ndarray:
    """Words as rows of Latin-1 codes, padded with 0; longer ones than ``NARROW`` are cut (and compared elsewhere)."""
    out = np.zeros((len(words), NARROW + 1), np.uint8)
    for i, w in enumerate(words):
        raw = w.encode("latin-1")[:NARROW]
        out[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    return out


def _one_edit(a: str, b: str) -> bool:
    """Whether b is a with one letter inserted or replaced (len(b) - len(a) is 0 or 1)."""
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :] and a != b


def _verified(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The same for many pairs of padded words."""
    place = np.arange(a.shape[1])
    first = np.argmax(np.concatenate([a != b, np.ones((len(a), 1), bool)], axis=1), axis=1)
    swapped = (na == nb) & ((a != b).sum(axis=1) == 1)
    shifted = np.where(place[None, :-1] >= first[:, None], b[:, 1:], b[:, :-1])
    grown = (nb == na + 1) & (a[:, :-1] == shifted).all(axis=1)
    return swapped | grown


class _Trie:
    """The subtrees of one group of rows: words sorted by path and vector, a node is a run of them."""

    def __init__(self, rows: pd.DataFrame):
        path, member = pd.factorize(rows["at"])[0], rows["member"].to_numpy()
        words, counts = rows["word"].to_numpy(), rows["n"].to_numpy()
        vector, size = _vectors(words)
        order = np.flatnonzero(member)
        order = order[np.lexsort([*vector[order].T[::-1], path[order]])]
        self.words, self.counts, self.vector, self.path, self.size = words[order], counts[order], vector[order], path[order], size[order]
        self.codes = _codes(self.words)
        asks = np.flatnonzero(~member)
        self.q_word, self.q_n, self.q_vector, self.q_path, self.q_size = words[asks], counts[asks], vector[asks], path[asks], size[asks]
        self.q_codes = _codes(self.q_word)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def search(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Every query goes to the root of its path's subtree; what its path has spent shows in the vectors."""
        paths, begin, n = np.unique(self.path, return_index=True, return_counts=True)
        order = np.argsort(self.q_path, kind="stable")
        left, right = np.searchsorted(self.q_path[order], paths, "left"), np.searchsorted(self.q_path[order], paths, "right")
        for i in range(len(paths)):
            alive = order[left[i] : right[i]]
            if len(alive):
                ones = np.ones(len(alive), np.int64)
                self._down(int(begin[i]), int(begin[i] + n[i]), 0, alive, ones, ones)
        return self.pairs

    def _down(self, lo: int, hi: int, level: int, alive: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """Depth first through the words lo to hi, which agree in all levels before this one."""
        if len(alive) * (hi - lo) <= ENOUGH or level == GROUPS:
            self._leaf(lo, hi, level, alive, surplus, deficit)
            return
        counts, begin = np.unique(self.vector[lo:hi, level], return_index=True)
        ends = np.append(begin[1:], hi - lo)
        own = self.q_vector[alive, level]
        for count, b, e in zip(counts, begin, ends, strict=True):
            over = own - count
            s, d = surplus - np.maximum(over, 0), deficit - np.maximum(-over, 0)
            on = (s >= 0) & (d >= 0)
            if on.any():
                self._down(lo + int(b), lo + int(e), level + 1, alive[on], s[on], d[on])

    def _leaf(self, lo: int, hi: int, level: int, alive: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """Some queries against some words: the rest of the vectors, then the letters."""
        step = max(1, ENOUGH // (hi - lo))
        for at in range(0, len(alive), step):
            for low in range(lo, hi, ENOUGH):
                self._compare(np.arange(low, min(hi, low + ENOUGH)), alive[at : at + step], level, surplus[at : at + step], deficit[at : at + step])

    def _compare(self, words, asks, level, surplus, deficit) -> None:
        over = self.q_vector[asks, None, level:] - self.vector[None, words, level:]
        on = (np.maximum(over, 0).sum(axis=2) <= surplus[:, None]) & (np.maximum(-over, 0).sum(axis=2) <= deficit[:, None])
        q, w = np.nonzero(on)
        q, w = asks[q], words[w]
        longer = self.size[w] - self.q_size[q]
        differ = self.q_vector[q] != self.vector[w]
        first = np.argmax(differ, axis=1)
        rows = np.arange(len(q))
        grows = self.vector[w, first] > self.q_vector[q, first]
        same = ~differ[rows, first]
        mine = (longer == 1) | ((longer == 0) & (grows | (same & (self.q_word[q] < self.words[w]))))
        q, w = q[mine], w[mine]
        wide = self.size[w] > NARROW
        good = np.zeros(len(q), bool)
        good[~wide] = _verified(self.q_codes[q[~wide]], self.codes[w[~wide]], self.q_size[q[~wide]], self.size[w[~wide]])
        good[wide] = [_one_edit(self.q_word[a], self.words[b]) for a, b in zip(q[wide], w[wide], strict=True)]
        if good.any():
            self.pairs.append((q[good], w[good]))


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    trie = _Trie(rows)
    found = trie.search()
    q = np.concatenate([p[0] for p in found]) if found else np.zeros(0, np.int64)
    w = np.concatenate([p[1] for p in found]) if found else np.zeros(0, np.int64)
    return pd.DataFrame({"a": trie.q_word[q], "a_n": trie.q_n[q], "b": trie.words[w], "b_n": trie.counts[w]})


def near_pairs(words: DataFrame, most: int = MOST_IN_SUBTREE) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words (word, n) that differ by one edit, once."""
    dealt = _subtrees(words, most)
    blocks = F.ceil(F.col("_members") / most).cast("int")
    block = F.pmod(F.xxhash64("word"), blocks).cast("int")
    # of a leaf with too many words each block is a subtree of its own, and queries go to all of them
    into = F.when(F.col("member"), F.array(block)).otherwise(F.sequence(F.lit(0), blocks - 1))
    dealt = dealt.withColumn("_block", F.explode(into))
    dealt = stage(dealt.select("word", "n", "member", F.concat_ws("/", "path", "_block").alias("at")))
    groups = max(8, -(-dealt.count() // (4 * most)))
    dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("at"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(_search, "a string, a_n long, b string, b_n long")


def variants(words: DataFrame, factor: int = 5, most: int = MOST_IN_SUBTREE) -> DataFrame:
    """One row per word of (word, n): its near words, its form and the root that the forms lead to."""
    words = stage(words.select("word", "n"))
    pairs = near_pairs(words, most)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("near")).alias("by")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("near")).alias("by")),
    )
    best = pairs.select(F.explode(sides).alias("x")).groupBy(F.col("x.word").alias("_word")).agg(F.count("*").alias("n_near"), F.min("x.by").alias("by"))
    near = words.join(best, F.col("word") == F.col("_word"), "left").drop("_word")
    formed = -F.col("by.n") >= factor * F.col("n")
    out = stage(
        near.select(
            "word",
            F.when(formed, F.col("by.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, -F.col("by.n")).alias("form_n"),
        )
    )
    roots = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        roots = stage(roots)
        on = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        roots = roots.join(on, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"))
    roots = stage(roots).select(F.col("word").alias("_word"), "root")
    return out.join(roots, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
