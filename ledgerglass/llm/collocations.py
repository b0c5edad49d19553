"""Phrase collocation mining with stripes.

A stripe belongs to a prefix of 0 to 4 words and counts the words that follow it. Tasks count stripes over some
megabytes of text and send each as one row, its words and counts side by side. Spark brings the stripes of a prefix
together and merges them elementwise. The stripe of a prefix that many positions share is dealt into parts by a hash of the
next word; such prefixes are at most ``HOT`` words, so their list is bounded. The merged structure gives everything else:

* an entry is the frequency of prefix + word, the extension of the prefix;
* the total of the empty prefix's stripe is the number of words of the language;
* the greatest entry of a prefix's stripe, and of the stripes that end in the same words, tells whether a phrase
  lies in a longer one that is as frequent.

Four passes over the texts: words; pairs of frequent words; three words whose pairs are frequent; four and five words
all of whose threes are frequent.
What is frequent reaches the tasks as a bit set of at most ``FILTER_BITS`` bits. A set bit may be false, which only
counts a phrase that is dropped later; a phrase that reaches ``least`` is never missed, whatever the size of the corpus.

Defined results: null text is empty, null lang is ``und``; empty texts and tables give no rows; each repeated row
counts; ties are ordered by frequency and then by the phrase's bytes; columns beside lang and text are ignored.
Texts are cut at piece borders into blocks of 4 MB, so a long text needs no more memory than its
longest piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerglass.llm.arrays import blocks, hashes, mix, release, strings, texts_of
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.sources.stage import stage

MOST_WORDS = 5
LEAST = 100
FILTER_BITS = 1 << 26
SALTS = 8
#: a word with more than 1 / HOT of all positions is hot: its stripe, like that of the empty prefix, has PARTS parts
HOT = 4096
PARTS = 256
#: texts that a task counts together
GATHERED = 8 << 20

#: 0: in a word, 1: between words, 2: between pieces
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: the next words are joined by blanks; an empty one has the total of the empty prefix
STRIPES = "lang string, prefix string, part int, next string, n array<int>"


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(code of each word, distinct words, whether it follows its predecessor in one piece, number of its text)."""
    kind = KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < len(data)]
    first[begins] |= inside[begins]
    starts = np.flatnonzero(first)
    place = np.cumsum(inside, dtype=np.int64)
    cuts = np.append(place[starts] - 1, place[-1] if len(place) else 0)
    border = np.cumsum(kind == 2, dtype=np.int32)[starts]
    text = np.searchsorted(at, starts, side="right") - 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = (border[1:] == border[:-1]) & (text[1:] == text[:-1])
    coded = strings(LOWER[data[inside]], cuts).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, joined, text


def chain(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its prefix and of its last word."""
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + word)


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one place of each distinct key, its count, code of each key)."""
    _, place, code, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return place, n, code


def _rows(langs: pa.Array, prefix: list[pa.Array], part: np.ndarray, cuts: np.ndarray, words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    """Stripes as rows: the words and counts between consecutive cuts."""
    blank = pa.scalar(" ", pa.large_string())
    joined = pc.binary_join_element_wise(*prefix, blank) if prefix else pa.array([""] * len(part), pa.string())
    offsets = pa.array(cuts, pa.int64())
    nexts = pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), blank)
    counts = pa.ListArray.from_arrays(offsets.cast(pa.int32()), pa.array(n, pa.int32()))
    columns = [langs.cast(pa.string()), joined.cast(pa.string()), pa.array(part, pa.int32()), nexts.cast(pa.string()), counts]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "part", "next", "n"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Several batches as one, up to ``GATHERED`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _stripes(level: int, filters: list, hot) -> callable:
    """What a task does in pass 1, 2, 3 or 4: the stripes of each block of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            texts = texts_of(table["text"])
            lang = pc.fill_null(table["lang"].combine_chunks(), "und").dictionary_encode()
            own = lang.indices.to_numpy().astype(np.int64)
            for data, at, first in blocks(texts, KIND == 2, GATHERED):
                yield from _block(level, filters, hot, words_of(data, at), own, lang.dictionary, first)
            del texts, table
            release()

    return run


def _block(level, filters, hot, words, own, langs, first) -> Iterator[pa.RecordBatch]:
    code, distinct, joined, text = words
    if not len(code):
        return
    lang, v = own[first + text], len(distinct)
    take = lambda codes: distinct.take(pa.array(codes))
    word, start = hashes(distinct), hashes(langs)
    dealt = (word >> np.uint64(40)).astype(np.int64) % PARTS

    def sent(group, part, prefix, ends, n):
        """Entries (of one group each) as stripes: ``prefix`` gives the words in front of the given places."""
        order = np.lexsort((part, group))
        group, part, ends, n = group[order], part[order], ends[order], n[order]
        cuts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (part[1:] != part[:-1]), [True]])) if len(n) else np.zeros(1, np.int64)
        heads = cuts[:-1]
        return _rows(langs.take(pa.array(lang[ends[heads]])), prefix(ends[heads]), part[heads], cuts, take(code[ends]), n)

    single = lang * v + code
    if level == 1:
        place, n, _ = _counted(single)
        yield sent(lang[place], dealt[code[place]], lambda ends: [], place, n)
        seen, n = np.unique(lang, return_counts=True)
        yield _rows(langs.take(pa.array(seen)), [], np.full(len(seen), -1), np.arange(len(seen) + 1), pa.array([""] * len(seen), pa.large_string()), n)
        return
    place, _, which = _counted(single)
    h = chain(start[lang[place]], word[code[place]])
    good, wide = passes(filters[0].value, h)[which], np.isin(h, hot.value)[which]
    pair = joined.copy()
    pair[1:] &= good[1:] & good[:-1]
    at = np.flatnonzero(pair)
    if level == 2:
        place, n, _ = _counted(single[at - 1] * v + code[at])
        at = at[place]
        yield sent(single[at - 1], np.where(wide[at - 1], dealt[code[at]], 0), lambda ends: [take(code[ends - 1])], at, n)
        return
    grams = np.full(len(code), -1, np.int64)  # of the longest phrase so far that ends here, a code
    h = np.zeros(len(code), np.uint64)
    h[at] = chain(chain(start[lang[at]], word[code[at - 1]]), word[code[at]])
    at = at[passes(filters[1].value, h[at])]
    if len(at):
        grams[at] = _counted(single[at - 1] * v + code[at])[2]
    sizes = range(3, 4)
    if level == 4:
        at = at[grams[at - 1] >= 0]
        at = at[passes(filters[2].value, chain(h[at - 1], word[code[at]]))]
        which = _counted(grams[at - 1] * v + code[at])[2] if len(at) else at
        grams[:] = -1
        grams[at] = which
        sizes = range(4, MOST_WORDS + 1)
    frequent = grams >= 0
    for size in sizes:
        at = at[frequent[at - 1] & (grams[at - 1] >= 0)]
        if not len(at):
            return
        place, n, which = _counted(grams[at - 1] * v + code[at])
        ends = at[place]
        part = np.where(wide[ends - size + 1], dealt[code[ends]], 0)
        yield sent(grams[ends - 1], part, lambda ends, size=size: [take(code[ends - k]) for k in range(size - 1, 0, -1)], ends, n)
        grams[:] = -1
        grams[at] = which


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise where the shuffle has put them; entries below ``least`` go, totals (no word) stay."""
    met = stripes.repartition("lang", "prefix", "part")
    entries = met.select("lang", "prefix", "part", F.explode(F.arrays_zip(F.split("next", " ").alias("word"), F.col("n").alias("n"))).alias("x"))
    merged = entries.groupBy("lang", "prefix", "part", F.col("x.word").alias("next")).agg(F.sum("x.n").alias("n"))
    return stage(merged.where((F.col("n") >= least) | (F.col("next") == "")).drop("part"))


def _filter(frequent: DataFrame, most: int):
    """A broadcast bit set of the phrases' hashes, 32 bits for each of them but ``most`` in all."""
    spark = frequent.sparkSession
    size = 1 << 16
    wanted = 32 * frequent.count()
    while size < min(wanted, most):
        size *= 2

    def slots(batches):
        for batch in batches:
            h = hashes(batch.column("lang"))
            for some in batch.columns[1:]:
                own = some.is_valid().to_numpy(zero_copy_only=False)
                h = np.where(own, chain(h, hashes(pc.fill_null(some, ""))), h)
            slot = h & np.uint64(size - 1)
            bit = (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["slot", "bits"])

    words = F.filter(F.split(F.concat_ws(" ", "prefix", "next"), " "), lambda w: w != "")
    found = frequent.select("lang", *[F.get(words, F.lit(i)).alias(f"w{i}") for i in range(MOST_WORDS)]).mapInArrow(slots, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


def _hot(words: DataFrame, totals: DataFrame):
    """Hashes of the words that hold more than 1 / HOT of all positions; there are at most HOT."""
    limit = totals.agg(F.coalesce(F.sum("n"), F.lit(0)) / HOT).scalar()
    found = words.withColumn("_limit", limit).where(F.col("n") > F.col("_limit")).select("lang", "next").toArrow()
    h = chain(hashes(found["lang"].combine_chunks()), hashes(found["next"].combine_chunks())) if found.num_rows else np.zeros(0, np.uint64)
    return words.sparkSession.sparkContext.broadcast(h)


def stripes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, prefix, next, n): the merged entries of at least ``least``, and per lang a total without a word."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    words = _merged(texts.mapInArrow(_stripes(1, [], None), STRIPES), least)
    known = words.where("next <> ''")
    filters, hot = [_filter(known, filter_bits)], _hot(known, words.where("next = ''"))
    pairs = _merged(texts.mapInArrow(_stripes(2, filters, hot), STRIPES), least)
    filters.append(_filter(pairs, filter_bits))
    threes = _merged(texts.mapInArrow(_stripes(3, filters, hot), STRIPES), least)
    filters.append(_filter(threes, filter_bits))
    longer = _merged(texts.mapInArrow(_stripes(4, filters, hot), STRIPES), least)
    return words.unionByName(pairs).unionByName(threes).unionByName(longer)


def _looked_up(rows: DataFrame, phrase: str, table: DataFrame, name: str) -> DataFrame:
    """The phrase's frequency. Many rows share a half such as "the": they are salted, with a copy of the table per salt."""
    copies = table.select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias(name), F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("_copy")
    )
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    same = (F.col("lang") == F.col("_lang")) & (F.col(phrase) == F.col("_phrase")) & (F.col("_salt") == F.col("_copy"))
    return rows.withColumn("_salt", salt).join(copies, same).drop("_lang", "_phrase", "_copy", "_salt")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = 2000, share: int = 100, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """The first ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    A phrase is scored by the worst of its cuts in two, ``1000 a n / (l r)`` rounded down. It goes if a longer
    phrase of at least ``share`` per cent of its frequency holds it.
    """
    entries = stripes(docs, lang_col, text_col, least, filter_bits)
    totals = entries.where("next = ''").select(F.col("lang").alias("_lang"), F.col("n").alias("total"))
    glue = F.when(F.col("prefix") == "", "").otherwise(" ")
    grams = stage(entries.where("next <> ''").select("lang", "prefix", F.concat("prefix", glue, "next").alias("phrase"), "n"))
    longer = grams.where("prefix <> ''")
    extended = (
        longer.select("lang", F.explode(F.array("prefix", F.expr("substr(phrase, instr(phrase, ' ') + 1)"))).alias("_held"), "n")
        .groupBy(F.col("lang").alias("_lang"), "_held")
        .agg(F.max("n").alias("_most"))
    )
    held = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_held")) & (100 * F.col("_most") >= share * F.col("n"))
    alone = longer.join(extended, held, "left_anti").select("lang", "phrase", F.col("n").alias("a"))
    parts = F.split("phrase", " ")
    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(parts) - 1))).withColumns(
        {
            "_left": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
            "_right": F.array_join(F.slice(parts, F.col("k") + 1, F.lit(MOST_WORDS)), " "),
        }
    )
    table = grams.select("lang", "phrase", "n")
    cuts = _looked_up(_looked_up(cuts, "_left", table, "l"), "_right", table, "r")
    cuts = cuts.join(totals, F.col("lang") == F.col("_lang")).drop("_lang")
    score = F.expr("cast(1000 as decimal(38,0)) * a * total div (cast(l as decimal(38,0)) * r)")
    worst = cuts.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat_rows = worst.select("lang", "phrase", "a", "x.l", "x.r", F.col("total").alias("n"), "x.score")
    ranked = flat_rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
