"""Decontamination: one law for every length, shared beginnings, repeated rows, several index files."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerglass.llm import decontamination
from ledgerglass.llm.arrays import flat, texts_of

RNG = random.Random(11)


def prose(n):
    return "".join(RNG.choice("abcdefgh éß") for _ in range(n)).strip() or "a"


def edited(text, k):
    letters = list(text)
    for _ in range(k):
        at = RNG.randrange(1, max(2, len(letters) - 1))
        letters[at : at + RNG.choice([0, 1])] = RNG.choice(["", "x", "yz"[:1]])
    return "".join(letters)


def best(passage, text):
    """The least edits of the passage within the text, over bytes."""
    a, b = passage.encode(), text.encode()
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def clean(text):
    return " ".join((text or "").lower().split())


def want(docs, items):
    out = {}
    for d, t in docs:
        for i, p in items:
            k = decontamination.edits_of(len(clean(p).encode())) if clean(p) else -1
            if clean(t) and k >= 0 and (e := best(clean(p), clean(t))) <= k:
                out[d, i] = e
    return out


def test_the_law_has_no_gap():
    edits = [decontamination.edits_of(n) for n in range(1, 400)]
    assert edits == sorted(edits) and edits[22] == 0 and edits[23] == 1 and edits[33] == edits[34] == 1
    assert all(n + 1 - decontamination.Q * (k + 1) >= 1 for n, k in enumerate(edits, 1) if n >= decontamination.Q)


def test_passages_of_every_length_equal_brute_force(spark):
    items = [(n, prose(n)) for n in range(1, 51)] + [(100 + n, prose(n)) for n in (60, 85, 120, 200)] + [(300, None), (301, " \n"), (302, "A"), (303, "A")]
    docs = []
    for d in range(60):
        some = RNG.sample(items[:54], 2)
        docs.append((d, prose(40) + "  " + "\n".join(edited(p, RNG.choice([0, 1, 1, 2])) for _, p in some) + prose(30)))
    docs += [docs[0], docs[0], (900, None), (901, ""), (902, items[40][1]), (None, items[45][1])]
    schema = "doc_id long, text string, item_id long, edits string"
    df = spark.createDataFrame([(d, t, 5, "x") for d, t in docs], schema).repartition(3)
    bench = spark.createDataFrame([(i, p, 1) for i, p in items], "item_id long, text string, doc_id long")
    found = decontamination.find_passages(df, bench).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in sorted(found, key=lambda r: -r.edits)} == want(docs, items)
    # a repeated row reports as often as it is there
    assert sum(r.doc_id == 0 for r in found) == 3 * sum(1 for r in found if r.doc_id == 0) // 3 and sum(r.doc_id == 0 for r in found) % 3 == 0
    spans = {(r.doc_id, r.item_id): (r.span_start, r.span_end) for r in found if r.edits == 0}
    texts, passages = dict(docs), dict(items)
    for (d, i), (a, b) in spans.items():
        assert clean(texts[d]).encode()[a:b] == clean(passages[i]).encode()


def test_many_index_files_give_the_same(spark, monkeypatch):
    items = [(i, prose(60)) for i in range(40)]
    docs = [(d, prose(50) + edited(items[d % 40][1], d % 3) + prose(20)) for d in range(80)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    one = sorted(map(tuple, decontamination.find_passages(df, bench).collect()))
    many = sorted(map(tuple, decontamination.find_passages(df, bench.repartition(7)).collect()))
    assert one == many and len(one) > 50
    assert decontamination.drop_contaminated(df, bench.repartition(7)).count() == 80 - len({r[0] for r in one})


def slice_of(*texts):
    return flat(decontamination.normal(texts_of(pa.array(texts))))


def test_a_shared_beginning_costs_its_grams_once():
    """2,000 passages that begin alike, and a text of 1 MB that repeats the beginning."""
    start = "answer the following question in one word: "[:40]
    items = [(i, clean(start + prose(160)).encode()) for i in range(2000)]
    block = decontamination.indexed(items, decontamination.Q)
    text = (start + "x") * (1_000_000 // 41) + items[77][1].decode() + start
    data, at = slice_of(text)
    tracemalloc.start()
    found = list(decontamination.search(data, at, block))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(t, i, k) for t, i, _, _, k in found] == [(0, 77, 0)]
    assert peak < 300e6


@pytest.mark.parametrize("pairs", [1 << 10, 1 << 21])
def test_repetitive_texts_in_windows(monkeypatch, pairs):
    """Every place of the text pairs with every place of the passage; windows bound what is held."""
    monkeypatch.setattr(decontamination, "PAIRS", pairs)
    block = decontamination.indexed([(1, b"ab" * 60), (2, b"ab" * 30 + b"c" * 40)], decontamination.Q)
    data, at = slice_of("ab" * 3000 + "z", "ab" * 30 + "c" * 39, "q" * 50)
    found = sorted(decontamination.search(data, at, block))
    whole = [(s, e) for t, i, s, e, k in found if (t, i) == (0, 0) and k == 0]
    assert whole == [(120 * n, 120 * n + 120) for n in range(50)]
    assert [(t, i, k) for t, i, _, _, k in found if t == 1] == [(1, 1, 1)]


def test_banded_alignment_equals_the_full_table():
    for _ in range(300):
        passage = prose(RNG.randrange(24, 90)).encode()
        k = decontamination.edits_of(len(passage))
        region = (prose(RNG.randrange(8)) + edited(passage.decode(), RNG.randrange(4)) + prose(RNG.randrange(8))).encode()
        got = decontamination.edits_within(np.frombuffer(passage, np.uint8), np.frombuffer(region, np.uint8), k)
        e = best(passage.decode(), region.decode())
        assert (got is None) == (e > k)
        if got:
            assert got[0] == e and best(passage.decode(), region[got[1] : got[2]].decode(errors="replace")) <= e + 2
