"""The whole pipeline against a plain version of its five stages."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerglass.llm import decontamination

RNG = random.Random(21)
OWN = {
    "en": ["the", "thing", "other", "with", "their", "would", "about", "which", "there", "people", "should", "these"],
    "fr": ["le", "chose", "autre", "avec", "été", "leur", "pourrait", "environ", "lequel", "là", "gens", "devrait"],
    "de": ["das", "ding", "andere", "mit", "für", "würde", "über", "welche", "dort", "leute", "sollte", "diese"],
}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def text(lang, n):
    return " ".join(RNG.choice(OWN[lang]) for _ in range(n))


def changed(t, words):
    some = t.split(" ")
    for _ in range(words):
        some[RNG.randrange(len(some))] = "else"
    return " ".join(some)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, text(lang := RNG.choice(list(OWN)), RNG.randrange(40, 120)), lang) for i in range(160)]
    rows += [(200 + k, rows[k][1].replace(" ", " \n\t", 4), rows[k][2]) for k in range(15)]  # exact copies but for white space
    rows += [(300 + k, changed(rows[20 + k % 5][1], 1 + k // 5), rows[20 + k % 5][2]) for k in range(15)]  # near copies
    items = [(i, text("en", 14)) for i in range(12)] + [(50, "le mot"), (51, None), (52, "")]
    rows += [(400 + k, f"{rows[40 + k][1]} {items[k][1]} {rows[40 + k][1][:30]}", rows[40 + k][2]) for k in range(10)]
    rows += [(500, "12345 999 !!", "en"), (501, "", "fr"), (502, None, None), (503, "4 5 6", None), (504, f"{text('fr', 50)} le mot {text('fr', 5)}", "fr")]
    rows += [(600, text("de", 6000), "de"), (601, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2]), (None, text("fr", 70), "fr")]
    df = spark.createDataFrame([(i, t, lang, f"s{i or 0 % 3}", len(t or "")) for i, t, lang in rows], COLUMNS)
    df.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def plain(rows, items):
    """(doc_id, text) of what is left before packing."""
    known = [(i, t) for i, t, _ in rows if t and re.search("[a-zé]", t)]
    clean = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    order = lambda r: (r[0] is None, r[0] or 0)
    first = {}
    for i, t in sorted(known, key=order):
        first.setdefault(clean(t), (i, t))
    left = list(first.values())
    sets = []
    for _, t in left:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    group = list(range(len(left)))

    def head(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(left)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = head(a), head(b)
                group[max(x, y)] = min(x, y)
    left = [left[x] for x in range(len(left)) if head(x) == x]
    spaced = lambda t: clean("".join(c.lower() if "A" <= c <= "Z" else c for c in t)).strip(" ").encode()
    passages = [spaced(p) for _, p in items if p]
    return [(i, t) for i, t in left if not any(found(p, spaced(t)) for p in passages)]


def found(p, t):
    k = decontamination.edits_of(len(p))
    a = np.frombuffer(t, np.uint8)
    row, step = np.zeros(len(a) + 1, np.int64), np.arange(len(a) + 1)
    for c in p:
        best = np.minimum(np.concatenate([[1 << 30], row[:-1] + (a != c)]), row + 1)
        row = np.minimum.accumulate(best - step) + step
    return row.min() <= k


def test_pipeline_equals_a_plain_version(spark, tables):
    folder, rows, items = tables
    packed = corpus_pipeline.run(spark, folder).collect()
    left = plain(rows, items)
    assert len(left) < len(rows) - 35
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = collections.defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
    assert set(pieces) == {i for i, _ in left}
    for i, t in left:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]] and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        some.sort()
        assert [o for o, _ in some] == [0, *np.cumsum([n for _, n in some])[:-1]] and sum(n for _, n in some) <= 2048


def test_every_stage_keeps_the_columns(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, folder)
        assert kept.columns == docs.columns
        assert step(spark, docs.limit(0), folder).count() == 0


def test_near_copies_are_found_at_the_promised_rate(spark):
    """Pairs just above the threshold, which a single run of the join may miss."""
    from ledgerglass.llm import jaccard_join

    words = [f"w{k}" for k in range(4000)]
    rows = []
    for g in range(400):
        base = [RNG.choice(words) for _ in range(100)]
        near = list(base)
        for at in (20, 70)[: 1 + g % 2]:
            near[at] = "other"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(near))]
    # one or two words changed of 100: 5 or 10 of 96 windows differ, similarity 0.90 or 0.81
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    met = sum(got[2 * g].group_id == got[2 * g + 1].group_id for g in range(400))
    assert met >= 0.985 * 400
