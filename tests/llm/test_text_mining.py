"""Quality rules, spelling variants and collocations against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerglass.llm import collocations, quality_rules, spelling_variants
from ledgerglass.llm.arrays import blocks, texts_of
from ledgerglass.llm.oracle import ORACLE as ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, word string, n int, n_words int, prefix string, path string, kept boolean"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, "p", "q", True) for i, t, lang in rows], SCHEMA).repartition(3)


# --- op13 ---------------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    pieces = collections.defaultdict(list)
    for _, text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        pieces[lang or "und"] += [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n-\r]", low)]
    out = []
    for lang, some in pieces.items():
        f = collections.Counter(tuple(p[i : i + s]) for p in some for s in range(1, 6) for i in range(len(p) - s + 1))
        n = sum(a for g, a in f.items() if len(g) == 1)
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = collections.defaultdict(int)
        for g, a in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(inside[g[i : i + k]], a)
        scored = []
        for g, a in found.items():
            if 100 * inside[g] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    words = ["ba", "BA", "co", "dün", "ere", "fa", "go", "x y", "ho-ho", "in", "of", "the"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "]) for _ in range(rng.randrange(90))), rng.choice(["en", "fr", None])) for i in range(150)]
    return [*rows, rows[0], rows[0], (None, "of the in of the in of the", "de"), (5, None, "en"), (6, "", "en"), (7, "the of " * 3000, "fr"), (8, "ba " * 500, None), (9, " . ,", "en")]


def test_collocations_equal_brute_force(spark):
    rows = phrase_rows()
    for least, top in ((5, 2000), (9, 7)):
        got = collocations.collocations(table(spark, rows), least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, least, top)


def test_collocations_with_a_full_filter(spark):
    """A filter far too small lets everything pass and changes no result."""
    rows = phrase_rows()
    got = collocations.collocations(table(spark, rows), least=5, filter_bits=64)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 5, 2000)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, []), least=2).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, "", "en")]), least=2).count() == 0


def test_scores_beyond_64_bits(spark):
    f = "cast(1000 as decimal(38,0)) * a * total div (cast(l as decimal(38,0)) * r)"
    row = spark.sql(f"SELECT {f} AS s FROM VALUES (4000000000001L, 5000000000000003L, 4000000000002L, 4000000000007L) t(a, total, l, r)").first()
    assert row.s == 1000 * 4000000000001 * 5000000000000003 // (4000000000002 * 4000000000007)


def test_blocks_cut_at_borders_only():
    texts = ["ab,cd", "", "x" * 40 + "," + "y" * 5, "z,", "tail"]
    border = np.zeros(256, bool)
    border[ord(",")] = True
    for most in (1, 3, 7, 16, 1000):
        out = [""] * len(texts)
        for data, at, first in blocks(texts_of(pa.array(texts)), border, most):
            parts = [bytes(data[a:b]).decode() for a, b in zip(at[:-1], at[1:], strict=True)]
            for k, part in enumerate(parts):
                assert not part or part.endswith(",") or (out[first + k] + part) == texts[first + k]
                out[first + k] += part
        assert out == texts


# --- op12 ---------------------------------------------------------------------------------------


def brute_words(rows, noise, shortest, least):
    n = collections.Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, factor=5):
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in form.items() if n[v] >= factor * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def word_rows():
    rng = random.Random(8)
    stems = ["banana", "bandana", "cabbage", "été-ÉTÉÉTÉ", "straßenbahn", "Straßenbahn", "ananas", "xœxxxxxÿ×÷"]
    rows = []
    for i in range(300):
        some = []
        for _ in range(rng.randrange(25)):
            w = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w[k : k + rng.choice([0, 1])] = rng.choice(["a", "b", "é", "s", ""])
            some.append("".join(w))
        rows.append((i, rng.choice([" ", "3", "\n"]).join(some), "en"))
    long = "ab" * 40
    return [*rows, rows[1], rows[1], (None, f"banana {long} {long}c " * 6, None), (7, None, "en"), (8, "", "en"), (9, "b" * 60 + " " + "b" * 61 + " " + "b" * 59 + "c", "en")]


@pytest.mark.parametrize("most", [2, 50, 4096])
def test_spelling_variants_equal_brute_force(spark, most):
    rows = word_rows()
    for noise, least in ((7, 1), (None, 3)) if most == 50 else ((None, 1),):
        counted = spelling_variants.word_counts(table(spark, rows), least=least, noise=noise)
        n = {r.word: r.n for r in counted.collect()}
        assert n == brute_words(rows, noise, 6, least)
        assert len(n) > 100
        got = spelling_variants.variants(counted, most=most)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(tuple(r) for r in got.collect()) == brute_variants(n)


def test_words_of_one_vector(spark):
    """Anagrams share every level of the trie; their leaf is dealt into blocks."""
    rng = random.Random(2)
    letters = list("aabbccddee")
    n = {}
    for k in range(400):
        rng.shuffle(letters)
        n["".join(letters)] = k + 1
        n["".join(letters[:-1])] = 2 * k + 1
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling_variants.variants(words, most=40)
    assert sorted(tuple(r) for r in got.collect()) == brute_variants(n)


def test_no_words(spark):
    counted = spelling_variants.word_counts(table(spark, [(1, None, None), (2, "", "en")]), noise=199)
    assert spelling_variants.variants(counted).count() == 0


# --- op11 ---------------------------------------------------------------------------------------


def brute_figures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def quality_rows():
    rng = random.Random(4)
    words = ["Die", "wörter", "sind", "hier", "und", "dort", "ganz", "neu", "zu", "lesen,", "meist.", "Oft", "kommt", "etwas", "anderes", "vor"]
    good = [" ".join(rng.choice(words) + str(rng.randrange(9)) * (rng.random() < 0.02) for _ in range(rng.randrange(60, 400))).replace(". ", ".\n") + "." for _ in range(120)]
    junk = [" ".join("####" + rng.choice(words).upper() + "$$|" for _ in range(150)) for _ in range(12)]
    again = ["\n".join(["Immer die selbe Zeile hier"] * rng.randrange(20, 60)) for _ in range(12)]
    texts = [*good, *junk, *again, good[0], good[0], None, "", " \n\t", "ein zwei", "a b a b a b", "x " * 30_000, "a\x0bb\x0cc d\re\n" * 3]
    return [(i if i % 9 else None, t, "de") for i, t in enumerate(texts)], len(good)


def test_quality_figures_equal_brute_force(spark):
    rows, n_good = quality_rows()
    got = quality_rules.filter_quality(table(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted((str(i), *brute_figures(t)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), *[r[c] for c in names]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, t, _ in rows[:n_good] if i is not None and 2 * brute_figures(t)[4] <= brute_figures(t)[0]} <= kept
    assert not kept & {i for i, _, _ in rows[n_good : n_good + 24] if i is not None}
    assert quality_rules.filter_quality(table(spark, [])).count() == 0


def numpy_em(votes, rounds, settled):
    """The same model row by row."""
    n = votes.shape[1]
    good, a, b = 0.5, np.full(n, 0.95), np.full(n, 0.55)
    for _ in range(rounds):
        odds = np.log(good / (1 - good)) + ((votes == 1) * np.log(a / (1 - b)) + (votes == -1) * np.log((1 - a) / b)).sum(axis=1)
        p = 1 / (1 + np.exp(-odds))
        gg, gb = ((votes == 1) * p[:, None]).sum(axis=0), ((votes == -1) * p[:, None]).sum(axis=0)
        bg, bb = ((votes == 1) * (1 - p)[:, None]).sum(axis=0), ((votes == -1) * (1 - p)[:, None]).sum(axis=0)
        new_a = np.clip((gg + 4) / (gg + gb + 5), 0.55, 0.99)
        new_b = np.minimum(0.99, np.maximum(1.05 - new_a, (bb + 1) / (bb + bg + 2)))
        new_good = (p.sum() + 1) / (len(votes) + 2)
        moved = max(abs(new_good - good), np.abs(new_a - a).max(), np.abs(new_b - b).max())
        good, a, b = new_good, new_a, new_b
        if moved < settled:
            break
    return good, a, b


def test_expectation_maximisation(spark):
    """Equal to a row-by-row version, and near the accuracies that made the votes."""
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.8
    on_good, on_bad = np.array([0.97, 0.9, 0.95, 0.85, 0.92]), np.array([0.8, 0.6, 0.7, 0.75, 0.5])
    right = rng.random((4000, 5)) < np.where(y[:, None], on_good, on_bad)
    votes = np.where(right == y[:, None], 1, -1) * (rng.random((4000, 5)) < 0.8)
    df = spark.createDataFrame(votes.tolist(), ", ".join(f"v{i} int" for i in range(5)))
    model = quality_rules.expect_maximise(df.groupBy(*df.columns).agg(F.count("*").alias("n")), 5, rounds=200)
    good, a, b = numpy_em(votes, 200, quality_rules.SETTLED)
    assert np.allclose([model.good, *model.on_good, *model.on_bad], [good, *a, *b], atol=1e-6)
    assert abs(model.good - 0.8) < 0.05 and np.abs(a - on_good).max() < 0.05 and np.abs(b - on_bad).max() < 0.12


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([], "v0 int, v1 int, n long")
    assert quality_rules.expect_maximise(df, 2) == quality_rules.start(2)


def test_sizes_as_spark_writes_them():
    from ledgerglass.llm.shared import size_of

    assert [size_of(x) for x in ("4194304", "64b", "64k", "2KB", "64m", "1g")] == [4 << 20, 64, 64 << 10, 2 << 10, 64 << 20, 1 << 30]
