"""License scan: banded alignment against the full table, repeated phrases, repeats, ties and long texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerglass.llm import license_scan
from ledgerglass.llm.arrays import flat, texts_of


def full(template, region):
    """The best score of a local alignment over all diagonals."""
    best, row = 0, [0] * (len(region) + 1)
    for x in template:
        last, new = row, [0]
        for j, y in enumerate(region):
            new.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, *row)
    return best


def score_of(template, part):
    return full(template, part)


def test_the_band_loses_nothing_inside_it():
    rng = random.Random(3)
    for _ in range(200):
        template = np.array([rng.randrange(1, 40) for _ in range(rng.randrange(4, 60))], np.uint64)
        copy = list(template)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.choice([0, 1])] = [rng.randrange(1, 40)] * rng.choice([0, 1])
        lead = rng.randrange(6)
        region = np.array([rng.randrange(40, 80) for _ in range(lead)] + copy + [rng.randrange(40, 80) for _ in range(3)], np.uint64)
        equal, i, j = license_scan.align(template, region, lead - 6, 13)
        assert 0 <= i <= j <= len(region) and equal <= j - i
        # the span found scores as much as the whole region
        assert score_of(template.tolist(), region[i:j].tolist()) == full(template.tolist(), region.tolist())


MIT = next(t for a, b, t in license_scan.TEMPLATES if (a, b) == ("MIT", "text"))


def searched(text, index):
    words, _, _, at = license_scan.word_hashes(*flat(texts_of(pa.array([text]))))
    return list(license_scan.search(words, at, index))


def test_a_repeated_phrase_stays_small():
    index = license_scan.build_index()
    words = MIT.split()
    text = " ".join(words[20:24]) + " "
    tracemalloc.start()
    searched(text * 20_000, index)
    first = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    found = searched(text * 20_000 + MIT + " " + text * 20_000, index)
    tracemalloc.stop()
    assert first < 150e6
    mit = [i for i, name in enumerate(index.names) if name == ("MIT", "text")][0]
    assert max(equal for _, k, equal, _, _ in found if k == mit) == len(index.words[mit])


def test_rows_of_every_kind(spark):
    rows = [(1, f"Words before. {MIT} Words after."), (1, f"Words before. {MIT} Words after."), (None, MIT), (3, None), (4, ""), (5, "nothing " * 300_000), (6, MIT + "\n\n" + MIT)]
    df = spark.createDataFrame([(i, t, "x", 3, 1.0) for i, t in rows], "doc_id long, text string, license string, template int, coverage double")
    got = license_scan.scan_licenses(df).collect()
    whole = [r for r in got if (r.license, r.coverage) == ("MIT", 1.0)]
    assert sorted(str(r.doc_id) for r in whole) == ["1", "1", "6", "6", "None"]
    for r in whole:
        text = dict(rows)[r.doc_id]
        assert text[r.span_start : r.span_end].split() == MIT.rstrip('.').split()


@pytest.mark.parametrize("share", [0.9, 0.75])
def test_coverage_of_cut_copies(spark, share):
    words = MIT.split()
    kept = words[: int(len(words) * share)]
    got = license_scan.scan_licenses(spark.createDataFrame([(1, "a b c " + " ".join(kept) + " d e f")], "doc_id long, text string")).collect()
    best = max((r for r in got if r.license == "MIT"), key=lambda r: r.coverage)
    assert abs(best.coverage - share) < 0.03
