"""Co-moments, table profile, sketches, hexagonal cells, exact p-values and missing scores."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerglass.operators import comoments, drift, metrics, profile, sketches


def test_correlations_with_holes_equal_pairwise_ones(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + [0, 1e9, -5, 3, 0, 0]
    x[:, 4] = 0.1
    holes = rng.random(x.shape) < 0.2
    holes[:, 5] = True
    rows = [[None if h else float(v) for v, h in zip(r, hr, strict=True)] for r, hr in zip(x, holes, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(6))).repartition(5)
    got = {(r.a, r.b): r.r for r in comoments.correlations(df, df.columns).collect()}
    assert len(got) == 36
    for i, j in itertools.product(range(6), range(6)):
        both = ~holes[:, i] & ~holes[:, j]
        r = got[f"c{i}", f"c{j}"]
        if 4 in (i, j) or 5 in (i, j):
            assert r is None
        else:
            assert abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-6
    one = comoments.co_moments(df, ["c0", "c2"]).where("a = 'c0' AND b = 'c2'").first()
    both = ~holes[:, 0] & ~holes[:, 2]
    assert one.n == both.sum() and abs(one.mean_a - x[both, 0].mean()) < 1e-9
    assert comoments.correlations(df.limit(0), ["c0"]).collect()[0].r is None


def test_sixty_eight_columns_in_one_scan(spark):
    df = spark.range(300).select(*[((F.col("id") * (7 * i + 3)) % (31 + i)).cast("double").alias(f"x{i}") for i in range(68)])
    got = comoments.correlations(df, df.columns)
    assert got.count() == 68 * 68
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2


def test_a_nan_counts_as_a_value(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (float("nan"), 3.0, None), (2.0, 5.0, 1.0), (4.0, 1.0, 2.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in comoments.correlations(df, df.columns).collect()}
    assert math.isnan(got["a", "b"]) and abs(got["b", "c"] + 1) < 1e-12 and abs(got["a", "c"] - 1) < 1e-12


def test_table_profile(spark):
    rows = [(i, "x" if i % 3 else "y", None if i % 4 == 0 else float(i % 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, s string, v double")
    got = {(r.column_name, r.stat): (r.value, r.text) for r in profile.table_profile(df).collect()}
    assert got["id", "type"] == (None, "bigint") and got["s", "type"] == (None, "string")
    assert got["id", "median"][0] == 49.5 and got["id", "q1"][0] == 24.75
    assert got["s", "frequent_1"] == (66.0, "x") and got["s", "frequent_2"] == (34.0, "y")
    held = [float(i % 5) for i in range(100) if i % 4]
    assert got["v", "frequent_1"] == (15.0, "0.0") and got["v", "q3"][0] == np.quantile(held, 0.75)
    assert ("id", "frequent_1") not in got and ("s", "median") not in got
    assert got["v", "missing"][0] == 25
    empty = {(r.column_name, r.stat): r.value for r in profile.table_profile(df.limit(0)).collect()}
    assert empty["id", "count"] == 0 and ("s", "frequent_1") not in empty


@pytest.fixture(scope="module")
def days(spark):
    rng = random.Random(9)
    rows = [(i % 10, rng.choice([rng.lognormvariate(2, 2), -rng.random(), 0.0, None, float(rng.randrange(40))]), f"k{rng.randrange(3000)}" if i % 50 else None) for i in range(8000)]
    return spark.createDataFrame(rows, "day int, x double, k string").repartition(3), rows


def test_quantile_sketches(days):
    df, rows = days
    daily = sketches.quantile_sketch(df, "x", ["day"])
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
    for first, last in ((0, 9), (3, 5), (7, 7)):
        some = df.where(F.col("day").between(first, last))
        merged = sketches.merge_quantiles(daily.where(F.col("day").between(first, last)))
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, sketches.quantile_sketch(some, "x", []).collect()))
        values = sorted(x for d, x, _ in rows if x is not None and first <= d <= last)
        got = {r.probability: r["quantile"] for r in sketches.estimate_quantiles(merged, probabilities).collect()}
        for p in probabilities:
            true = values[math.floor(p * (len(values) - 1))]
            assert abs(got[p] - true) <= sketches.ERROR * abs(true) * 1.0001 + 1e-9
    by_day = sketches.estimate_quantiles(daily, (0.5,), ["day"])
    assert by_day.count() == 10
    assert sketches.estimate_quantiles(daily.limit(0), (0.5,)).count() == 0


def test_distinct_sketches(days):
    df, rows = days
    daily = sketches.distinct_sketch(df, "k", ["day"])
    for first, last in ((0, 9), (2, 4), (8, 8)):
        merged = sketches.merge_distinct(daily.where(F.col("day").between(first, last)))
        whole = sketches.distinct_sketch(df.where(F.col("day").between(first, last)), "k", [])
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
        true = len({k for d, _, k in rows if k is not None and first <= d <= last})
        assert abs(sketches.estimate_distinct(merged).first().estimate - true) < 4 * 1.04 / 64 * true
    many = df.sparkSession.range(200_000).select(F.col("id").cast("string").alias("k"))
    estimate = sketches.estimate_distinct(sketches.distinct_sketch(many, "k", [])).first().estimate
    assert abs(estimate - 200_000) < 4 * 1.04 / 64 * 200_000
    assert sketches.estimate_distinct(daily.limit(0)).first().estimate == 0


def test_hexagonal_cells(spark):
    rng = random.Random(4)
    pts = [(rng.random() * 7, rng.gauss(0, 3)) for _ in range(400)]
    df = spark.createDataFrame([*pts, (None, 1.0), (1.0, None)], "a double, b double")
    got = {(r.row, r.column): r for r in profile.hex_density(df, "a", "b", 9).collect()}
    lx, ly = min(p[0] for p in pts), min(p[1] for p in pts)
    wx, wy = (max(p[0] for p in pts) - lx) / 9, (max(p[1] for p in pts) - ly) / 5
    centres = [(2 * j, i, i, j) for i in range(-1, 11) for j in range(-1, 7)] + [(2 * j + 1, i, i + 0.5, j + 0.5) for i in range(-1, 11) for j in range(-1, 7)]
    want: dict = {}
    for a, b in pts:
        u, v = (a - lx) / wx, (b - ly) / wy
        cell = min(centres, key=lambda c: (round((u - c[2]) ** 2 + 3 * (v - c[3]) ** 2, 12), c[0] % 2, -c[1], -c[0]))[:2]  # noqa: B023
        want[cell] = want.get(cell, 0) + 1
    assert {c: r.n for c, r in got.items()} == want
    assert all(abs(r.x_centre - (lx + (c[1] + (c[0] % 2) / 2) * wx)) < 1e-9 and abs(r.y_centre - (ly + c[0] / 2 * wy)) < 1e-9 for c, r in got.items())
    assert profile.hex_density(df.limit(0), "a", "b").count() == 0


def ks(order, n, m):
    i = j = best = 0
    for side in order:
        i, j = i + side, j + 1 - side
        best = max(best, abs(i * m - j * n))
    return best


def test_exact_p_values_equal_enumeration(spark):
    for n, m in [(1, 1), (2, 3), (4, 4), (5, 3), (6, 5), (7, 7), (3, 9)]:
        found = []
        for chosen in itertools.combinations(range(n + m), n):
            order = [0] * (n + m)
            for c in chosen:
                order[c] = 1
            found.append(ks(order, n, m))
        for reach in sorted(set(found)):
            assert abs(drift.exact_ks_p(reach / (n * m), n, m) - np.mean([f >= reach for f in found])) < 1e-12
    # twelve and twelve: paths counted by whole numbers
    for reach in range(1, 13):
        ways = np.zeros((13, 13), object)
        for i, j in itertools.product(range(13), range(13)):
            if abs(i - j) < reach:
                ways[i, j] = 1 if i == j == 0 else (ways[i - 1, j] if i else 0) + (ways[i, j - 1] if j else 0)
        assert abs(drift.exact_ks_p(reach / 12, 12, 12) - (1 - ways[12, 12] / math.comb(24, 12))) < 1e-12
    # close to the asymptotic value for large samples
    df = spark.createDataFrame([(0.1, 300, 280), (0.0, 5, 5), (1.0, 3, 4), (0.2, 1000, 90)], "d double, n long, m long")
    p = [r.p for r in df.select(drift.ks_p_value(F.col("d"), F.col("n"), F.col("m"), 300).alias("p")).collect()]
    asymptotic = [r.p for r in df.select(drift.kolmogorov_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert abs(p[0] - asymptotic[0]) < 0.02 and p[1] == 1.0 and abs(p[2] - 2 / 35) < 1e-12 and p[3] == asymptotic[3]


def test_null_and_nan_scores_are_one(spark):
    rows = lambda missing: [(1, 0.9), (0, 0.6), (1, missing), (0, missing), (0, 0.2), (1, 0.7)]
    a, b = [
        metrics.ranking_metrics(spark.createDataFrame(rows(x), "is_fraud int, predictions double")).first().asDict() for x in (None, float("nan"))
    ]
    assert a == b
    # as if the missing ones had the lowest score
    assert a == metrics.ranking_metrics(spark.createDataFrame(rows(-1.0), "is_fraud int, predictions double")).first().asDict()


def test_table_profile_counts_values_once(spark, monkeypatch):
    """Distinct counts, quartiles and frequent values come from one count; no summary pass is needed."""
    df = spark.createDataFrame([(1, "a", 2.5), (1, None, 2.5), (2, "b", None), (None, "a", -0.5)], "i int, s string, x double")
    counts = {(r.column_name, r.value): (r.x, r.known, r.n) for r in profile.column_counts(df, df.columns).collect()}
    assert counts["i", "1"] == (1.0, True, 2) and counts["s", None] == (None, False, 1) and counts["x", "2.5"] == (2.5, True, 2) and len(counts) == 9
    want = {(r.column_name, r.value): r.n for r in profile.frequent_values(df, df.columns, 0.3).collect()}
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrameStatFunctions.freqItems", None)
    got = {(r.column_name, r.stat): (r.value, r.text) for r in profile.table_profile(df, support=0.3).collect()}
    assert {(c, t): int(v) for (c, s), (v, t) in got.items() if s.startswith("frequent")} == want
    assert [got[c, "distinct"][0] for c in "isx"] == [2, 2, 2] and [got["x", q][0] for q in ("q1", "median", "q3")] == [1.0, 2.5, 2.5]
