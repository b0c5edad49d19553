"""Encoders, gazetteer, splits, metrics, drift and profiles on small fixtures."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerglass.operators import cleaning, drift, encoders, gazetteer, metrics, points, profile, running, skew, splits
from ledgerglass.plans.features import with_train_risk
from ledgerglass.schema import DAY_US
from ledgerglass.sources.gazetteer import read_gazetteer, write_gazetteer

GAZ = "category string, cat_ord int, job string, job_ord int"


# --- running totals ---------------------------------------------------------------------


def test_running_totals_with_one_group_holding_most_rows(spark):
    rnd = random.Random(1)
    rows = [("big" if rnd.random() < 0.8 else f"g{i % 3}", i, rnd.randrange(9)) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, o int, x int")
    got = running.running_totals(df, ["g"], "o", {"s": ("sum", "x"), "m": ("max", "x")}, ranges=16)
    seen = {}
    expected = {}
    for g, o, x in rows:
        s, m = seen.get(g, (0, None))
        expected[o] = (s, m)
        seen[g] = (s + x, x if m is None else max(m, x))
    assert {r.o: (r.s, r.m) for r in got.collect()} == expected


def test_ranges_are_balanced_and_monotone(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("v"), F.exp(F.col("id") % 50).alias("e"))
    counts = running.with_range(df, "v", "r", 16).groupBy("r").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = counts.orderBy("r").collect()
    assert len(rows) == 16 and max(r.n for r in rows) < 3 * 20000 / 16
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, o int, x int")
    assert running.running_totals(df, ["g"], "o", {"s": ("sum", "x")}).collect() == []
    assert running.quantiles(df, "x", (0.5,)).collect() == []


def test_quantiles(spark):
    rows = [("a", float(v)) for v in (5, 1, 1, 1, 9)] + [("b", 2.0), ("b", 4.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.probability): r.quantile for r in running.quantiles(df, "v", (0.0, 0.5, 0.75, 0.85, 1.0), ["g"]).collect()}
    assert got["a", 0.0] == 1 and got["a", 0.5] == 1 and got["a", 0.75] == 5 and got["a", 1.0] == 9
    assert got["a", 0.85] == pytest.approx(5 + 0.4 * 4)
    assert got["b", 0.5] == 3 and got["b", 0.75] == 3.5


# --- skew ----------------------------------------------------------------------------------


def test_split_hot_keeps_every_row(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(None,)] * 4, "k int")
    counts = skew.count_keys(df, "k")
    cold, hot = skew.split_hot(df, "k", skew.hot_keys(counts, "k", 3))
    assert sorted(str(r.k) for r in hot.collect()) == ["1"] * 5 + ["None"] * 4
    assert [r.k for r in cold.collect()] == [2, 2]
    assert skew.hot_keys(counts, "k", 100) is None and skew.split_hot(df, "k", None)[1] is None
    table = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    joined = skew.join_per_key(df, table, "k", skew.hot_keys(counts, "k", 3)).collect()
    assert sorted((str(r.k), str(r.v)) for r in joined) == [("1", "x")] * 5 + [("2", "y")] * 2 + [("None", "None")] * 4


def test_settle_small_leaves_the_choice_to_the_planner(spark):
    df = spark.range(10)
    small = skew.settle_small(df)
    assert small.count() == 10
    keys = spark.range(1000).withColumnRenamed("id", "k")
    plan = lambda: keys.join(small, keys.k == small.id)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- encoders --------------------------------------------------------------------------------


def test_encoders(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "c string")
    new = spark.createDataFrame([(0, "c"), (1, "zz"), (2, None), (3, "a")], "i int, c string")
    codes = encoders.fit_codes(fit, "c")
    assert sorted((r.value, r.code) for r in codes.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    coded = encoders.encode_ordinal(new, "c", codes, "k").orderBy("i").collect()
    assert [r.k for r in coded] == [2.0, -1.0, None, 0.0]
    with pytest.raises(Exception, match="unseen label: zz"):
        encoders.encode_label(new.where("i < 2"), "c", codes, "k").collect()
    assert [r.k for r in encoders.encode_label(fit.dropna(), "c", codes, "k").orderBy("c").collect()] == [0, 0, 1, 2]
    categories = encoders.fit_onehot(fit, "c")
    wide = encoders.encode_onehot(new, "c", categories).orderBy("i")
    assert wide.columns == ["i", "c_b", "c_c"]
    assert [tuple(r)[1:] for r in wide.collect()] == [(0, 1), (0, 0), (0, 0), (0, 0)]


def test_one_category_keeps_its_columns(spark):
    only = spark.createDataFrame([("M",)], "gender string")
    assert encoders.encode_onehot(only, "gender", ["F", "M"]).first().gender_M == 1


# --- gazetteer ---------------------------------------------------------------------------------


def _gaz(spark):
    rows = [
        ("Health", 0, "nurse, paediatric", 0),
        ("Health", 0, "surgeon", 1),
        ("Tech", 1, "engineer, water", 0),
        ("Tech", 1, "surgeon", 1),
        ("Food", 2, "abcdefghij", 0),
        ("Drink", 3, "abcdefghij", 0),
        ("Other", 4, None, 0),
    ]
    return spark.createDataFrame(rows, GAZ)


def test_categorize(spark):
    df = spark.createDataFrame([("surgeon",), ("cook",), (None,)], "job string")
    got = {r.job: r.job_category for r in gazetteer.categorize(df, _gaz(spark)).collect()}
    assert got == {"surgeon": "Health", "cook": "Other", None: "Other"}
    got = {r.job: r.job_category for r in gazetteer.categorize(df, _gaz(spark), default="None").collect()}
    assert got["cook"] == "None"


def test_nearest_titles(spark):
    jobs = ["water engineer,", "water, engineer", "paediatric nurse,", "abcdefg", "abcdef", "surgeons", "zzz"]
    unseen = gazetteer.unseen_values(spark.createDataFrame([(j,) for j in [*jobs, "surgeon"]], "job string"), _gaz(spark))
    assert unseen.count() == len(jobs)
    got = {r.job: r for r in gazetteer.nearest_titles(unseen, _gaz(spark), 70).collect()}
    assert (got["water, engineer"].category, got["water, engineer"].match) == ("Tech", "engineer, water")
    assert got["paediatric nurse,"].score == 100.0
    # 7 of 10 letters: 200 * 7 / 17; equal in two categories, the earlier one wins
    assert got["abcdefg"].category == "Food" and got["abcdefg"].score == pytest.approx(1400 / 17)
    assert got["surgeons"].category == "Health"
    assert got["zzz"].category == "Other" and got["zzz"].match is None
    exact = gazetteer.nearest_titles(spark.createDataFrame([("abcdef",)], "job string"), _gaz(spark), 75)
    assert exact.first().score == pytest.approx(75.0)


def test_nearest_titles_against_brute_force(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9)))
    listed = [(f"c{i % 4}", i % 4, f"{word()} {word()}", i) for i in range(40)]
    titles = sorted({f"{word()} {word()}" for _ in range(60)} - {r[2] for r in listed})
    got = {r.job: r for r in gazetteer.nearest_titles(spark.createDataFrame([(t,) for t in titles], "job string"), spark.createDataFrame(listed, GAZ), 60).collect()}
    from tests.test_functions import _lcs

    key = lambda t: " ".join(sorted(t.split()))
    for t in titles:
        scored = [(-200 * _lcs(key(t), key(j)) / (len(key(t)) + len(key(j))), o, i, c, j) for c, o, j, i in listed]
        best = min(scored)
        if -best[0] >= 60 - 1e-9:
            assert (got[t].category, got[t].match) == (best[3], best[4])
            assert got[t].score == pytest.approx(-best[0])
        else:
            assert got[t].category == "Other"


def test_gazetteer_round_trip(spark, tmp_path):
    source = {"B": ["x", "w a t e r"], "A": ["y"], "Other": []}
    (tmp_path / "g.json").write_text(json.dumps(source, indent=2))
    gaz = read_gazetteer(spark, str(tmp_path / "g.json"))
    assert [(r.category, r.cat_ord, r.job) for r in gaz.orderBy("cat_ord", "job_ord").collect()] == [
        ("B", 0, "x"), ("B", 0, "w a t e r"), ("A", 1, "y"), ("Other", 2, None),
    ]
    titles = spark.createDataFrame([("water",), ("y",), ("qqq",), ("qqp",), ("a w t e r",)], "job string")
    updated = gazetteer.update_gazetteer(gaz, titles)
    write_gazetteer(updated.unionByName(gaz.where("job IS NULL")), str(tmp_path / "out"))
    written = json.loads(next((tmp_path / "out").glob("part-*")).read_text())
    assert list(written) == ["B", "A", "Other"]
    assert written == {"B": ["x", "w a t e r", "a w t e r"], "A": ["y"], "Other": ["qqp", "qqq", "water"]}
    with pytest.raises(Exception):
        write_gazetteer(gaz, str(tmp_path / "out"))


def test_gazetteer_failures(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_gazetteer(spark, str(tmp_path / "none.json"))
    (tmp_path / "bad.json").write_text('{"A": ["x"')
    with pytest.raises(Exception):
        read_gazetteer(spark, str(tmp_path / "bad.json")).collect()


# --- splits --------------------------------------------------------------------------------------


def _days(spark, days):
    return spark.createDataFrame([(i, d * DAY_US) for i, d in enumerate(days)], "i int, us long").withColumn(
        "trans_date_trans_time", F.timestamp_micros("us")
    )


def test_split_manifest_and_rows(spark):
    df = _days(spark, range(0, 61))
    manifest = splits.split_manifest(df, freq=10, rolling_window=10, gap=3, val_duration=20)
    got = {r.split_id: r for r in manifest.collect()}
    assert len(got) == 7
    assert got[0].reason == "short training"
    # training needs rolling_window days up to one day before the point
    assert got[1].reason is None and got[1].train_start_us == 0 and got[1].train_end_us == 9 * DAY_US
    assert got[1].val_start_us == 13 * DAY_US and got[1].val_end_us == 33 * DAY_US
    assert got[3].reason is None and got[3].val_end_us == 53 * DAY_US
    # 43..60 is shorter than 20 days
    assert got[4].reason == "short validation"
    rows = splits.split_rows(df, manifest)
    train1 = sorted(r.i for r in rows.where("split_id = 1 AND role = 'train'").collect())
    val1 = sorted(r.i for r in rows.where("split_id = 1 AND role = 'val'").collect())
    assert train1 == list(range(0, 10)) and val1 == list(range(13, 34))
    # one row may lie in several splits
    assert rows.where("i = 25").count() > 1
    summary = splits.split_summary(df, manifest).where("split_id = 2 AND role = 'val'").first()
    assert (summary.first_us, summary.last_us, summary.n) == (23 * DAY_US, 43 * DAY_US, 21)


# --- metrics ---------------------------------------------------------------------------------------


def _scored(spark, n=400, seed=2):
    rnd = random.Random(seed)
    rows = [(i, f"d{i % 7}", int(rnd.random() < 0.2), round(rnd.random(), 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "trans_num int, trans_date string, is_fraud int, predictions double")


def test_ranking_metrics_against_definitions(spark):
    rows, df = _scored(spark)
    got = metrics.ranking_metrics(df).first()
    pos = [s for *_, y, s in rows if y]
    neg = [s for *_, y, s in rows if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    assert got.auc_roc == pytest.approx(wins / len(pos) / len(neg))
    ap = trap = 0.0
    last_recall, last_precision = 0.0, 1.0
    for cut in sorted({r[3] for r in rows}, reverse=True):
        tp = sum(s >= cut for s in pos)
        precision, recall = tp / (tp + sum(s >= cut for s in neg)), tp / len(pos)
        ap += (recall - last_recall) * precision
        trap += (recall - last_recall) * (precision + last_precision) / 2
        last_recall, last_precision = recall, precision
    assert got.average_precision == pytest.approx(ap) and got.pr_auc == pytest.approx(trap)
    guess = [round(r[3]) for r in rows]
    tp = sum(g and r[2] for g, r in zip(guess, rows))
    assert got.f1_score == pytest.approx(2 * tp / (sum(guess) + len(pos)))


def test_auc_is_invariant_under_monotone_maps(spark):
    _, df = _scored(spark)
    bent = df.withColumn("predictions", F.exp(F.col("predictions") * 5))
    assert metrics.ranking_metrics(df).first().auc_roc == pytest.approx(metrics.ranking_metrics(bent).first().auc_roc)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.9)], "is_fraud int, predictions double")
    got = metrics.ranking_metrics(df).first()
    assert got.auc_roc is None and got.average_precision is None and got.f1_score == 0.0


def test_precision_top_k(spark):
    rows = [
        (1, "a", 1, 0.9), (2, "a", 0, 0.9), (3, "a", 1, 0.5), (4, "a", 1, 0.1),
        (5, "b", 1, 0.3),  # a day shorter than k still divides by k
        (6, "c", 0, 0.8), (7, "c", 0, 0.7),
    ]
    df = spark.createDataFrame(rows, "trans_num int, trans_date string, is_fraud int, predictions double")
    got = {r.trans_date: (r.n_fraud, r.n_detected, r.precision) for r in metrics.precision_top_k_by_day(df, 2).collect()}
    assert got == {"a": (3, 1, 0.5), "b": (1, 1, 0.5), "c": (0, 0, 0.0)}
    own = {r.trans_date: (r.n_detected, r.precision) for r in metrics.precision_top_k_by_day(df, None).collect()}
    assert own == {"a": (2, pytest.approx(2 / 3)), "b": (1, 1.0), "c": (0, None)}
    assert metrics.precision_top_k(df, 2).first().precision_top_2 == 0.333
    assert [(r.trans_date, r.trans_num) for r in metrics.detected_top_k(df, 2).orderBy("trans_num").collect()] == [("a", 1), ("b", 5)]
    table = metrics.metric_table(df, top_k=(1, 2)).first()
    assert table.precision_top_2 == 0.333 and set(table.asDict()) == {"auc_roc", "average_precision", "f1_score", "precision_top_1", "precision_top_2"}


def test_large_k_takes_the_ranged_way(spark, monkeypatch):
    _, df = _scored(spark)
    want = {r.trans_date: r.n_detected for r in metrics.precision_top_k_by_day(df, 9).collect()}
    monkeypatch.setattr(metrics, "MAX_LIMITED_K", 5)
    assert {r.trans_date: r.n_detected for r in metrics.precision_top_k_by_day(df, 9).collect()} == want
    assert metrics.detected_top_k(df, 9).count() == sum(want.values())


def test_top_k_is_limited_before_the_shuffle(spark):
    _, df = _scored(spark)
    plan = metrics.precision_top_k_by_day(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "is_fraud int, predicted int")
    got = {(r.label, r.predicted): r.n for r in metrics.confusion(df).collect()}
    assert got == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_fold_summary(spark):
    rows = [(i, d, "auc_roc", v) for i, (d, v) in enumerate([("val", 1.0), ("val", 3.0), ("train", 2.0)])]
    folds = spark.createDataFrame(rows, "fold int, dataset string, metric string, value double")
    got = metrics.side_by_side(metrics.fold_summary(folds)).first()
    assert (got.val_mean, got.val_std, got.train_mean, got.train_std) == (2.0, 1.0, 2.0, 0.0)


# --- drift -------------------------------------------------------------------------------------------


def _months(spark, values):
    rows = [(f"2020-{m:02d}-15 00:00:00", float(v), int(v) % 2) for m, vs in values.items() for v in vs]
    return spark.createDataFrame(rows, "t string, amt double, is_fraud int").withColumn("trans_date_trans_time", F.to_timestamp("t"))


def test_ks_drift(spark):
    rnd = random.Random(4)
    data = {1: range(50), 2: range(50), 3: range(100, 150), 5: [rnd.gauss(60, 40) for _ in range(80)]}
    got = {(str(r.month)[5:7], r.lag, r.feature): r for r in drift.ks_drift(_months(spark, data)).collect()}
    # month 4 is missing, so 5 is compared with 3 and 2 only
    assert {k[:2] for k in got} == {("02", 1), ("03", 1), ("03", 2), ("05", 2), ("05", 3)}
    same, apart = got["02", 1, "amt"], got["03", 1, "amt"]
    assert (same.ks, same.p_value, same.drift) == (0.0, 1.0, False)
    assert apart.ks == 1.0 and apart.p_value < 1e-9 and apart.drift
    a, b = list(data[5]), list(data[3])
    cdf = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    assert got["05", 2, "amt"].ks == pytest.approx(max(abs(cdf(a, v) - cdf(b, v)) for v in [*a, *b]))


def test_one_month_has_no_drift_rows(spark):
    assert drift.ks_drift(_months(spark, {1: range(5)})).collect() == []
    assert drift.kl_drift(_months(spark, {1: range(5)})).collect() == []


def test_kl_drift(spark):
    got = {str(r.month)[5:7]: r.kl for r in drift.kl_drift(_months(spark, {1: range(40), 2: range(40), 3: [0, 39]}), bins=4).collect()}
    assert got["02"] == pytest.approx(0.0) and got["03"] > 0.5


# --- profiles, points, nulls ---------------------------------------------------------------------------


def test_active_after_fraud(spark):
    rows = [
        (1, 0, 1), (1, 3, 0),  # exactly three days later does not count
        (2, 0, 1), (2, 4, 0),
        (3, 9, 0),  # never a fraud
    ]
    df = spark.createDataFrame([(c, d * DAY_US, y) for c, d, y in rows], "cc_num int, us long, is_fraud int")
    got = profile.active_after_fraud(df.withColumn("trans_date_trans_time", F.timestamp_micros("us"))).first()
    assert (got.n_cards, got.n_active) == (3, 1) and got.active_share == pytest.approx(1 / 3)


def test_rates_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 1, None), (None, 1, 1)], "x string, y int, is_fraud int")
    got = profile.rates_by_dimension(df, {"x": F.col("x"), "y": F.col("y")}).collect()
    for d in "xy":
        assert sum(r.share for r in got if r.dimension == d) == pytest.approx(1.0)
    rate = {(r.dimension, r.value): r.fraud_rate for r in got}
    assert rate["x", "a"] == 0.5 and rate["x", "b"] is None and rate["x", None] == 1.0


def test_spread_points(spark):
    rows = [(1, 10.0, 20.0), (2, 10.0, 20.0), (3, 10.0, 20.0), (4, 5.0, 5.0)]
    got = {r.trans_num: r for r in points.spread_points(spark.createDataFrame(rows, "trans_num int, lat double, long double")).collect()}
    for i in range(3):
        assert got[i + 1].lat_adjusted == pytest.approx(10 + 0.001 * math.sin(2 * math.pi * i / 3))
        assert got[i + 1].long_adjusted == pytest.approx(20 + 0.001 * math.cos(2 * math.pi * i / 3))
    assert (got[4].lat_adjusted, got[4].long_adjusted) == (5.0, 5.0)


def test_fills(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", None, None), ("b", 4.0, "y")], "g string, v double, s string")
    assert sorted(r.v for r in cleaning.fill_group_mean(df, "v", "g").collect()) == [1.0, 1.0, 4.0]
    assert sorted(r.v for r in cleaning.fill_mean(df, "v").collect()) == [1.0, 2.5, 4.0]
    zero = cleaning.fill_zero(df).where("s IS NULL").first()
    assert zero.v == 0.0
    assert cleaning.drop_nulls(df, ["s"]).count() == 2


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(float(v), "g") for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double, g string")
    assert {r.bin: r.n for r in profile.histogram(df, "v", 10).collect()} == {0: 9, 9: 1}
    box = profile.box_stats(df, "g", "v").first()
    assert (box.q1, box.median, box.q3, box.low_whisker, box.high_whisker) == (2.25, 4.5, 6.75, 0.0, 8.0)
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r.n) for r in profile.histogram(flat, "v", 5).collect()] == [(0, 2)]


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "a int, b string")
    got = {(r.column_name, r.stat): r.value for r in profile.table_profile(df).collect()}
    assert got["a", "missing"] == 1 and got["a", "mean"] == 1 and got["b", "distinct"] == 2 and ("b", "mean") not in got
    assert profile.duplicate_rows(df).first().n_duplicates == 1


def test_correlations_with_and_without_nulls(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 5.0, 5.0), (4.0, 9.0, 5.0)]
    full = spark.createDataFrame(rows, "a double, b double, c double")
    holed = full.unionByName(spark.createDataFrame([(9.0, None, 5.0)], full.schema))
    for df in (full, holed):
        got = {(r.a, r.b): r.r for r in profile.correlations(df).collect()}
        assert got["a", "b"] == got["b", "a"] == pytest.approx(0.96476382)
        assert got["a", "a"] == pytest.approx(1.0) and got["a", "c"] is None and len(got) == 9


def test_train_risk(spark):
    train = spark.createDataFrame(
        [("m", 1.0, 1.0, "t1", "2020-01-01", 0.1), ("m", 1.0, 1.0, "t2", "2020-01-02", 0.7), ("n", 1.0, 1.0, "t3", "2020-01-01", 0.2)],
        "merchant string, lat double, long double, trans_num string, trans_date_trans_time string, risk double",
    )
    new = spark.createDataFrame([("m", 1.0, 1.0, "x", 0.9), ("m", 2.0, 1.0, "y", 0.9)], "merchant string, lat double, long double, trans_num string, risk double")
    got = {r.trans_num: r.risk for r in with_train_risk(new, train, ["risk"]).collect()}
    assert got == {"x": 0.7, "y": 0.0}


def test_missing_scores_come_last_for_every_k(spark, monkeypatch):
    from ledgerglass.operators import metrics

    rows = [("d", 1, 1, None), ("d", 2, 1, 0.9), ("d", 3, 0, float("nan")), ("d", 4, 1, 0.8), ("d", 5, 0, 0.1)]
    df = spark.createDataFrame(rows, "trans_date string, trans_num long, is_fraud int, predictions double")
    for limit in (1000, 0):
        monkeypatch.setattr(metrics, "MAX_LIMITED_K", limit)
        day = metrics.precision_top_k_by_day(df, 2).first()
        assert (day.n_fraud, day.n_detected, day.precision) == (3, 2, 1.0)
        assert {r.trans_num for r in metrics.detected_top_k(df, 4).collect()} == {2, 4, 1}
    assert {r.trans_num for r in metrics.detected_top_k(df, None).collect()} == {2, 4}


def test_codes_put_nan_last(spark):
    from ledgerglass.operators.encoders import fit_codes

    df = spark.createDataFrame([(1.0,), (float("nan"),), (0.5,), (2.0,), (None,), (0.5,)], "x double")
    got = sorted((r.code, str(r.value)) for r in fit_codes(df, "x").collect())
    assert got == [(0, "0.5"), (1, "1.0"), (2, "2.0"), (3, "nan")]


def test_rows_without_time_have_no_window_either_way(spark):
    from ledgerglass.operators.rolling import card_totals
    from ledgerglass.operators.skew import count_keys, hot_keys

    rows = [(i, 7, f"2020-01-{1 + i % 5:02d} 00:00:{i:02d}" if i % 4 else None, 10.0 + i, 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "trans_num long, cc_num long, t string, amt double, distance double")
    df = df.withColumn("trans_date_trans_time", F.to_timestamp("t")).drop("t")
    plain = card_totals(df, [1, 7])
    hot = hot_keys(count_keys(df, "cc_num"), "cc_num", 0)
    cut = card_totals(df, [1, 7], hot=hot)
    names = sorted(set(plain.columns) & set(cut.columns) - {"trans_date_trans_time"})
    rows_of = lambda d: sorted((tuple(str(v) for v in r) for r in d.select(names).collect()))
    assert rows_of(plain) == rows_of(cut)
    for r in plain.collect():
        assert (r.daily_trans_count is None) == (r.trans_date_trans_time is None) == (r["_n_7"] is None)


def test_first_fraud_of_hot_cards(spark):
    rows = [(i, 1 if i % 3 else None, f"2020-01-{i + 1:02d} 00:00:00", int(i in (4, 7))) for i in range(12)]
    df = spark.createDataFrame(rows, "trans_num int, cc_num int, t string, is_fraud int")
    df = df.withColumn("trans_date_trans_time", F.to_timestamp("t"))
    found = [
        {r.trans_num: str(r.first_fraud_date) for r in profile.with_first_fraud(df, max_rows=most).collect()}
        for most in (0, 10**9)
    ]
    assert found[0] == found[1] and len(found[0]) == 12
    assert found[0][1] == "2020-01-05 00:00:00" and found[0][3] == "None"


def test_quantiles_of_several_columns(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 50.0)], "a int, b double")
    got = {(r.column_name, r.probability): r.quantile for r in running.quantiles_of(df, {"a": (0.5,), "b": (0.0, 0.75)}).collect()}
    assert got == {("a", 0.5): 2.5, ("b", 0.0): 10.0, ("b", 0.75): 40.0}


def test_several_k_from_one_ranking(spark):
    rows = [(d, i, int(i in (1, 4)), float(9 - i)) for d in ("x", "y") for i in range(6)] + [("z", 0, None, None)]
    df = spark.createDataFrame(rows, "trans_date string, trans_num int, is_fraud int, predictions double")
    both = metrics.precision_top_ks(df, (2, 5)).first()
    for k in (2, 5):
        daily = metrics.precision_top_k_by_day(df, k).agg(F.round(F.avg("precision"), 3)).first()[0]
        assert both[f"precision_top_{k}"] == daily
