"""Feature builds, sources, models and the catalog on a generated table."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerglass.operators import models, splits
from ledgerglass.plans import features
from ledgerglass.plans.oracle import ORACLE
from ledgerglass.plans.queries import QUERIES
from ledgerglass.schema import DAY_US, TRANSACTIONS, feature_columns
from ledgerglass.sources import tables
from ledgerglass.sources.stage import stage, stage_dir
from ledgerglass.streaming import scoring

TS = "trans_date_trans_time"


def _transactions(spark, n=400, seed=8, start=18262):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        card = rnd.randrange(12)
        us = (start + rnd.randrange(240)) * DAY_US + rnd.randrange(86400) * 1_000_000
        amount = rnd.randrange(100, 90000)
        rows.append(
            (
                us, card, f"m{rnd.randrange(6)}", f"cat{rnd.randrange(3)}", Decimal(amount) / 100, "F" if card % 2 else "M",
                f"c{card % 3}", 30.0 + card, -90.0 - card, 1000 * (card + 1), f"job {card % 4}", f"19{50 + card}-05-06",
                f"t{i:04d}", 30.5 + card, -90.2 - card, int(amount > 70000),
            )
        )
    names = "us long, cc_num long, merchant string, category string, amt decimal(18,2), gender string, city string, lat double, long double, city_pop long, job string, dob string, trans_num string, merch_lat double, merch_long double, is_fraud int"
    return spark.createDataFrame(rows, names).withColumns({TS: F.timestamp_micros("us"), "dob": F.to_date("dob")}).drop("us")


def _gaz(spark):
    rows = [("A", 0, "job 0", 0), ("A", 0, "job 1", 1), ("B", 1, "job 2", 0)]
    return spark.createDataFrame(rows, "category string, cat_ord int, job string, job_ord int")


def test_feature_build_has_all_inputs(spark, tmp_path):
    df, gaz = stage(_transactions(spark)), _gaz(spark)
    fitted = features.fit(df, gaz)
    built = stage(features.build_features(df, gaz, fitted))
    assert built.count() == 400
    inputs = feature_columns(built)
    assert len(inputs) == 68
    assert {"gender_M", "job_encoded", "distance", "inter_transaction_time_180_days", "merchant_risk_90_day_window"} <= set(inputs)
    assert built.select([F.count_if(F.col(c).isNull()).alias(c) for c in inputs]).first() == tuple([0] * len(inputs))

    # fitted tables survive a round trip and give the same features on new rows
    fitted.save(spark, str(tmp_path / "fitted"))
    again = features.Fitted.load(spark, str(tmp_path / "fitted"))
    assert again.genders == fitted.genders and again.city_bounds == fitted.city_bounds
    new = stage(_transactions(spark, 60, seed=9, start=18502))
    served = features.build_serving_features(new, built, gaz, again, (1, 7))
    rows = served.collect()
    assert len(rows) == 60
    newest = {}
    for r in built.orderBy(TS, "trans_num").collect():
        newest[r.merchant, r.lat, r.long] = r.merchant_risk_7_day_window
    assert all(r.merchant_risk_7_day_window == newest.get((r.merchant, r.lat, r.long), 0.0) for r in rows)


def test_hot_keys_give_the_same_features(spark):
    df, gaz = stage(_transactions(spark, 150)), _gaz(spark)
    fitted = features.fit(df, gaz)
    plain = features.build_features(df, gaz, fitted, (7, 30)).orderBy("trans_num").collect()
    # merchants above and cards around the limit
    split = features.build_features(df, gaz, fitted, (7, 30), max_rows=13).orderBy("trans_num").collect()
    for a, b in zip(plain, split, strict=True):
        for name, value in a.asDict().items():
            assert b[name] == (pytest.approx(value) if isinstance(value, float) else value), name


def test_row_order_does_not_matter(spark):
    df, gaz = stage(_transactions(spark, 120)), _gaz(spark)
    fitted = features.fit(df, gaz)
    one = features.build_features(df, gaz, fitted, (7,)).orderBy("trans_num").collect()
    two = features.build_features(df.orderBy(F.rand(1)), gaz, fitted, (7,)).orderBy("trans_num").collect()
    for a, b in zip(one, two):
        for x, y in zip(a, b):
            assert x == (pytest.approx(y) if isinstance(y, float) else y)


def test_csv_and_parquet_sources(spark, tmp_path):
    head = ",".join(["", *TRANSACTIONS.fieldNames()])
    good = '0,2020-01-02 03:04:05,12,m,c,1.25,a,b,F,"s, 1",city,ST,01234,1.5,2.5,99,j,1970-01-02,t1,5,1.0,2.0,1'
    bad = "1,never,12,m,c,x,a,b,F,s,city,ST,01234,1.5,2.5,99,j,yesterday,t2,5,1.0,2.0,0"
    (tmp_path / "tx.csv").write_text("\n".join([head, good, bad]))
    df = tables.read_transactions(spark, str(tmp_path / "tx.csv"))
    assert df.schema.fieldNames() == TRANSACTIONS.fieldNames()
    first, second = df.orderBy("trans_num").collect()
    assert (first.amt, first.zip, first.street, str(first.dob)) == (Decimal("1.25"), "01234", "s, 1", "1970-01-02")
    assert (second.trans_date_trans_time, second.amt, second.dob) == (None, None, None)
    assert tuple(tables.load_summary(df).first()) == (2, 1)
    (tmp_path / "short.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="cc_num"):
        tables.read_transactions(spark, str(tmp_path / "short.csv"))

    tables.write_features(df.where("amt IS NOT NULL"), str(tmp_path / "f"))
    back = tables.read_features(spark, str(tmp_path / "f"))
    assert back.count() == 1 and "month=2020-01" in [p.name for p in (tmp_path / "f").iterdir()]
    tables.write_features_csv(df.select("trans_num", "amt"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["trans_num", "amt"]


def test_stage_uses_the_shared_folder(spark, tmp_path):
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert stage_dir(spark) == (old or stage_dir(spark))
    assert sorted(r.id for r in stage(spark.range(5)).collect()) == list(range(5))


@pytest.fixture(scope="module")
def separable(spark):
    df = spark.range(600).select(
        F.col("id").alias("trans_num"),
        F.timestamp_micros(F.col("id") * (DAY_US // 2)).alias(TS),
        F.to_date(F.timestamp_micros(F.col("id") * (DAY_US // 2))).alias("trans_date"),
        (F.col("id") * 7919 % 100).cast("double").alias("a"),
        (F.col("id") * 31 % 17).cast("double").alias("b"),
        F.when(F.col("id") * 7919 % 100 >= 85, 1).otherwise(0).alias("is_fraud"),
    )
    return stage(df)


def test_fit_predict_save(spark, separable, tmp_path):
    fit = lambda path=None: models.fit_model(
        models.boosted_trees(trees=4, depth=2), separable, ["a", "b"], pos_weight=5.0, save_path=path
    )
    scored = models.predict(fit(str(tmp_path / "model")), separable, ["a", "b"]).orderBy("trans_num").collect()
    assert all(0 <= r.predictions <= 1 for r in scored)
    assert min(r.predictions for r in scored if r.is_fraud) > max(r.predictions for r in scored if not r.is_fraud)
    loaded = models.predict(models.load_model(str(tmp_path / "model")), separable, ["a", "b"]).orderBy("trans_num").collect()
    assert loaded == scored
    assert models.predict(fit(), separable, ["a", "b"]).orderBy("trans_num").collect() == scored
    with pytest.raises(ValueError, match="zz"):
        models.fit_model(models.boosted_trees(), separable, ["zz"])
    with pytest.raises(ValueError, match="label"):
        models.fit_model(models.boosted_trees(), separable, ["a"], label="label")


def test_scaler(spark, separable):
    flat = separable.withColumn("c", F.lit(4.0))
    scaled = models.standardize(flat, models.fit_scaler(flat, ["a", "c"]))
    got = scaled.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s"), F.max("c").alias("c")).first()
    assert got.m == pytest.approx(0, abs=1e-9) and got.s == pytest.approx(1) and got.c == 0


def test_importance(spark, separable):
    got = models.feature_importance(separable, ["a", "b"], 1, trees=10).collect()
    assert [r.feature for r in got] == ["a"] and got[0].importance > 0.5


def test_rolling_evaluation_and_sweep(spark, separable):
    manifest = splits.split_manifest(separable, freq=90, rolling_window=90, gap=10, val_duration=60)
    usable = manifest.where("reason IS NULL").count()
    assert usable >= 1
    settings = {"w=1": (models.boosted_trees(trees=2, depth=2), 1.0), "w=9": (models.boosted_trees(trees=2, depth=2), 9.0)}
    folds = models.sweep(separable, manifest, settings, ["a", "b"], (2,))
    assert folds.count() == usable * 2 * 2 * 4
    summary = {(r.summary, r.dataset, r.metric): r["mean"] for r in models.evaluation_summary(folds).collect()}
    assert summary["w=1", "val", "auc_roc"] > 0.9 and len(summary) == 16


def test_grid_search_and_folds(spark, separable):
    folded = models.with_folds(separable, 3, "is_fraud", "trans_num").groupBy("is_fraud", "_fold").count().collect()
    sizes = {label: sorted(r["count"] for r in folded if r.is_fraud == label) for label in (0, 1)}
    assert all(len(s) == 3 and max(s) - min(s) <= 1 for s in sizes.values())
    got = models.grid_search(separable, models.boosted_trees(trees=2, depth=2), ["a", "b"], (1.0, 6.0)).collect()
    assert [r.pos_weight for r in got] == [1.0, 6.0] and all(r.f1_score > 0.9 for r in got)


def test_stream_scores_match_the_batch(spark, tmp_path):
    df, gaz = stage(_transactions(spark, 80)), _gaz(spark)
    fitted = features.fit(df, gaz)
    inputs = ["amt", "age", "distance", "transaction_hour"]
    local = features.local_features(df, gaz, fitted)
    model = models.fit_model(models.boosted_trees(trees=2, depth=2), local, inputs)
    df.write.parquet(str(tmp_path / "in"))
    stream = scoring.score_stream(scoring.read_stream(spark, str(tmp_path / "in"), df.schema), gaz, fitted, model, inputs)
    q = (
        stream.select("trans_num", "predictions", "predicted")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("trans_num").collect()
    want = scoring.score(local, model, inputs).select("trans_num", "predictions", "predicted").orderBy("trans_num").collect()
    assert got == want and len(got) == 80


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"gbt_scores", "rf_importance", "rolling_eval", "param_sweep", "grid_search"}


def test_forest_deals_its_rows(spark, separable, monkeypatch):
    """A task reads a bounded number of rows, whatever the files it would read otherwise."""
    seen, fit = [], models.fit_model
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(models, "fit_model", lambda c, df, *a: seen.append(df.rdd.getNumPartitions()) or fit(c, df, *a))
    models.feature_importance(separable.coalesce(1), ["a", "b"], 1, trees=5)
    assert seen == [6]


def test_shuffles_carry_raw_rows(spark):
    """Merchants' windows come below the cards', row-local features above both, and training risks join rows that are not built yet."""
    df, gaz = stage(_transactions(spark)), _gaz(spark)
    fitted = features.fit(df, gaz)
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    built = features.build_features(df, gaz, fitted, (1, 7))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    plan = lambda d: [x.strip(" :+-") for x in d._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    lines = plan(built)
    windows = [i for i, x in enumerate(lines) if x.startswith("Window ")]
    assert "[merchant#" in lines[windows[-1]] and "[merchant#" not in lines[windows[0]]
    assert not any("age_group" in x or "job_encoded" in x for x in lines[windows[0] :])
    served = features.build_serving_features(df, stage(built), gaz, fitted, (1, 7))
    lines = plan(served)
    joined = [i for i, x in enumerate(lines) if x.startswith("Join ") and "_lat#" in x]
    assert joined and joined[0] > max(i for i, x in enumerate(lines) if x.startswith("Window "))
    assert served.columns[-2:] == ["merchant_risk_1_day_window", "merchant_risk_7_day_window"] and not any(c.startswith("_") for c in served.columns)
