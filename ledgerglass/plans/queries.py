"""The query catalog: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole tables. Doubles are rounded and dates are printed, so that two
engines show the same values.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerglass.functions import dates, numbers
from ledgerglass.functions.geo import with_distance
from ledgerglass.operators import (
    boosting,
    carried,
    cleaning,
    drift,
    encoders,
    gazetteer,
    metrics,
    models,
    points,
    profile,
    rolling,
    running,
    sketches,
    splits,
)
from ledgerglass.plans import features
from ledgerglass.plans.views import gaz, tx_events, tx_sales
from ledgerglass.schema import feature_columns
from ledgerglass.sources.stage import stage
from ledgerglass.sources.tables import load_summary as summarize_load

TS = "trans_date_trans_time"
WINDOWS = (7, 30, 90)
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _dated(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tx_sales(spark, sf_dir)
        .withColumnRenamed("score", "predictions")
        .withColumn("trans_date", F.to_date(TS))
    )


def _card_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the card features need, written once because means, profile and windows each read it."""
    tx = with_distance(tx_sales(spark, sf_dir))
    return stage(tx.select("trans_num", TS, "cc_num", "city", "amt", "distance"))


# --- load, filter, clean ---------------------------------------------------------------


@query
def load_summary(spark, sf_dir):
    return summarize_load(tx_sales(spark, sf_dir))


@query
def label_split_counts(spark, sf_dir):
    sides = [F.count_if(F.col("is_fraud") == v).alias(f"n{v}") for v in (0, 1)]
    one = tx_sales(spark, sf_dir).agg(*sides)
    return one.select(F.inline(F.array(*[F.struct(F.col(f"n{v}").alias("n"), F.lit(v).alias("is_fraud")) for v in (0, 1)])))


@query
def filter_points(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    return tx.where((F.col("city") == "C7") & (F.col("is_fraud") == 1)).select(
        "trans_num", "merchant", "merch_lat", "merch_long", "city", "state"
    )


@query
def drop_null_subset(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("trans_num", _holed("amt", 13), _holed("is_fraud", 17))
    kept = cleaning.drop_nulls(tx, ("amt", "is_fraud"))
    return kept.select("trans_num", F.col("amt").cast("double").alias("amt"), "is_fraud")


def _holed(column: str, every: int):
    """The column with nulls in it, for the null-handling queries."""
    return F.when(F.col("trans_num") % every != 0, F.col(column)).alias(column)


@query
def fill_with_zero(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("trans_num", _holed("city_pop", 13), _holed("merchant", 17))
    return cleaning.fill_zero(tx)


@query
def fill_with_group_mean(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("trans_num", "city", _holed("amt", 13))
    tx = tx.withColumn("amt", F.col("amt").cast("double"))
    return _rounded(cleaning.fill_group_mean(tx, "amt", "city"))


@query
def fill_with_mean(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("trans_num", _holed("amt", 13))
    return _rounded(cleaning.fill_mean(tx.withColumn("amt", F.col("amt").cast("double")), "amt"))


@query
def preview(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("trans_num", "cc_num", "merchant", F.col("amt").cast("double").alias("amt"))
    return profile.preview(tx, "trans_num", 5)


@query
def card_id_clean(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("cc_num").cast("string"), F.lit(" "))
    return tx_sales(spark, sf_dir).select("trans_num", numbers.clean_identifier(padded).alias("card_id"))


@query
def time_slice(spark, sf_dir):
    tx = profile.time_slice(tx_sales(spark, sf_dir), "1996-01-01 12:00:00", "1996-06-30 12:00:00")
    return tx.select("trans_num", "cc_num", dates.epoch_us(TS).alias("us"))


@query
def event_time_slice(spark, sf_dir):
    tx = profile.time_slice(tx_events(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-12 12:00:00")
    return tx.select("trans_num", "cc_num", dates.epoch_us(TS).alias("us"))


@query
def threshold_class(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    return tx.select(
        "trans_num",
        numbers.to_class("score", 0.5).alias("predicted"),
        numbers.to_class("score", 0.25).alias("predicted_strict"),
    )


# --- card and merchant behaviour ---------------------------------------------------------


@query
def merchant_delayed_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = rolling.merchant_risk(tx_sales(spark, sf_dir), delay=7, windows=(1, 7, 30))
    return _rounded(risk.select("trans_num", *[c for c in risk.columns if c.startswith("merchant_")]))


@query
def event_type_delayed_risk(spark, sf_dir):
    """Five very large merchants over thirty days."""
    risk = rolling.merchant_risk(tx_events(spark, sf_dir), delay=2, windows=(1, 7))
    return _rounded(risk.select("trans_num", *[c for c in risk.columns if c.startswith("merchant_")]))


@query
def card_rolling_amount(spark, sf_dir):
    out = rolling.card_behaviour(_card_rows(spark, sf_dir), WINDOWS)
    kinds = ("sum_amount", "count_amount", "avg_amount", "amount_over_average")
    return _rounded(out.select("trans_num", *[f"{k}_{w}_days" for k in kinds for w in WINDOWS]))


@query
def card_rolling_distance(spark, sf_dir):
    out = rolling.card_behaviour(_card_rows(spark, sf_dir), WINDOWS)
    kinds = ("avg_distance", "distance_over_avg")
    return _rounded(out.select("trans_num", *[f"{k}_{w}_days" for k in kinds for w in WINDOWS]), 4)


@query
def card_gap(spark, sf_dir):
    out = rolling.card_behaviour(_card_rows(spark, sf_dir), (7,))
    return _rounded(out.select("trans_num", "inter_transaction_time_7_days"), 4)


@query
def card_daily_count(spark, sf_dir):
    out = rolling.card_behaviour(_card_rows(spark, sf_dir), (7,))
    return out.select("trans_num", "daily_trans_count")


@query
def carried_windows(spark, sf_dir):
    """Windows of 1999 to 2001, scored year by year from a state that holds the open tails only."""
    tx = stage(with_distance(tx_sales(spark, sf_dir)).select(*carried.COLUMNS))
    year = F.year(TS)
    state, out = carried.begin(tx.where(year < 1999), (7, 30), 7, (7, 30)), None
    for y in (1999, 2000, 2001):
        made, state = carried.advance(state, tx.where(year == y), (7, 30), 7, (7, 30))
        out = made if out is None else out.unionByName(made)
    kinds = ("sum_amount_{}_days", "count_amount_{}_days", "merchant_num_trans_{}_day_window", "merchant_risk_{}_day_window")
    return _rounded(out.select("trans_num", "daily_trans_count", *[k.format(w) for k in kinds for w in (7, 30)]))


@query
def known_risk_enrich(spark, sf_dir):
    """The merchant's newest risk that is at least a week older than the row."""
    tx = tx_sales(spark, sf_dir)
    risks = ["merchant_risk_7_day_window", "merchant_risk_30_day_window"]
    scored = stage(rolling.merchant_risk(tx, 7, (7, 30)).select("trans_num", TS, "merchant", *risks))
    return _rounded(features.with_known_risk(scored, scored, risks, 7, ("merchant",)).select("trans_num", *risks))


@query
def sparsity(spark, sf_dir):
    tx = stage(tx_sales(spark, sf_dir).select("trans_num", TS, "cc_num", "merchant", "amt"))
    dates_in_table, out = rolling.count_dates(tx), tx
    for key, prefix in (("cc_num", "card"), ("merchant", "merchant")):
        out = rolling.with_sparsity(out, key, prefix, rolling.key_profile(tx, key), dates_in_table)
    return _rounded(out.select("trans_num", *[c for c in out.columns if c.endswith("_sparsity")]), 9)


@query
def sparsity_means(spark, sf_dir):
    return _rounded(profile.mean_sparsity(tx_sales(spark, sf_dir)), 9)


@query
def spread_points(spark, sf_dir):
    frauds = tx_sales(spark, sf_dir).where("is_fraud = 1")
    return _rounded(points.spread_points(frauds).select("trans_num", "lat_adjusted", "long_adjusted"), 9)


@query
def spread_all_points(spark, sf_dir):
    """Every transaction, where one place can hold a large part of the table."""
    placed = points.spread_points(tx_sales(spark, sf_dir))
    return _rounded(placed.select("trans_num", "lat_adjusted", "long_adjusted"), 9)


# --- aggregates ----------------------------------------------------------------------------


@query
def key_totals(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    side = lambda k: profile.key_totals(tx, k).select(
        F.lit(k).alias("kind"), F.col(k).cast("string").alias("key"), "n", "total_amount"
    )
    return _rounded(side("cc_num").unionByName(side("merchant")), 2)


@query
def city_means(spark, sf_dir):
    return _rounded(rolling.city_means(with_distance(tx_sales(spark, sf_dir))), 5)


@query
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(tx_sales(spark, sf_dir), ("cc_num", "merchant", "category", "job", "city"))


@query
def daily_fraud_stats(spark, sf_dir):
    return _dated(profile.daily_fraud_stats(tx_sales(spark, sf_dir)), "trans_date")


@query
def daily_fraud_stats_card(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).where("cc_num = 77")
    return _dated(profile.daily_fraud_stats(tx), "trans_date")


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(tx_sales(spark, sf_dir), "job")


@query
def top_cities(spark, sf_dir):
    return profile.top_values(tx_sales(spark, sf_dir), "city", 10)


@query
def top_states(spark, sf_dir):
    top = profile.top_values(tx_sales(spark, sf_dir), "state", 10)
    return top.withColumn("n_scaled", F.col("n") / 10)


@query
def rates_by_dimension(spark, sf_dir):
    tx = gazetteer.categorize(tx_sales(spark, sf_dir), gaz(spark, sf_dir))
    out = profile.rates_by_dimension(
        tx,
        {
            "day_of_week": dates.day_of_week(TS),
            "hour": dates.hour_of_day(TS),
            "gender": F.col("gender"),
            "job_category": F.col("job_category"),
            "category": F.col("category"),
        },
    )
    return _rounded(out, 9).orderBy("dimension", F.desc("fraud_rate"), "value")


@query
def rate_by_age_group(spark, sf_dir):
    age = dates.age_in_years(TS, "dob")
    group = numbers.bin_right_closed(age, numbers.AGE_BOUNDS, numbers.AGE_NAMES)
    out = profile.rates_by_dimension(tx_sales(spark, sf_dir), {"age_group": group})
    return _rounded(out.select(F.col("value").alias("age_group"), "n", "share", "fraud_rate"), 9)


@query
def first_fraud(spark, sf_dir):
    first = profile.with_first_fraud(tx_sales(spark, sf_dir))
    return first.select("trans_num", dates.epoch_us("first_fraud_date").alias("first_fraud_us"))


@query
def active_after_fraud(spark, sf_dir):
    return _rounded(profile.active_after_fraud(tx_sales(spark, sf_dir)), 9)


@query
def class_means(spark, sf_dir):
    tx = with_distance(tx_sales(spark, sf_dir)).withColumn("amount", F.col("amt").cast("double"))
    return _rounded(profile.class_means(tx, ("amount", "distance", "score")), 4)


@query
def city_size(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    bounds = features.fit_city_bounds(tx)
    return tx.select(
        "trans_num",
        "city_pop",
        numbers.bin_right_closed("city_pop", bounds, numbers.CITY_CODES).alias("city_size"),
        numbers.bin_right_closed("city_pop", numbers.CITY_BOUNDS, numbers.CITY_CODES).alias("fixed_size"),
    )


@query
def exact_quantiles(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("city_pop", "amt")
    wanted = {"city_pop": (0.85, 0.99), "amt": (0.25, 0.5, 0.75, 0.99)}
    return _rounded(running.quantiles_of(tx, wanted))


@query
def imbalance(spark, sf_dir):
    return _rounded(profile.imbalance(tx_sales(spark, sf_dir)))


@query
def positive_weights(spark, sf_dir):
    return tx_sales(spark, sf_dir).select("trans_num", numbers.positive_weight("is_fraud", 50).alias("weight"))


@query
def loss(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).withColumn("predicted", numbers.to_class("score"))
    return _rounded(profile.monetary_loss(tx), 2)


@query
def corr_matrix(spark, sf_dir):
    columns = ("amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud")
    return _rounded(profile.correlations(tx_sales(spark, sf_dir), columns))


@query
def corr_matrix_with_nulls(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select("lat", "city_pop", "is_fraud", "cc_num", _holed("amt", 13))
    return _rounded(profile.correlations(tx))


@query
def table_profile(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select(
        "cc_num", "merchant", "category", "gender", "city_pop", _holed("amt", 13), "is_fraud"
    )
    return _rounded(profile.table_profile(tx), 4)


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(tx_sales(spark, sf_dir).select("cc_num", "merchant", "category"))


@query
def histogram(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).withColumn("scale_amt", numbers.log_scale("amt"))
    return _rounded(profile.histogram(tx, "scale_amt", 30))


@query
def box_stats(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select(
        numbers.bin_right_closed(dates.age_in_years(TS, "dob"), numbers.AGE_BOUNDS, numbers.AGE_NAMES).alias("age_group"),
        numbers.log_scale("amt").alias("scale_amt"),
    )
    return _rounded(profile.box_stats(tx, "age_group", "scale_amt"))


@query
def density2d(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select(
        dates.age_in_years(TS, "dob").alias("age"), numbers.log_scale("amt").alias("scale_amt")
    )
    return profile.density2d(tx, "age", "scale_amt", 20, 20)


@query
def hex_density(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select(dates.age_in_years(TS, "dob").alias("age"), numbers.log_scale("amt").alias("scale_amt"))
    return _rounded(profile.hex_density(tx, "age", "scale_amt", 20))


@query
def frequent_values(spark, sf_dir):
    """Values that more than a thousandth of the rows hold, with their exact counts."""
    tx = tx_sales(spark, sf_dir).select("cc_num", "merchant", "category", "job", "city", "state")
    return profile.frequent_values(tx, tx.columns, 0.001)


@query
def sketched_quantiles(spark, sf_dir):
    """Amounts sketched per day and category, merged to quantiles per category, each within 1 %."""
    tx = tx_sales(spark, sf_dir).select(F.to_date(TS).alias("day"), "category", "amt")
    daily = stage(sketches.quantile_sketch(tx, "amt", ["day", "category"]))
    merged = stage(sketches.merge_quantiles(daily, ["category"]))
    return _rounded(sketches.estimate_quantiles(merged, (0.25, 0.5, 0.9, 0.99), ["category"]), 4)


@query
def sketched_cards(spark, sf_dir):
    """Cards sketched per day, merged to estimates per month."""
    tx = tx_sales(spark, sf_dir).select(F.to_date(TS).alias("day"), "cc_num")
    daily = stage(sketches.distinct_sketch(tx, "cc_num", ["day"]))
    by_month = daily.withColumn("month", F.trunc("day", "month"))
    return _dated(_rounded(sketches.estimate_distinct(sketches.merge_distinct(by_month, ["month"]), ["month"]), 4), "month")


# --- row-local features ---------------------------------------------------------------------


@query
def time_flags(spark, sf_dir):
    tx = dates.with_time_features(tx_sales(spark, sf_dir))
    return _dated(
        tx.select(
            "trans_num",
            "trans_date",
            "transaction_hour",
            "transaction_day_of_week",
            "is_holiday",
            "is_weekend",
            "is_high_risk_hour",
        ),
        "trans_date",
    )


@query
def age_groups(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).withColumn("age", dates.age_in_years(TS, "dob"))
    return tx.select(
        "trans_num", "age", numbers.bin_right_closed("age", numbers.AGE_BOUNDS, numbers.AGE_CODES).alias("age_group")
    )


@query
def log_scale(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    return _rounded(
        tx.select(
            "trans_num",
            numbers.log_scale("amt").alias("scale_amt"),
            numbers.log_scale("city_pop").alias("city_pop_scale"),
        )
    )


@query
def geodesic(spark, sf_dir):
    return _rounded(with_distance(tx_sales(spark, sf_dir)).select("trans_num", "distance"), 5)


@query
def months(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    return _dated(tx.select(dates.month_of(TS).alias("month")).distinct(), "month")


# --- encoders and job categories ---------------------------------------------------------------


@query
def label_encode(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    coded = encoders.encode_label(tx, "job", encoders.fit_codes(tx, "job"), "job_label")
    return coded.select("trans_num", "job_label")


@query
def ordinal_encode(spark, sf_dir):
    """Codes fitted before February 1995 and applied to everything; merchants of later years may be unseen."""
    tx = tx_sales(spark, sf_dir)
    fitted = encoders.fit_codes(tx.where(F.col(TS) < "1995-02-01"), "merchant")
    coded = encoders.encode_ordinal(tx, "merchant", fitted, "merchant_encoded")
    return coded.select("trans_num", "merchant_encoded")


@query
def encoder_mapping(spark, sf_dir):
    return encoders.fit_codes(tx_sales(spark, sf_dir), "merchant")


@query
def onehot(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    coded = encoders.encode_onehot(tx, "gender", encoders.fit_onehot(tx, "gender"))
    coded = encoders.encode_onehot(coded, "category", encoders.fit_onehot(tx, "category"))
    return coded.select("trans_num", *[c for c in coded.columns if c.startswith(("gender_", "category_"))])


@query
def categorize(spark, sf_dir):
    tx = gazetteer.categorize(tx_sales(spark, sf_dir), gaz(spark, sf_dir))
    return tx.select("trans_num", "job_category")


@query
def unseen_values(spark, sf_dir):
    return gazetteer.unseen_values(tx_sales(spark, sf_dir), gaz(spark, sf_dir))


@query
def fuzzy_match(spark, sf_dir):
    listed = gaz(spark, sf_dir)
    unseen = gazetteer.unseen_values(tx_sales(spark, sf_dir), listed)
    return _rounded(gazetteer.nearest_titles(unseen, listed, 70.0))


@query
def updated_gazetteer(spark, sf_dir):
    listed = gaz(spark, sf_dir)
    return gazetteer.update_gazetteer(listed, tx_sales(spark, sf_dir)).select("category", "job")


@query
def train_risk_enrich(spark, sf_dir):
    tx = tx_sales(spark, sf_dir)
    risks = ["merchant_risk_7_day_window", "merchant_risk_30_day_window"]
    train = rolling.merchant_risk(tx.where(F.col(TS) < "1999-01-01"), 7, (7, 30))
    test = tx.where(F.col(TS) >= "1999-01-01").withColumns({r: F.lit(-1.0) for r in risks})
    return _rounded(features.with_train_risk(test, train, risks).select("trans_num", *risks))


# --- splits, scaling, metrics, drift -----------------------------------------------------------


@query
def split_manifest(spark, sf_dir):
    return splits.split_manifest(tx_sales(spark, sf_dir).select(TS))


@query
def split_rows(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).select(TS)
    return splits.split_summary(tx, splits.split_manifest(tx))


@query
def standardize(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).withColumn("amount", F.col("amt").cast("double"))
    scaled = models.standardize(tx, models.fit_scaler(tx, ("amount", "city_pop")))
    return _rounded(scaled.select("trans_num", "amount", "city_pop"))


@query
def roc_auc(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(_scored(spark, sf_dir)).select("auc_roc"), 9)


@query
def avg_precision(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(_scored(spark, sf_dir)).select("average_precision"), 9)


@query
def pr_auc(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(_scored(spark, sf_dir)).select("pr_auc"), 9)


@query
def f1(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(_scored(spark, sf_dir)).select("f1_score"), 9)


@query
def precision_at_k_day(spark, sf_dir):
    return _dated(_rounded(metrics.precision_top_k_by_day(_scored(spark, sf_dir), 5), 9), "trans_date")


@query
def precision_at_fraud_count_day(spark, sf_dir):
    return _dated(_rounded(metrics.precision_top_k_by_day(_scored(spark, sf_dir), None), 9), "trans_date")


@query
def detected_at_k(spark, sf_dir):
    return _dated(metrics.detected_top_k(_scored(spark, sf_dir), 5), "trans_date")


@query
def detected_at_fraud_count(spark, sf_dir):
    return _dated(metrics.detected_top_k(_scored(spark, sf_dir), None), "trans_date")


@query
def precision_at_k_mean(spark, sf_dir):
    return metrics.precision_top_k(_scored(spark, sf_dir), 5)


@query
def metric_table(spark, sf_dir):
    return metrics.metric_table(_scored(spark, sf_dir), top_k=(5, 50))


@query
def confusion(spark, sf_dir):
    tx = tx_sales(spark, sf_dir).withColumn("predicted", numbers.to_class("score"))
    return metrics.confusion(tx)


@query
def naive_baseline(spark, sf_dir):
    """Everything predicted honest."""
    tx = _scored(spark, sf_dir).withColumn("predictions", F.lit(0.0))
    return _rounded(metrics.ranking_metrics(tx), 9)


def _folds(spark, sf_dir):
    """Metrics of each year as a fold, even transactions as validation and odd ones as training."""
    tx = _scored(spark, sf_dir).withColumns(
        {"fold": F.year(TS), "dataset": F.when(F.col("trans_num") % 2 == 0, "val").otherwise("train")}
    )
    wide = metrics.ranking_metrics(tx, groups=("fold", "dataset"))
    return wide.unpivot(["fold", "dataset"], ["auc_roc", "average_precision", "f1_score"], "metric", "value")


@query
def fold_metrics(spark, sf_dir):
    return _rounded(_folds(spark, sf_dir), 9)


@query
def fold_summary(spark, sf_dir):
    return _rounded(metrics.side_by_side(metrics.fold_summary(_folds(spark, sf_dir))), 9)


@query
def sweep_means(spark, sf_dir):
    """Recall and precision of several thresholds per year, then their mean and deviation by threshold."""
    tx = _scored(spark, sf_dir).withColumns({"split_id": F.year(TS), "dataset": F.lit("val")})
    runs = None
    for threshold in (0.3, 0.5, 0.7):
        hit = F.sum(numbers.to_class("predictions", threshold) * F.col("is_fraud"))
        one = tx.groupBy("split_id", "dataset").agg(
            numbers.ratio(hit, F.sum("is_fraud")).alias("recall"),
            numbers.ratio(hit, F.sum(numbers.to_class("predictions", threshold))).alias("precision"),
        )
        long = one.unpivot(["split_id", "dataset"], ["recall", "precision"], "metric", "value")
        long = long.withColumn("summary", F.lit(str(threshold)))
        runs = long if runs is None else runs.unionByName(long)
    return _rounded(models.evaluation_summary(runs), 9)


@query
def ks_drift(spark, sf_dir):
    return _dated(_rounded(drift.ks_drift(tx_sales(spark, sf_dir)), 9), "month")


@query
def kl_drift(spark, sf_dir):
    return _dated(_rounded(drift.kl_drift(tx_sales(spark, sf_dir)), 8), "month", "other")


# --- models ------------------------------------------------------------------------------------

MODEL_FEATURES = (
    "amt",
    "city_pop",
    "distance",
    "transaction_hour",
    "transaction_day_of_week",
    "is_weekend",
    "age",
    "merchant_num_trans_30_day_window",
    "merchant_risk_30_day_window",
)


def _model_rows(spark, sf_dir):
    tx = dates.with_time_features(with_distance(tx_sales(spark, sf_dir)))
    tx = tx.withColumn("age", dates.age_in_years(TS, "dob"))
    rows = rolling.merchant_risk(tx, 7, (30,)).select("trans_num", TS, "trans_date", "is_fraud", *MODEL_FEATURES)
    return stage(rows)  # every fit reads the rows many times


def _all_inputs(spark, sf_dir):
    """The rows of the training build and the names of its 68 model inputs."""
    tx, listed = stage(tx_sales(spark, sf_dir).drop("score")), gaz(spark, sf_dir)
    rows = stage(features.build_features(tx, listed, features.fit(tx, listed)).withColumn("trans_date", F.to_date(TS)))
    return rows, feature_columns(rows)


@query
def gbt_scores(spark, sf_dir):
    """100 trees over all 68 inputs, fitted before 1999 and applied from February on."""
    rows, inputs = _all_inputs(spark, sf_dir)
    settings = boosting.Settings(trees=100, depth=3, pos_weight=50.0, l2=0.1)
    model = boosting.fit(rows.where(F.col(TS) < "1999-01-01"), inputs, settings)
    return model.predict(rows.where(F.col(TS) >= "1999-02-01")).select("trans_num", "is_fraud", "predictions")


@query
def rf_importance(spark, sf_dir):
    return models.feature_importance(_model_rows(spark, sf_dir), MODEL_FEATURES, 5)


def _means(values):
    """Mean and deviation over the splits, and the number of splits, per setting."""
    return values.groupBy("summary", "dataset", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("n_splits")
    )


@query
def rolling_eval(spark, sf_dir):
    """100 trees on all 68 inputs for every 90-day point of the table."""
    rows, inputs = _all_inputs(spark, sf_dir)
    settings = {"default": boosting.Settings(trees=100, depth=3, pos_weight=50.0, l2=0.1)}
    return _means(boosting.evaluate_splits(rows, splits.split_manifest(rows), settings, inputs, (100,), bins=32))


@query
def param_sweep(spark, sf_dir):
    """Five L2 values and five positive weights on all 68 inputs, for every 360-day point."""
    rows, inputs = _all_inputs(spark, sf_dir)
    base = boosting.Settings(trees=20, depth=3, l2=0.1)
    settings = {f"l2 {x:g}": replace(base, l2=x, pos_weight=50.0) for x in (0.01, 0.1, 1.0, 10.0, 100.0)}
    settings |= {f"weight {x:g}": replace(base, pos_weight=x) for x in (1.0, 10.0, 50.0, 100.0, 200.0)}
    manifest = splits.split_manifest(rows, freq=360, rolling_window=360)
    return _means(boosting.evaluate_splits(rows, manifest, settings, inputs, (100,), bins=32))


@query
def grid_search(spark, sf_dir):
    """Four positive weights around the imbalance, three folds."""
    rows, inputs = _all_inputs(spark, sf_dir)
    ratio = profile.imbalance(rows).first().imbalance_ratio
    base = boosting.Settings(trees=20, depth=4, l2=0.1)
    settings = {f"{w:.3f}": replace(base, pos_weight=w) for w in (ratio - 2, ratio, ratio + 2, 2 * ratio)}
    found = boosting.cross_validate(rows, settings, inputs, bins=32)
    return found.select(F.col("summary").cast("double").alias("pos_weight"), "f1_score")


# --- whole build -----------------------------------------------------------------------------


def _inputs(built: DataFrame) -> DataFrame:
    """Every model input beside the row's id; distances and gaps to four digits."""
    built = built.drop("score").withColumn("amt", F.col("amt").cast("double"))
    digits = {c: 4 if "distance" in c or c.startswith("inter_") else 6 for c, t in built.dtypes if t == "double"}
    names = ["trans_num", *feature_columns(built)]
    return built.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in names])


@query
def feature_table(spark, sf_dir):
    """All inputs of the training build."""
    tx, listed = stage(tx_sales(spark, sf_dir)), gaz(spark, sf_dir)
    return _inputs(features.build_features(tx, listed, features.fit(tx, listed)))


@query
def serving_table(spark, sf_dir):
    """All inputs of transactions from 1998 on, with codes, bins and merchant risks of the earlier ones."""
    tx, listed = stage(tx_sales(spark, sf_dir)), gaz(spark, sf_dir)
    known, new = tx.where(F.col(TS) < "1998-01-01"), tx.where(F.col(TS) >= "1998-01-01")
    fitted = features.fit(known, listed)
    train = features.build_features(known, listed, fitted)
    return _inputs(features.build_serving_features(new, train, listed, fitted))
