"""Ranking and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerglass.functions.numbers import ratio, round_half_even
from ledgerglass.operators.running import rank_within, running_totals
from ledgerglass.operators.skew import join_salted
from ledgerglass.sources.stage import stage


def score_curve(
    df: DataFrame, label: str = "is_fraud", score: str = "predictions", groups: Sequence[str] = ()
) -> DataFrame:
    """Per distinct score: rows (_n), positives (_p) and both counts above that score.

    Missing scores, null or NaN, are one score below all others, as in the ranking for top-k.
    """
    known = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    counts = (
        df.groupBy(*groups, F.coalesce(-known, F.lit(float("nan"))).alias("_down"))
        .agg(F.count("*").alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_p"))
    )
    return running_totals(
        counts, groups, "_down", {"_n_above": ("sum", "_n"), "_p_above": ("sum", "_p")}
    )


def ranking_metrics(
    df: DataFrame, label: str = "is_fraud", score: str = "predictions", groups: Sequence[str] = ()
) -> DataFrame:
    """auc_roc (ties count half), average_precision (step sum), pr_auc (trapezoids) and
    f1_score (of the score rounded half to even), all from one pass over the curve."""
    curve = score_curve(df, label, score, groups)
    n, p, n_up, p_up = (F.col(c).cast("double") for c in ("_n", "_p", "_n_above", "_p_above"))
    precision = (p_up + p) / (n_up + n)
    before = F.coalesce(F.try_divide(p_up, n_up), F.lit(1.0))
    flagged = round_half_even(F.nanvl(-F.col("_down"), F.lit(0.0))) == 1
    total_p, total_n = F.sum(p), F.sum(n)
    tp = F.coalesce(F.sum(F.when(flagged, p)), F.lit(0.0))
    alarms = F.coalesce(F.sum(F.when(flagged, n)), F.lit(0.0))
    return curve.groupBy(*groups).agg(
        F.try_divide(F.sum((n - p) * (p_up + p / 2)), total_p * (total_n - total_p)).alias("auc_roc"),
        F.try_divide(F.sum(p * precision), total_p).alias("average_precision"),
        F.try_divide(F.sum(p * (precision + before) / 2), total_p).alias("pr_auc"),
        F.coalesce(F.try_divide(2 * tp, alarms + total_p), F.lit(0.0)).alias("f1_score"),
    )


# Spark keeps only the first k rows per partition before the shuffle for k up to this (its default)
MAX_LIMITED_K = 1000


def _top_rows(
    df: DataFrame, keys: Sequence[str], k: int | None, row_id: str, score: str, own: DataFrame | None = None
) -> DataFrame:
    """The k highest scores per group, equal ones by id, with ``_rank`` from 1; with k = None as many as ``own.n_fraud``.

    Missing scores (null or NaN) come after all others. A large or per-group k ranks by ranges, so that
    a group is never sorted in one task; the order is the same either way.
    """
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    lowest_first = F.when(known, -F.col(score))
    if k is not None and k <= MAX_LIMITED_K:
        order = W.partitionBy(*keys).orderBy(F.asc_nulls_last(lowest_first), row_id)
        return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    place = F.struct((~known).alias("none"), lowest_first.alias("s"), F.col(row_id).alias("i"))
    ranked = rank_within(df, keys, place, "_rank").withColumn("_rank", F.col("_rank") + 1)
    if k is not None:
        return ranked.where(F.col("_rank") <= k)
    named = {c: f"_own_{c}" for c in keys}
    joined = join_salted(ranked, own.drop("n_rows").withColumnsRenamed(named), named, counts=own)
    return joined.where(F.col("_rank") <= F.col("n_fraud"))


def precision_top_k_by_day(
    df: DataFrame,
    k: int | None = 100,
    date: str = "trans_date",
    row_id: str = "trans_num",
    label: str = "is_fraud",
    score: str = "predictions",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Per day (and group): frauds, frauds among the k highest scores, and their share of k.

    With k = None each day uses its own number of frauds; a day without any has no precision.
    """
    keys = [*groups, date]
    total = F.sum(F.col(label).cast("bigint"))
    own = stage(df.groupBy(*keys).agg(total.alias("n_fraud"), F.count("*").alias("n_rows")))
    frauds = own.drop("n_rows")
    top = _top_rows(df.select(*keys, row_id, label, score), keys, k, row_id, score, own)
    hits = top.groupBy(*keys).agg(total.alias("n_detected"))
    share = ratio("n_detected", "n_fraud") if k is None else F.col("n_detected") / F.lit(k)
    return (
        frauds.join(hits, keys, "left")
        .withColumn("n_detected", F.coalesce("n_detected", F.lit(0)).cast("bigint"))
        .withColumn("precision", share)
    )


def detected_top_k(
    df: DataFrame,
    k: int | None = 100,
    date: str = "trans_date",
    row_id: str = "trans_num",
    label: str = "is_fraud",
    score: str = "predictions",
) -> DataFrame:
    """The frauds among the k highest scores of each day, one row each.

    With k = None each day uses its own number of frauds.
    """
    own = None
    if k is None:
        own = stage(df.groupBy(date).agg(F.sum(F.col(label).cast("bigint")).alias("n_fraud"), F.count("*").alias("n_rows")))
    top = _top_rows(df.select(date, row_id, label, score), [date], k, row_id, score, own)
    return top.where(F.col(label) == 1).select(date, row_id)


def precision_top_ks(
    df: DataFrame,
    top_k: Sequence[int],
    groups: Sequence[str] = (),
    date: str = "trans_date",
    row_id: str = "trans_num",
    label: str = "is_fraud",
    score: str = "predictions",
) -> DataFrame:
    """Mean over the days of the precision among the k highest scores, to three digits, a column for each k.

    Rows are ranked once, for the largest k; each day has a row among them.
    """
    keys = [*groups, date]
    top = _top_rows(df.select(*keys, row_id, label, score), keys, max(top_k), row_id, score)
    hits = {k: F.sum(F.when(F.col("_rank") <= k, F.col(label).cast("bigint"))) for k in top_k}
    daily = top.groupBy(*keys).agg(*[(F.coalesce(n, F.lit(0)) / F.lit(k)).alias(f"_p{k}") for k, n in hits.items()])
    return daily.groupBy(*groups).agg(*[round_half_even(F.avg(f"_p{k}"), 3).alias(f"precision_top_{k}") for k in hits])


def precision_top_k(df: DataFrame, k: int = 100, groups: Sequence[str] = (), **columns: str) -> DataFrame:
    """Mean over the days of the precision among the k highest scores, to three digits."""
    return precision_top_ks(df, (k,), groups, **columns)


def metrics_long(
    df: DataFrame,
    label: str = "is_fraud",
    score: str = "predictions",
    top_k: Sequence[int] = (50,),
    groups: Sequence[str] = (),
) -> DataFrame:
    """(groups, metric, value) for auc_roc, average_precision, f1_score and precision_top_{k}."""
    names = ["auc_roc", "average_precision", "f1_score"]
    long = ranking_metrics(df, label, score, groups).unpivot(list(groups), names, "metric", "value")
    if not top_k:
        return long
    tops = precision_top_ks(df, top_k, groups, label=label, score=score)
    return long.unionByName(tops.unpivot(list(groups), [f"precision_top_{k}" for k in dict.fromkeys(top_k)], "metric", "value"))


def metric_table(
    df: DataFrame,
    label: str = "is_fraud",
    score: str = "predictions",
    top_k: Sequence[int] = (50,),
    rounded: bool = True,
) -> DataFrame:
    """The metrics as one row, a column each."""
    names = ["auc_roc", "average_precision", "f1_score", *[f"precision_top_{k}" for k in top_k]]
    value = F.first("value")
    wide = metrics_long(df, label, score, top_k).groupBy().pivot("metric", names)
    return wide.agg(round_half_even(value, 3) if rounded else value)


def confusion(df: DataFrame, predicted: str = "predicted", label: str = "is_fraud") -> DataFrame:
    """All four (label, predicted) cells with their counts."""
    cells = [(actual, guess) for actual in (0, 1) for guess in (0, 1)]
    one = df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(predicted) == g)).alias(f"c{a}{g}")
            for a, g in cells
        ]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("label"), F.lit(g).alias("predicted"), F.col(f"c{a}{g}").alias("n"))
                    for a, g in cells
                ]
            )
        )
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation over folds of a long (fold, dataset, metric, value) table."""
    return folds.groupBy("metric", "dataset").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def side_by_side(summary: DataFrame, datasets: Sequence[str] = ("val", "train")) -> DataFrame:
    """Per metric, the means and deviations of the datasets as columns."""
    return summary.groupBy("metric").pivot("dataset", list(datasets)).agg(
        F.first("mean").alias("mean"), F.first("std").alias("std")
    )
