"""Regression metrics, losses, histograms, leaderboards and confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.joins import join_groups
from acreage.functions.numbers import finite
from acreage.operators.ranking import exact_quantiles, spearman


def prediction_table(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Add residual (NULL for an invalid pair) and valid (0 or 1)."""
    good = finite(F.col(y_true)) & finite(F.col(y_pred))
    return df.withColumns(
        {
            "residual": F.when(good, F.col(y_pred) - F.col(y_true)),
            "valid": F.coalesce(good, F.lit(False)).cast("int"),
        }
    )


def _scores(y_true: str, y_pred: str) -> list[Column]:
    error = F.col(y_pred) - F.col(y_true)
    total = F.var_pop(y_true) * F.count(F.lit(1))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1.0 - F.try_divide(F.sum(error * error), total)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    ]


def regression_metrics(
    preds: DataFrame, group: Sequence[str] = (), y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """n, RMSE, R2 (1 - residual / total sum of squares) and MAE of the valid pairs."""
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred)))
    return valid.groupBy(*group).agg(*_scores(y_true, y_pred))


def overall_and_by(preds: DataFrame, by: str, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Metrics per group and, as group 'ALL', over everything, in one grouping-sets aggregation."""
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred)))
    grouped = valid.groupingSets([[], [F.col(by)]], F.col(by)).agg(
        F.grouping(F.col(by)).alias("_all"), *_scores(y_true, y_pred)
    )
    name = F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(by).cast("string"))
    return grouped.select(name.alias(by), "n", "rmse", "r2", "mae")


def with_spearman(
    metrics: DataFrame, preds: DataFrame, group: Sequence[str], y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred)))
    ranks = spearman(valid, y_true, y_pred, group).select(*group, "spearman")
    return join_groups(metrics, ranks, list(group), "left")


def overall_and_by_with_spearman(preds: DataFrame, by: str, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``overall_and_by`` with the rank correlation of every group and of all pairs together."""
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred)))
    ranks = spearman(valid, y_true, y_pred, [by]).select(F.col(by).cast("string").alias(by), "spearman")
    everything = spearman(valid, y_true, y_pred).select(F.lit("ALL").alias(by), "spearman")
    return join_groups(overall_and_by(preds, by, y_true, y_pred), ranks.unionByName(everything), [by], "left")


def fold_summary(by_fold: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each measure over the folds."""
    return by_fold.agg(
        F.count(F.lit(1)).alias("folds"),
        *[F.avg(m).alias(f"mean_{m}") for m in measures],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in measures],
    )


def leaderboard(scores: DataFrame, score: str = "r2", name: str = "model") -> DataFrame:
    """Rank by score, best first. One row per model, so an unpartitioned window is small."""
    return scores.withColumn("place", F.rank().over(Window.orderBy(F.desc_nulls_last(score)))).orderBy("place", name)


def best_by_type(scores: DataFrame, kind: str = "type", score: str = "r2", cost: str | None = None) -> DataFrame:
    """Mean, best and number of scores per model type, and the best score per unit of cost."""
    measures = [
        F.avg(score).alias("mean_score"), F.max(score).alias("best_score"), F.count(score).alias("n_models"),
    ]
    if cost:
        measures.append(F.max(F.try_divide(F.col(score), F.col(cost))).alias("best_efficiency"))
    return scores.groupBy(kind).agg(*measures)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the highest value, ties by key; a bounded top-k per task, no full sort."""
    return df.orderBy(F.desc_nulls_last(by), tie).limit(k)


def huber(error: Column, delta: float = 1.0) -> Column:
    size = F.abs(error)
    inner = F.least(size, F.lit(delta))
    return 0.5 * inner * inner + delta * (size - inner)


def pinball(y_true: Column, y_pred: Column, q: float) -> Column:
    gap = y_true - y_pred
    return F.greatest(gap * q, gap * (q - 1.0))


def focal(y_true: Column, y_pred: Column, gamma: float = 2.0, alpha: float = 1.0) -> Column:
    """Squared error weighted by the relative error, at most 1, to the power gamma."""
    error = y_pred - y_true
    relative = F.abs(error) / (F.greatest(F.abs(y_true), F.lit(1e-8)) + 1e-8)
    return alpha * F.pow(F.least(relative, F.lit(1.0)), F.lit(gamma)) * error * error


def loss_report(preds: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """MSE, Huber, pinball at 0.1/0.5/0.9 with their mean, and focal loss of the valid pairs."""
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred)))
    t, p = F.col(y_true), F.col(y_pred)
    q10, q50, q90 = (F.avg(pinball(t, p, q)) for q in (0.1, 0.5, 0.9))
    return valid.agg(
        F.avg((p - t) * (p - t)).alias("mse"),
        F.avg(huber(p - t)).alias("huber"),
        q10.alias("pinball_10"),
        q50.alias("pinball_50"),
        q90.alias("pinball_90"),
        ((q10 + q50 + q90) / 3.0).alias("pinball_mean"),
        F.avg(focal(t, p)).alias("focal"),
    )


def adaptive_loss(preds: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """MSE, or 0.7 MSE + 0.3 Huber when more than 20 % of the errors exceed their 0.8 quantile."""
    valid = preds.filter(finite(F.col(y_true)) & finite(F.col(y_pred))).select(
        (F.col(y_pred) - F.col(y_true)).alias("e")
    ).withColumn("size", F.abs("e"))
    edge = exact_quantiles(valid, "size", {"edge": 0.8})
    scored = valid.withColumn("_edge", edge.select("edge").scalar()).agg(
        F.avg(F.col("e") * F.col("e")).alias("mse"),
        F.avg(huber(F.col("e"))).alias("huber"),
        F.max("_edge").alias("threshold"),
        F.avg((F.col("size") > F.col("_edge")).cast("double")).alias("outlier_ratio"),
    )
    mixed = F.when(F.col("outlier_ratio") > 0.2, 0.7 * F.col("mse") + 0.3 * F.col("huber"))
    return scored.withColumn("loss", F.coalesce(mixed, F.col("mse")))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width counts between the least and the greatest value; the last bin is closed.

    The bounds enter as scalar subqueries; a single value gets half a unit of
    room on either side. Empty bins are listed with 0.
    """
    lowest = df.agg(F.min(value).alias("m")).select("m").scalar()
    highest = df.agg(F.max(value).alias("m")).select("m").scalar()
    room = F.when(lowest == highest, F.lit(0.5)).otherwise(F.lit(0.0))
    bounded = df.filter(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("_v"), (lowest - room).alias("_lo"), (highest + room).alias("_hi")
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.floor((F.col("_v") - F.col("_lo")) / width)
    slot = F.least(place, F.lit(bins - 1)).cast("int")
    counted = bounded.withColumn("bin", slot).groupBy().agg(
        *[F.count_if(F.col("bin") == b).alias(f"n{b}") for b in range(bins)],
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
    )
    rows = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"n{b}").alias("n")) for b in range(bins)])
    listed = counted.select("_lo", "_hi", F.inline(rows))
    return listed.select("bin", (F.col("_lo") + F.col("bin") * width).alias("low"), "n")


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def intersection_over_union(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """IoU per class from the confusion counts; a class without any pixel gives no row."""
    counts = confusion(df, truth, predicted)
    roles = F.array(
        F.struct(F.col(truth).alias("label"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("hit")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p"),
                 F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(F.lit(0)).alias("hit")),
    )
    per_class = counts.select(F.inline(roles)).groupBy("label").agg(
        F.sum("hit").alias("_hit"), (F.sum("t") + F.sum("p") - F.sum("hit")).alias("_any")
    )
    return per_class.select("label", F.try_divide(F.col("_hit"), F.col("_any")).alias("iou"))


def mean_iou(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return intersection_over_union(df, truth, predicted).agg(F.avg("iou").alias("mean_iou"))


def average_predictions(preds: DataFrame, sample: str, pred: str = "y_pred") -> DataFrame:
    """Mean prediction of a sample over its augmented versions."""
    return preds.groupBy(sample).agg(F.avg(pred).alias(pred), F.count(pred).alias("versions"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def majority(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the lowest on a tie, decided from the value counts."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(1)


def quantile_profile(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles and maximum, exact and interpolated."""
    return exact_quantiles(df, value, {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}, group)


def split_distribution(df: DataFrame, site: str = "site", split: str = "split") -> DataFrame:
    """Samples per site and split with their share of the split; the window runs over the counts."""
    counted = df.groupBy(site, split).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(split)))
