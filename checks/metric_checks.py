"""Accuracy, losses, ranks, quantiles, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.operators import features, metrics, ranking
from acreage.plans import samples
from checks.base import Inputs, check

SCORES = """COUNT(*) AS n, SQRT(AVG((y_pred - y_true) * (y_pred - y_true))) AS rmse,
    1 - SUM((y_pred - y_true) * (y_pred - y_true)) / (VAR_POP(y_true) * COUNT(*)) AS r2, AVG(ABS(y_pred - y_true)) AS mae"""
VALID = "v AS (SELECT * FROM fx_preds WHERE y_pred IS NOT NULL AND y_true IS NOT NULL)"


def rounded(df: DataFrame, digits: int = 5) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@check("prediction_table", "fx_preds", sql="SELECT id, ROUND(y_pred - y_true, 4) AS residual, CASE WHEN y_pred IS NULL THEN 0 ELSE 1 END AS valid FROM fx_preds")
def prediction_table(i: Inputs) -> DataFrame:
    return metrics.prediction_table(i.fx_preds).select("id", F.round("residual", 4).alias("residual"), "valid")


@check("regression_metrics", "fx_preds", sql=f"""WITH {VALID} , q AS (SELECT site, {SCORES} FROM v GROUP BY 1 UNION ALL SELECT 'ALL', {SCORES} FROM v)
    SELECT site, n, ROUND(rmse, 4) AS rmse, ROUND(r2, 6) AS r2, ROUND(mae, 4) AS mae FROM q""")
def regression_metrics(i: Inputs) -> DataFrame:
    out = metrics.overall_and_by(i.fx_preds, "site")
    return out.select("site", "n", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"))


def rank_sql(column: str, over: str) -> str:
    """Average rank: rank plus half the ties."""
    part = f"PARTITION BY {over} " if over else ""
    same = f"{over}, {column}" if over else column
    return f"RANK() OVER ({part}ORDER BY {column}) + (COUNT(*) OVER (PARTITION BY {same}) - 1) / 2.0"


@check("average_ranks", sql=f"SELECT DISTINCT l_returnflag, l_quantity, CAST({rank_sql('l_quantity', 'l_returnflag')} AS DOUBLE) AS avg_rank FROM lineitem")
def average_ranks(i: Inputs) -> DataFrame:
    return ranking.average_ranks(i.table("lineitem"), "l_quantity", ["l_returnflag"]).drop("_n")


@check("rank_correlation", sql=f"""WITH r AS (SELECT l_returnflag, {rank_sql('l_quantity', 'l_returnflag')} AS a, {rank_sql('l_extendedprice', 'l_returnflag')} AS b FROM lineitem)
    SELECT l_returnflag, COUNT(*) AS n_pairs, ROUND(CORR(a, b), 6) AS spearman FROM r GROUP BY 1""")
def rank_correlation(i: Inputs) -> DataFrame:
    return rounded(ranking.spearman(i.table("lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]), 6)


FOLDS = f"""{VALID}, q AS (SELECT fold, {SCORES} FROM v GROUP BY 1),
    k AS (SELECT fold, {rank_sql('y_true', 'fold')} AS a, {rank_sql('y_pred', 'fold')} AS b FROM v), s AS (SELECT fold, CORR(a, b) AS spearman FROM k GROUP BY 1),
    f AS (SELECT q.*, s.spearman FROM q JOIN s ON s.fold = q.fold)"""


@check("metrics_with_rank_correlation", "fx_preds", sql=f"""
    WITH v AS (SELECT CAST(site AS VARCHAR) AS site, y_true, y_pred FROM fx_preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL
               UNION ALL SELECT 'ALL', y_true, y_pred FROM fx_preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL),
    r AS (SELECT *, {rank_sql('y_true', 'site')} AS a, {rank_sql('y_pred', 'site')} AS b FROM v)
    SELECT site, COUNT(*) AS n, ROUND(CORR(a, b), 6) AS spearman FROM r GROUP BY 1""")
def metrics_with_rank_correlation(i: Inputs) -> DataFrame:
    out = metrics.overall_and_by_with_spearman(i.fx_preds, "site")
    return out.select("site", "n", F.round("spearman", 6).alias("spearman"))


@check("fold_metrics", "fx_preds", sql=f"WITH {FOLDS} SELECT fold, n, ROUND(rmse, 4) AS rmse, ROUND(r2, 6) AS r2, ROUND(mae, 4) AS mae, ROUND(spearman, 6) AS spearman FROM f")
def fold_metrics(i: Inputs) -> DataFrame:
    out = metrics.with_spearman(metrics.regression_metrics(i.fx_preds, ["fold"]), i.fx_preds, ["fold"])
    digits = {"rmse": 4, "r2": 6, "mae": 4, "spearman": 6}
    return out.select("fold", "n", *[F.round(c, d).alias(c) for c, d in digits.items()])


@check("cross_validation_summary", "fx_preds", sql=f"""WITH {FOLDS} SELECT COUNT(*) AS folds, ROUND(AVG(rmse), 4) AS mean_rmse, ROUND(AVG(r2), 6) AS mean_r2, ROUND(AVG(mae), 4) AS mean_mae, ROUND(AVG(spearman), 6) AS mean_spearman,
    ROUND(STDDEV_POP(rmse), 4) AS std_rmse, ROUND(STDDEV_POP(r2), 6) AS std_r2, ROUND(STDDEV_POP(mae), 4) AS std_mae, ROUND(STDDEV_POP(spearman), 6) AS std_spearman FROM f""")
def cross_validation_summary(i: Inputs) -> DataFrame:
    out = samples.cross_validation_report(i.fx_preds)
    return out.select("folds", *[F.round(c, 4 if c.endswith(("rmse", "mae")) else 6).alias(c) for c in out.columns if c != "folds"])


@check("model_leaderboard", "fx_preds", sql=f"WITH {VALID}, q AS (SELECT CONCAT('fold_', CAST(fold AS STRING)) AS model, {SCORES} FROM v GROUP BY 1) SELECT model, ROUND(r2, 6) AS r2, CAST(RANK() OVER (ORDER BY r2 DESC) AS INT) AS place FROM q")
def model_leaderboard(i: Inputs) -> DataFrame:
    named = i.fx_preds.withColumn("model", F.concat(F.lit("fold_"), F.col("fold").cast("string")))
    out = metrics.leaderboard(metrics.regression_metrics(named, ["model"]))
    return out.select("model", F.round("r2", 6).alias("r2"), "place")


@check("best_by_type", "fx_preds", sql=f"""WITH {VALID}, q AS (SELECT fold, site, {SCORES} FROM v GROUP BY 1, 2)
    SELECT site AS type, ROUND(AVG(r2), 6) AS mean_score, ROUND(MAX(r2), 6) AS best_score, COUNT(r2) AS n_models, ROUND(MAX(r2 / n), 9) AS best_efficiency FROM q GROUP BY 1""")
def best_by_type(i: Inputs) -> DataFrame:
    scored = metrics.regression_metrics(i.fx_preds, ["fold", "site"]).withColumnRenamed("site", "type")
    out = metrics.best_by_type(scored, cost="n")
    return out.select("type", F.round("mean_score", 6).alias("mean_score"), F.round("best_score", 6).alias("best_score"), "n_models",
                      F.round("best_efficiency", 9).alias("best_efficiency"))


@check("top_residuals", "fx_preds", sql="SELECT id, ROUND(ABS(y_pred - y_true), 4) AS size FROM fx_preds WHERE y_pred IS NOT NULL ORDER BY ABS(y_pred - y_true) DESC, id LIMIT 25")
def top_residuals(i: Inputs) -> DataFrame:
    sized = i.fx_preds.select("id", F.abs(F.col("y_pred") - F.col("y_true")).alias("size"))
    return metrics.top_k(sized, "size", 25, "id").withColumn("size", F.round("size", 4))


@check("both_scales", "fx_preds", sql=f"""WITH {VALID}, a AS (SELECT site, y_true / 100000 AS y_true, y_pred / 100000 AS y_pred FROM v), l AS (SELECT site, {SCORES} FROM a GROUP BY 1),
    b AS (SELECT site, GREATEST(EXP(y_true) - 1, 0) AS y_true, GREATEST(EXP(y_pred) - 1, 0) AS y_pred FROM a), o AS (SELECT site, {SCORES} FROM b GROUP BY 1)
    SELECT l.site, l.n, ROUND(l.rmse, 6) AS rmse, ROUND(l.r2, 6) AS r2, ROUND(l.mae, 6) AS mae, ROUND(o.rmse, 5) AS rmse_orig, ROUND(o.r2, 6) AS r2_orig, ROUND(o.mae, 5) AS mae_orig
    FROM l JOIN o ON o.site = l.site""")
def both_scales(i: Inputs) -> DataFrame:
    small = i.fx_preds.withColumns({c: F.col(c) / 100000.0 for c in ("y_true", "y_pred")})
    out = features.both_scales(small, group=["site"])
    return out.select("site", "n", *[F.round(c, 5 if c in ("rmse_orig", "mae_orig") else 6).alias(c) for c in out.columns if c not in ("site", "n")])


UNIT = "u AS (SELECT id, y_true / 100000 AS t, y_pred / 100000 AS p FROM fx_preds WHERE y_pred IS NOT NULL), e AS (SELECT t, p, p - t AS e, ABS(p - t) AS a FROM u)"


def unit_preds(i: Inputs) -> DataFrame:
    return i.fx_preds.withColumns({c: F.col(c) / 100000.0 for c in ("y_true", "y_pred")})


@check("loss_report", "fx_preds", sql=f"""WITH {UNIT}, q AS (SELECT AVG(e * e) AS mse, AVG(0.5 * LEAST(a, 1) * LEAST(a, 1) + (a - LEAST(a, 1))) AS huber,
      AVG(GREATEST(-e * 0.1, e * 0.9)) AS q1, AVG(GREATEST(-e * 0.5, e * 0.5)) AS q5, AVG(GREATEST(-e * 0.9, e * 0.1)) AS q9,
      AVG(POWER(LEAST(a / (GREATEST(ABS(t), 1e-8) + 1e-8), 1), 2) * e * e) AS focal FROM e)
    SELECT ROUND(mse, 7) AS mse, ROUND(huber, 7) AS huber, ROUND(q1, 7) AS pinball_10, ROUND(q5, 7) AS pinball_50, ROUND(q9, 7) AS pinball_90, ROUND((q1 + q5 + q9) / 3, 7) AS pinball_mean, ROUND(focal, 9) AS focal FROM q""")
def loss_report(i: Inputs) -> DataFrame:
    out = metrics.loss_report(unit_preds(i))
    return out.select(*[F.round(c, 9 if c == "focal" else 7).alias(c) for c in out.columns])


@check("adaptive_loss", "fx_preds", sql=f"""WITH {UNIT}, k AS (SELECT QUANTILE_CONT(a, 0.8) AS edge FROM e),
    q AS (SELECT AVG(e * e) AS mse, AVG(0.5 * LEAST(a, 1) * LEAST(a, 1) + (a - LEAST(a, 1))) AS huber, MAX(edge) AS threshold, AVG(CASE WHEN a > edge THEN 1.0 ELSE 0.0 END) AS outlier_ratio FROM e, k)
    SELECT ROUND(mse, 7) AS mse, ROUND(huber, 7) AS huber, ROUND(threshold, 7) AS threshold, ROUND(outlier_ratio, 6) AS outlier_ratio,
           ROUND(CASE WHEN outlier_ratio > 0.2 THEN 0.7 * mse + 0.3 * huber ELSE mse END, 7) AS loss FROM q""")
def adaptive_loss(i: Inputs) -> DataFrame:
    out = metrics.adaptive_loss(unit_preds(i))
    return out.select(*[F.round(c, 6 if c == "outlier_ratio" else 7).alias(c) for c in out.columns])


@check("averaged_predictions", "fx_patches", sql="SELECT pix, ROUND(AVG(probability), 6) AS y_pred, COUNT(probability) AS versions FROM fx_patches GROUP BY 1")
def averaged_predictions(i: Inputs) -> DataFrame:
    out = metrics.average_predictions(i.fx_patches, "pix", "probability")
    return out.select("pix", F.round("probability", 6).alias("y_pred"), "versions")


@check("quantile_profile", "fx_preds", sql=f"""WITH {VALID} SELECT site, ROUND(MIN(y_true), 4) AS q0, ROUND(QUANTILE_CONT(y_true, 0.25), 4) AS q25, ROUND(QUANTILE_CONT(y_true, 0.5), 4) AS q50,
    ROUND(QUANTILE_CONT(y_true, 0.75), 4) AS q75, ROUND(MAX(y_true), 4) AS q100 FROM fx_preds GROUP BY 1""")
def quantile_profile(i: Inputs) -> DataFrame:
    return rounded(metrics.quantile_profile(i.fx_preds, "y_true", ["site"]), 4)


@check("split_distribution", "fx_preds", sql="SELECT site, fold AS split, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY fold), 6) AS share FROM fx_preds GROUP BY 1, 2")
def split_distribution(i: Inputs) -> DataFrame:
    out = metrics.split_distribution(i.fx_preds.withColumnRenamed("fold", "split"))
    return out.withColumn("share", F.round("share", 6))
