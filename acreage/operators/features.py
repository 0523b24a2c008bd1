"""Pixel feature tables, feature selection, scaling and tree regressors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.contracts import ContractError
from acreage.functions.numbers import finite, log_target, nan_to_zero, unlog_target
from acreage.functions.spectral import season_indices
from acreage.operators.metrics import regression_metrics
from acreage.operators.ranking import exact_quantiles

MAX_TARGET = 1000.0


def valid_sample(bands: Sequence[Column], target: Column, most: float = MAX_TARGET) -> Column:
    """True where every band and the target are finite and 0 < target < ``most``."""
    good = finite(target) & (target > 0) & (target < most)
    for b in bands:
        good = good & finite(b)
    return F.coalesce(good, F.lit(False))


def valid_share(df: DataFrame, bands: Sequence[str], target: str, group: Sequence[str] = ()) -> DataFrame:
    """Samples, valid samples and their per cent."""
    good = valid_sample([F.col(b) for b in bands], F.col(target))
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(good).alias("n_valid"),
        (F.count_if(good) * 100.0 / F.count(F.lit(1))).alias("valid_pct"),
    )


def require_valid_share(df: DataFrame, bands: Sequence[str], target: str, least: float = 1.0) -> DataFrame:
    """The valid samples; an error if they are less than ``least`` per cent."""
    share = valid_share(df, bands, target).first()["valid_pct"]
    if share is None or share < least:
        raise ContractError(f"only {share} per cent of the samples are valid")
    return df.filter(valid_sample([F.col(b) for b in bands], F.col(target)))


def pixel_features(
    samples: DataFrame,
    keys: Sequence[str],
    bands: Sequence[str],
    target: str,
    optical: Mapping[str, Mapping[str, str]],
    radar: Mapping[str, Mapping[str, str]] | None = None,
    log: bool = True,
    epsilon: float = 1.0,
) -> DataFrame:
    """All given bands, seasonal indices and the (log) target of the valid samples; NaN becomes 0."""
    def columns(layout: Mapping[str, Mapping[str, str]] | None) -> dict:
        return {s: {k: F.col(c) for k, c in names.items()} for s, names in (layout or {}).items()}

    valid = samples.filter(valid_sample([F.col(b) for b in bands], F.col(target)))
    named = {f"Band_{i:02d}": nan_to_zero(F.col(b)) for i, b in enumerate(bands, 1)}
    named |= season_indices(columns(optical), columns(radar))
    label = log_target(F.col(target), epsilon) if log else F.col(target)
    return valid.select(*keys, *[c.alias(n) for n, c in named.items()], label.alias("target"))


def _listed(df: DataFrame, features: Sequence[str], measure) -> DataFrame:
    """One aggregation over all features, turned to rows (feature, value)."""
    wide = df.agg(*[measure(f).alias(f"f{i}") for i, f in enumerate(features)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"f{i}").alias("value")) for i, f in enumerate(features)])
    return wide.select(F.inline(rows))


def feature_variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _listed(df, features, F.var_pop)


def varying_features(df: DataFrame, features: Sequence[str], least: float = 1e-8) -> DataFrame:
    """Features whose population variance exceeds ``least``."""
    return feature_variances(df, features).filter(F.col("value") > least).withColumnRenamed("value", "variance")


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 16) -> DataFrame:
    """(feature, mi) by equal-width binning of each feature and the target.

    A row counts for a feature if both it and the target are there: null and NaN
    are no values. A feature without such rows has 0. The joint counts hold at most bins x bins rows per feature, whatever the
    number of samples. The bounds of all columns come from one aggregation,
    which the driver sees as one row.
    """
    names = [*features, target]
    value = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in names]
    bounds = df.agg(
        *[F.min(v).alias(f"lo{i}") for i, v in enumerate(value)],
        *[F.max(v).alias(f"hi{i}") for i, v in enumerate(value)],
    ).first()

    def slot(i: int) -> Column:
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if low is None or high <= low:
            return F.when(value[i].isNotNull(), 0)
        place = F.floor((value[i] - F.lit(low)) * F.lit(bins) / F.lit(high - low))
        # greatest and least would pass over a null.
        return F.when(value[i].isNotNull(), F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("int"))

    rows = F.array(*[F.struct(F.lit(f).alias("feature"), slot(i).alias("a")) for i, f in enumerate(features)])
    joint = (
        df.select(slot(len(features)).alias("b"), F.inline(rows))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("feature", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    side_a = joint.groupBy("feature", "a").agg(F.sum("n").alias("na"))
    side_b = joint.groupBy("feature", "b").agg(F.sum("n").alias("nb"))
    total = joint.groupBy("feature").agg(F.sum("n").alias("t"))
    together = joint.join(side_a, ["feature", "a"]).join(side_b, ["feature", "b"]).join(total, "feature")
    part = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))
    found = together.groupBy("feature").agg(F.sum(part).alias("mi"))
    every = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(found, "feature", "left").select("feature", F.coalesce("mi", F.lit(0.0)).alias("mi"))


def select_features(
    train: DataFrame, features: Sequence[str], target: str, most: int, bins: int = 16, least: float = 1e-8
) -> list[str]:
    """Names to keep: the varying features, the ``most`` with the highest mutual information if more.

    Only feature names, a list bounded by the table's width, come to the driver.
    """
    varying = [r["feature"] for r in varying_features(train, features, least).collect()]
    varying = [f for f in features if f in varying]
    if len(varying) <= most:
        return varying
    ranked = mutual_information(train, varying, target, bins).orderBy(F.desc("mi"), "feature").limit(most)
    return [r["feature"] for r in ranked.collect()]


def robust_bounds(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, median, iqr) with exact interpolated quartiles, from one pass over (feature, value) rows."""
    rows = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    )
    quartiles = exact_quantiles(
        train.select(F.inline(rows)), "value", {"q25": 0.25, "median": 0.5, "q75": 0.75}, ["feature"]
    )
    return quartiles.select("feature", "median", (F.col("q75") - F.col("q25")).alias("iqr"))


def robust_scale(train: DataFrame, others: Sequence[DataFrame], features: Sequence[str]) -> list[DataFrame]:
    """Centre by median and divide by the interquartile range (1 if it is 0), both fitted on ``train``.

    Two numbers per feature, a list bounded by the table's width, come to the driver.
    """
    bounds = {r["feature"]: (r["median"], r["iqr"] or 1.0) for r in robust_bounds(train, features).collect()}
    scaled = {f: (F.col(f) - F.lit(m)) / F.lit(s) for f, (m, s) in bounds.items()}
    return [df.withColumns(scaled) for df in (train, *others)]


def principal_components(
    df: DataFrame, vector: str, components: int, first: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Standardise an array column, or its ``first`` entries, and project it on its components.

    pyspark.ml fits a square covariance matrix of the array's length from partial
    sums; the driver holds that matrix only.
    """
    first = first or df.agg(F.max(F.size(vector))).first()[0]
    head = df.select(*keys, array_to_vector(F.slice(F.col(vector).cast("array<double>"), 1, first)).alias("_raw"))
    stages = [
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=min(components, first), inputCol="_std", outputCol="_pca"),
    ]
    projected = Pipeline(stages=stages).fit(head).transform(head)
    values = vector_to_array("_pca")
    return projected.select(*keys, *[values[i].alias(f"PCA_{i + 1:02d}") for i in range(min(components, first))])


def with_components(table: DataFrame, columns: Sequence[str], components: int) -> DataFrame:
    """A feature table with the principal components of ``columns`` beside its own columns; missing values count as 0."""
    vector = F.array(*[nan_to_zero(F.col(c).cast("double")) for c in columns])
    return principal_components(table.withColumn("_bands", vector), "_bands", components, len(columns), table.columns)


def tree_regressors(seed: int = 42, trees: int = 20, depth: int = 5) -> dict:
    """Forest and boosted-tree regressors over the 'scaled' vector."""
    shared = {"featuresCol": "scaled", "labelCol": "target", "predictionCol": "y_pred", "seed": seed, "maxDepth": depth}
    return {
        "RandomForest": RandomForestRegressor(numTrees=trees, **shared),
        "BoostedTrees": GBTRegressor(maxIter=trees, **shared),
    }


def transfer_benchmark(
    train: DataFrame, test: DataFrame, features: Sequence[str], target: str, models: dict | None = None
) -> DataFrame:
    """Fit every model on one site, predict another: predictions with the model's name.

    Missing features count as 0, so that every row is fitted and scored.
    """
    filled = {f: nan_to_zero(F.col(f).cast("double")) for f in features}
    named = [d.withColumns({**filled, "target": F.col(target).cast("double")}) for d in (train, test)]
    assembler = VectorAssembler(inputCols=list(features), outputCol="scaled", handleInvalid="error")
    fitted, scored = (assembler.transform(d) for d in robust_scale(named[0], [named[1]], features))
    out = None
    for name, model in (models or tree_regressors()).items():
        preds = model.fit(fitted).transform(scored).select(
            F.lit(name).alias("model"), F.col("target").alias("y_true"), "y_pred"
        )
        out = preds if out is None else out.unionByName(preds)
    return out


def both_scales(preds: DataFrame, epsilon: float = 1.0, group: Sequence[str] = ("model",)) -> DataFrame:
    """Metrics on the log scale and, after the inverse transform, on the original scale."""
    logged = regression_metrics(preds, group)
    back = preds.withColumns(
        {"y_true": unlog_target(F.col("y_true"), epsilon), "y_pred": unlog_target(F.col("y_pred"), epsilon)}
    )
    original = regression_metrics(back, group).withColumnsRenamed(
        {"rmse": "rmse_orig", "r2": "r2_orig", "mae": "mae_orig"}
    ).drop("n")
    return logged.join(original, list(group))
