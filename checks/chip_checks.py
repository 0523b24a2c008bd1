"""Chips, samples, features, augmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.numbers import MODULUS
from acreage.operators import chips, features, splits
from acreage.plans import samples
from checks.base import Inputs, check
from checks.split_checks import mixed

CHIP = ["chip"]


@check("overlapping_chips", "fx_pixels", sql="""
    WITH k AS (SELECT UNNEST(RANGE(47)) AS k)
    SELECT p.tile, a.k AS chip_col, b.k AS chip_row, COUNT(*) AS n, CAST(SUM(px - a.k * 21) AS BIGINT) AS sum_x, CAST(SUM(py - b.k * 21) AS BIGINT) AS sum_y
    FROM fx_pixels p JOIN k a ON p.px >= a.k * 21 AND p.px < a.k * 21 + 24 JOIN k b ON p.py >= b.k * 21 AND p.py < b.k * 21 + 24 GROUP BY 1, 2, 3""")
def overlapping_chips(i: Inputs) -> DataFrame:
    cut = chips.cut_chips(i.fx_pixels.select("tile", "px", "py"), 1000, 1000, 24, chips.chip_stride(24, 0.1))
    return cut.groupBy("tile", "chip_col", "chip_row").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cx").alias("sum_x"), F.sum("cy").alias("sum_y")
    )


@check("chip_centres", "fx_pixels", sql="""SELECT DISTINCT ci AS chip_col, cj AS chip_row, 500000 + (ci * 21 + 12 + 0.5) * CAST(10 AS DOUBLE) AS x, 8000000 - (cj * 21 + 12 + 0.5) * CAST(10 AS DOUBLE) AS y FROM fx_pixels""")
def chip_centres(i: Inputs) -> DataFrame:
    named = i.fx_pixels.select(F.col("ci").alias("chip_col"), F.col("cj").alias("chip_row")).distinct()
    return chips.chip_centres(named, 500000.0, 8000000.0, 10.0)


@check("site_centres", "fx_points", sql="SELECT site, (MIN(x) + MAX(x)) / 2 AS x, (MIN(y) + MAX(y)) / 2 AS y FROM fx_points GROUP BY 1")
def site_centres(i: Inputs) -> DataFrame:
    return chips.site_centres(i.fx_points)


TARGETS = """
    t AS (SELECT chip, AVG(CASE WHEN biomass IS NULL THEN 0.0 ELSE 1.0 END) AS valid_fraction, AVG(biomass) AS mean_target FROM fx_chip_px GROUP BY 1),
    u AS (SELECT *, CASE WHEN valid_fraction >= 0.75 AND mean_target > 0 THEN 1 ELSE 0 END AS usable FROM t)
"""


def targets(i: Inputs) -> DataFrame:
    return chips.chip_targets(i.fx_chip_px, CHIP, "biomass", minimum=0.75)


@check("chip_targets", "fx_chip_px", sql=f"""WITH {TARGETS.strip()} SELECT chip, ROUND(valid_fraction, 6) AS valid_fraction, ROUND(mean_target, 5) AS mean_target, usable,
    ROUND(CASE WHEN usable = 1 THEN LN(mean_target + 1) END, 6) AS target FROM u""")
def chip_targets(i: Inputs) -> DataFrame:
    return targets(i).select("chip", F.round("valid_fraction", 6).alias("valid_fraction"), F.round("mean_target", 5).alias("mean_target"), "usable",
                             F.round("target", 6).alias("target"))


MISSING = "m AS (SELECT chip, AVG(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS missing FROM fx_chip_px GROUP BY 1)"
LIMIT = 0.15


@check("chip_band_imputation", "fx_chip_px", sql=f"""WITH {MISSING}, d AS (SELECT chip, band, MEDIAN(v) AS med FROM fx_chip_px GROUP BY 1, 2)
    SELECT p.chip, p.band, ROUND(SUM(COALESCE(p.v, d.med, 0)), 4) AS total, COUNT(*) AS n FROM fx_chip_px p JOIN d ON d.chip = p.chip AND d.band = p.band
    JOIN m ON m.chip = p.chip AND m.missing <= {LIMIT} GROUP BY 1, 2""")
def chip_band_imputation(i: Inputs) -> DataFrame:
    filled = chips.impute_bands(i.fx_chip_px.select("chip", "band", "v"), CHIP, maximum=LIMIT)
    return filled.groupBy("chip", "band").agg(F.round(F.sum("v"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


@check("chip_quality_funnel", "fx_chip_px", sql=f"""WITH {TARGETS.strip()}, {MISSING}, o AS (SELECT CASE WHEN usable = 0 THEN 'discarded_target' WHEN missing > {LIMIT} THEN 'discarded_missing'
      WHEN missing > 0 THEN 'imputed' ELSE 'clean' END AS outcome FROM u JOIN m ON m.chip = u.chip)
    SELECT outcome, COUNT(*) AS chips, ROUND(COUNT(*) / (SELECT COUNT(*) FROM o), 6) AS share FROM o GROUP BY 1""")
def chip_quality_funnel(i: Inputs) -> DataFrame:
    missing = chips.missing_fraction(i.fx_chip_px, CHIP)
    return chips.quality_funnel(targets(i), missing, CHIP, LIMIT).withColumn("share", F.round("share", 6))


@check("usable_chip_bands", "fx_chip_px", sql=f"""WITH {TARGETS.strip()}, {MISSING}, d AS (SELECT chip, band, MEDIAN(v) AS med FROM fx_chip_px GROUP BY 1, 2)
    SELECT p.chip, ROUND(SUM(COALESCE(p.v, d.med, 0)), 4) AS total, ROUND(MAX(LN(u.mean_target + 1)), 6) AS target FROM fx_chip_px p JOIN d ON d.chip = p.chip AND d.band = p.band
    JOIN m ON m.chip = p.chip AND m.missing <= 0.3 JOIN (SELECT chip, mean_target FROM t WHERE valid_fraction >= 0.7 AND mean_target > 0) u ON u.chip = p.chip GROUP BY 1""")
def usable_chip_bands(i: Inputs) -> DataFrame:
    kept, bands = samples.usable_chips(i.fx_chip_px, i.fx_chip_px.select("chip", "band", "v"), CHIP, "biomass")
    sums = bands.groupBy("chip").agg(F.round(F.sum("v"), 4).alias("total"))
    return sums.join(kept.select("chip", F.round("target", 6).alias("target")), "chip")


@check("standardised_by_train", "fx_chip_px", sql="""WITH s AS (SELECT band, AVG(v) AS m, STDDEV_POP(v) AS d FROM fx_chip_px WHERE chip % 5 <> 0 GROUP BY 1)
    SELECT p.chip, p.band, ROUND(SUM(COALESCE((p.v - s.m) / CASE WHEN s.d = 0 THEN 1 ELSE s.d END, 0)), 4) AS total FROM fx_chip_px p JOIN s ON s.band = p.band GROUP BY 1, 2""")
def standardised_by_train(i: Inputs) -> DataFrame:
    z = chips.standardise_by_train(i.fx_chip_px, F.col("chip") % 5 != 0)
    return z.groupBy("chip", "band").agg(F.round(F.sum("v"), 4).alias("total"))


@check("coordinate_channels", "fx_pixels", sql="SELECT tile, px, py, ROUND(-1 + px * (2.0 / 999), 6) AS x_channel, ROUND(-1 + py * (2.0 / 999), 6) AS y_channel FROM fx_pixels")
def coordinate_channels(i: Inputs) -> DataFrame:
    out = chips.coordinate_channels(i.fx_pixels.select("tile", "px", "py"), 1000, 1000, "px", "py")
    return out.select("tile", "px", "py", F.round("x_channel", 6).alias("x_channel"), F.round("y_channel", 6).alias("y_channel"))


@check("geometric_variants", "fx_pixels", sql="""
    WITH v(variant, a, b, c, d, e, f) AS (VALUES ('identity', 1, 0, 0, 0, 1, 0), ('flip_rows', 1, 0, 0, 0, -1, 999), ('flip_columns', -1, 0, 999, 0, 1, 0),
      ('turn_90', 0, 1, 0, -1, 0, 999), ('turn_180', -1, 0, 999, 0, -1, 999), ('turn_270', 0, -1, 999, 1, 0, 0))
    SELECT variant, tile, CAST(a * px + b * py + c AS INT) AS cx, CAST(d * px + e * py + f AS INT) AS cy, COUNT(*) AS n FROM fx_pixels, v GROUP BY 1, 2, 3, 4""")
def geometric_variants(i: Inputs) -> DataFrame:
    placed = i.fx_pixels.select("tile", F.col("px").cast("int").alias("cx"), F.col("py").cast("int").alias("cy"))
    # Every variant moves different places to different places, so pixels are counted once, before there are six of each.
    counted = placed.groupBy("tile", "cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    return chips.geometric_variants(counted, 1000).select("variant", "tile", "cx", "cy", "n")


def _uniform(key: str, seed: int) -> str:
    return f"({mixed(key, seed)} / CAST({MODULUS} AS DOUBLE))"


def _factor(reach: float, offset: int) -> str:
    return f"""CASE WHEN on_ AND {_uniform('key', offset + 1)} < 0.5
        THEN 1 + ({_uniform('key', offset)} * 2 - 1) * {reach} ELSE 1 END"""


@check("spectral_jitter", "fx_chip_px", sql=f"""
    WITH px AS (SELECT chip, CAST(band + 4 * k AS INT) AS band, pix, SUM(COALESCE(v, 0) + k) AS v FROM fx_chip_px CROSS JOIN (VALUES (0), (1), (2)) AS t(k) GROUP BY 1, 2, 3),
    m AS (SELECT chip, band, AVG(v) AS mean, chip * 12 + band AS key FROM px GROUP BY 1, 2),
    o AS (SELECT *, {_uniform('chip', 6)} < 0.5 AND ROW_NUMBER() OVER (PARTITION BY chip ORDER BY {mixed('(chip * 12 + band)', 1)}, band) <= 1 + {mixed('chip', 0)} % 3 AS on_ FROM m),
    f AS (SELECT chip, band, mean, {_factor(0.1, 2)} AS b, {_factor(0.1, 4)} AS c FROM o)
    SELECT p.chip, p.band, p.pix, ROUND((p.v * f.b - f.mean * f.b) * f.c + f.mean * f.b, 6) AS v
    FROM px p JOIN f ON f.chip = p.chip AND f.band = p.band""")
def spectral_jitter(i: Inputs) -> DataFrame:
    """Single pixels of twelve bands, made of three shifted copies of the four."""
    copies = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")
    source = i.fx_chip_px.select("chip", "band", "pix", "v", copies)
    source = source.groupBy("chip", (F.col("band") + 4 * F.col("k")).cast("int").alias("band"), "pix").agg(F.sum(F.coalesce("v", F.lit(0.0)) + F.col("k")).alias("v"))
    return chips.spectral_jitter(source, "chip", 12).withColumn("v", F.round("v", 6))


BANDS = ["b1", "b2", "b3", "b4", "b5"]
GOOD = "target > 0 AND target < 1000"


@check("valid_sample_share", "fx_samples", sql=f"SELECT site, COUNT(*) AS n, CAST(SUM(CASE WHEN {GOOD} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, ROUND(SUM(CASE WHEN {GOOD} THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) AS valid_pct FROM fx_samples GROUP BY 1")
def valid_sample_share(i: Inputs) -> DataFrame:
    return features.valid_share(i.fx_samples, BANDS, "target", ["site"]).withColumn("valid_pct", F.round("valid_pct", 6))


@check("pixel_feature_table", "fx_samples", sql=f"""SELECT id, b1 AS "Band_01", ROUND(b2, 6) AS "Band_02", ROUND(CASE WHEN ABS(b2 + b1) > 1e-10 THEN (b2 - b1) / (b2 + b1) ELSE 0 END, 6) AS "NDVI_S2_T1",
    ROUND(CASE WHEN ABS(b3) > 1e-10 THEN b4 / b3 ELSE 0 END, 6) AS "CPR_S1_T1", ROUND(LN(target + 1), 6) AS target FROM fx_samples WHERE {GOOD}""")
def pixel_feature_table(i: Inputs) -> DataFrame:
    out = features.pixel_features(
        i.fx_samples, ["id"], ["b1", "b2"], "target", {"T1": {"red": "b1", "nir": "b2"}}, {"T1": {"vv": "b3", "vh": "b4"}}
    )
    return out.select("id", "Band_01", *[F.round(c, 6).alias(c) for c in ("Band_02", "NDVI_S2_T1", "CPR_S1_T1", "target")])


@check("varying_features", "fx_samples", sql=" UNION ALL ".join(
    f"SELECT '{b}' AS feature, ROUND(VAR_POP({b}), 4) AS variance FROM fx_samples HAVING VAR_POP({b}) > 1e-8" for b in BANDS))
def varying_features(i: Inputs) -> DataFrame:
    return features.varying_features(i.fx_samples, BANDS).withColumn("variance", F.round("variance", 4))


def _mi_sql(bins: int = 16, table: str = "fx_samples") -> str:
    parts = [
        f"""SELECT '{b}' AS feature, CAST(COALESCE(LEAST(FLOOR(({b} - lo_{b}) * {bins} / NULLIF(hi_{b} - lo_{b}, 0)), {bins - 1}), 0) AS INT) AS a,
            CAST(LEAST(FLOOR((target - lo_t) * {bins} / (hi_t - lo_t)), {bins - 1}) AS INT) AS b FROM {table}, e
            WHERE {b} IS NOT NULL AND target IS NOT NULL AND NOT ISNAN({b}) AND NOT ISNAN(target)""" for b in BANDS
    ]
    bounds = ", ".join(f"MIN({b}) AS lo_{b}, MAX({b}) AS hi_{b}" for b in BANDS)
    return f"""WITH e AS (SELECT {bounds}, MIN(target) AS lo_t, MAX(target) AS hi_t FROM {table}), s AS ({' UNION ALL '.join(parts)}),
        j AS (SELECT feature, a, b, COUNT(*) AS n FROM s GROUP BY 1, 2, 3),
        w AS (SELECT *, SUM(n) OVER (PARTITION BY feature) AS t, SUM(n) OVER (PARTITION BY feature, a) AS na, SUM(n) OVER (PARTITION BY feature, b) AS nb FROM j)
        SELECT feature, ROUND(SUM(n / t * LN(n * t / (na * nb))), 6) AS mi FROM w GROUP BY 1"""


@check("mutual_information", "fx_samples", sql=_mi_sql())
def mutual_information(i: Inputs) -> DataFrame:
    return features.mutual_information(i.fx_samples, BANDS, "target").withColumn("mi", F.abs(F.round("mi", 6)))


# Every band is missing in other rows: a row counts for the bands it has.
_GAPS = ", ".join(f"CASE WHEN id % 5 <> {k} THEN {b} END AS {b}" for k, b in enumerate(BANDS))


@check("mutual_information_with_gaps", "fx_samples", sql=_mi_sql(table=f"(SELECT {_GAPS}, CASE WHEN id % 7 <> 0 THEN target END AS target FROM fx_samples)"))
def mutual_information_with_gaps(i: Inputs) -> DataFrame:
    gaps = [F.when(F.col("id") % 5 != k, F.col(b)).otherwise(None if k % 2 else float("nan")).alias(b) for k, b in enumerate(BANDS)]
    samples = i.fx_samples.select(*gaps, F.when(F.col("id") % 7 != 0, F.col("target")).alias("target"))
    return features.mutual_information(samples, BANDS, "target").withColumn("mi", F.abs(F.round("mi", 6)))


@check("selected_features", "fx_samples", sql="SELECT l_returnflag AS site, ROUND(SUM(l_quantity), 2) AS total FROM lineitem GROUP BY 1")
def selected_features(i: Inputs) -> DataFrame:
    # b1 and b4 share the quantity; the constant b5 never survives. The sum shows the table was cut to the kept columns.
    kept = features.select_features(i.fx_samples, BANDS, "target", 4)
    cut = i.fx_samples.select("site", *kept)
    return cut.groupBy("site").agg(F.round(F.sum("b1"), 2).alias("total"))


def vectors(i: Inputs) -> DataFrame:
    return i.table("embeddings")


@check("component_invariants", sql="SELECT CAST(64 AS BIGINT) AS components, CAST(64 AS DOUBLE) AS total_variance, TRUE AS uncorrelated, TRUE AS falling")
def component_invariants(i: Inputs) -> DataFrame:
    """All components of standardised columns: their variances add up to the number of columns, fall, and go alone."""
    out = features.principal_components(vectors(i), "embedding", 64)
    names = out.columns
    first = names[:12]
    cross = [F.abs(F.covar_samp(a, b)) for k, a in enumerate(first) for b in first[k + 1 :]]
    variances = [F.var_samp(c) for c in names]
    falling = F.lit(True)
    for a, b in zip(names, names[1:], strict=False):
        falling = falling & (F.var_samp(a) >= F.var_samp(b) - 1e-9)
    return out.agg(
        F.lit(len(names)).cast("bigint").alias("components"), F.round(sum(variances[1:], variances[0]), 4).alias("total_variance"),
        (F.greatest(*cross) < 1e-6).alias("uncorrelated"), falling.alias("falling"),
    )


@check("components_beside_features", "fx_samples", sql=f"""SELECT CAST(COUNT(*) AS BIGINT) AS n, ROUND(SUM(b2), 2) AS total, TRUE AS centred FROM fx_samples WHERE {GOOD}""")
def components_beside_features(i: Inputs) -> DataFrame:
    """The pixel feature table keeps its rows and columns beside the components, whose mean is 0."""
    table = features.pixel_features(i.fx_samples, ["id"], BANDS, "target", {"T1": {"red": "b1", "nir": "b2"}})
    out = features.with_components(table, [f"Band_{k:02d}" for k in range(1, 5)], 3)
    assert out.columns == [*table.columns, "PCA_01", "PCA_02", "PCA_03"]
    far = F.greatest(*[F.abs(F.avg(c)) for c in out.columns[-3:]])
    return out.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("Band_02"), 2).alias("total"), (far < 1e-6).alias("centred"))


@check("principal_components")
def principal_components(i: Inputs) -> DataFrame:
    out = features.principal_components(vectors(i), "embedding", 5, keys=["vec_id"])
    return out.select("vec_id", *[F.round(c, 4).alias(c) for c in out.columns if c != "vec_id"])


def _bounds_sql(where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{b}' AS feature, QUANTILE_CONT({b}, 0.5) AS median, QUANTILE_CONT({b}, 0.75) - QUANTILE_CONT({b}, 0.25) AS iqr FROM fx_samples {where}" for b in BANDS
    )


def _scaled_sql() -> str:
    """Quartiles of the other sites applied to the rows of one."""
    parts = ", ".join(
        f"ROUND(({b} - (SELECT median FROM e WHERE feature = '{b}')) / (SELECT CASE WHEN iqr = 0 THEN 1 ELSE iqr END FROM e WHERE feature = '{b}'), 5) AS {b}" for b in BANDS
    )
    zeros = ", ".join(f"CASE WHEN {b} = 0 THEN CAST(0 AS DOUBLE) ELSE {b} END AS {b}" for b in BANDS)
    return f"WITH e AS ({_bounds_sql("WHERE site <> 'R'")}) SELECT id, {zeros} FROM (SELECT id, {parts} FROM fx_samples WHERE site = 'R') t"


@check("robust_scaling", "fx_samples", sql=_scaled_sql())
def robust_scaling(i: Inputs) -> DataFrame:
    train, other = i.fx_samples.filter("site <> 'R'"), i.fx_samples.filter("site = 'R'")
    scaled = features.robust_scale(train, [other], BANDS)[1]
    return scaled.select("id", *[F.round(b, 5).alias(b) for b in BANDS])


@check("robust_bounds", "fx_samples", sql=f"WITH e AS ({_bounds_sql()}) SELECT feature, ROUND(median, 6) AS median, ROUND(iqr, 6) AS iqr FROM e")
def robust_bounds(i: Inputs) -> DataFrame:
    out = features.robust_bounds(i.fx_samples, BANDS)
    return out.select("feature", F.round("median", 6).alias("median"), F.round("iqr", 6).alias("iqr"))


@check("tree_transfer_benchmark")
def tree_transfer_benchmark(i: Inputs) -> DataFrame:
    names = [f"e{k}" for k in range(64)]
    named = [F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate(names)]
    rows = vectors(i).select("vec_id", *named, F.col("label").cast("double").alias("y"))
    split = splits.random_split(rows, "vec_id", share=0.5)
    preds = features.transfer_benchmark(
        split.filter("split = 'train'"), split.filter("split = 'val'"), names, "y", features.tree_regressors(trees=10, depth=4)
    )
    return features.both_scales(preds)


@check("tree_constant_target", sql="""SELECT model, CAST(COUNT(*) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS rmse FROM embeddings, (VALUES ('RandomForest'), ('BoostedTrees')) AS m(model)
    WHERE vec_id % 2 = 1 GROUP BY 1""")
def tree_constant_target(i: Inputs) -> DataFrame:
    """Every row of the other site is predicted, and a constant target exactly, also where a feature is missing."""
    gaps = F.when(F.col("vec_id") % 3 > 0, F.col("embedding")[0].cast("double")).alias("e0")
    rows = vectors(i).select("vec_id", gaps, F.col("embedding")[1].cast("double").alias("e1"), F.lit(5.0).alias("y"))
    preds = features.transfer_benchmark(
        rows.filter("vec_id % 2 = 0"), rows.filter("vec_id % 2 = 1"), ["e0", "e1"], "y", features.tree_regressors(trees=3, depth=2)
    )
    error = F.col("y_pred") - F.col("y_true")
    return preds.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"))
