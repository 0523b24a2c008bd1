"""Spectral indices, masks, change between epochs, scene selection, diffs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions import numbers, spectral
from acreage.operators import change, metrics
from acreage.plans import change_report
from checks.base import Inputs, check

PIXEL = ["patch", "epoch", "pix", "blue", "green", "red", "nir"]


class Bands:
    """Band columns by name, made when a session exists."""

    def __getitem__(self, name: str) -> Column:
        return F.col(name)


C = Bands()


def unsigned(column: str) -> str:
    """A zero without sign: rounding in DuckDB keeps the sign of zero, in Spark it does not."""
    return f"CASE WHEN {column} = 0 THEN CAST(0 AS DOUBLE) ELSE {column} END"


def index_query(name: str, column: Callable[[], Column], sql: str) -> None:
    @check(name, "fx_patches", sql=f"SELECT patch, pix, epoch, {unsigned('v')} AS v FROM (SELECT patch, pix, epoch, ROUND({sql}, 6) AS v FROM fx_patches) t")
    def run(i: Inputs) -> DataFrame:
        return i.fx_patches.select("patch", "pix", "epoch", F.round(column(), 6).alias("v"))


index_query("ndvi", lambda: spectral.ndvi(C["nir"], C["red"]), "(nir - red) / (nir + red + 1e-8)")
index_query("ndvi_clipped", lambda: spectral.ndvi_clipped(C["nir"], C["red"] - 4000.0),
            "GREATEST(-1, LEAST(1, (nir - (red - 4000)) / CASE WHEN nir + red - 4000 = 0 THEN 1e-10 ELSE nir + red - 4000 END))")
index_query("evi", lambda: spectral.evi(C["nir"], C["red"], C["blue"]), "2.5 * (nir - red) / (nir + 6 * red - 7.5 * blue + 1 + 1e-8)")
index_query("savi", lambda: spectral.savi(C["nir"] / 10000, C["red"] / 10000), "1.5 * (nir - red) / 10000 / ((nir + red) / 10000 + 0.5 + 1e-8)")
index_query("gndvi", lambda: spectral.gndvi(C["nir"], C["green"]), "(nir - green) / (nir + green + 1e-8)")
index_query("ndwi", lambda: spectral.ndwi(C["green"], C["nir"]), "(green - nir) / (green + nir + 1e-8)")
index_query("cross_pol_ratio", lambda: spectral.cross_pol_ratio(C["green"] - 1000.0, C["blue"] - 1000.0),
            "CASE WHEN ABS(blue - 1000) > 1e-10 THEN (green - 1000) / NULLIF(blue - 1000, 0) ELSE 0 END")


@check("season_indices", "fx_patches", sql="""SELECT patch, epoch, ROUND(AVG((nir - red) / (nir + red)), 6) AS "NDVI_S2_T1", ROUND(AVG((nir - green) / (nir + green)), 6) AS "GNDVI_S2_T1",
    ROUND(AVG((nir - blue) / (nir + blue)), 6) AS "NDVI_S2_T2", ROUND(AVG(green / red), 6) AS "CPR_S1_T1" FROM fx_patches GROUP BY 1, 2""")
def season_indices(i: Inputs) -> DataFrame:
    layout = {"T1": {"nir": C["nir"], "red": C["red"], "green": C["green"]}, "T2": {"nir": C["nir"], "red": C["blue"]}}
    found = spectral.season_indices(layout, {"T1": {"vv": C["red"], "vh": C["green"]}})
    return i.fx_patches.groupBy("patch", "epoch").agg(*[F.round(F.avg(c), 6).alias(n) for n, c in found.items()])


@check("derived_indices", "fx_patches", sql="""SELECT patch, ROUND(SUM((nir - red) / (nir + red + 1e-8)), 4) AS ndvi, ROUND(SUM(2.5 * (nir - red) / (nir + 6 * red - 7.5 * blue + 1 + 1e-8)), 3) AS evi,
    ROUND(SUM(1.5 * (nir - red) / (nir + red + 0.5 + 1e-8)), 4) AS savi, ROUND(SUM((nir - green) / (nir + green + 1e-8)), 4) AS gndvi,
    ROUND(SUM((green - nir) / (green + nir + 1e-8)), 4) AS ndwi FROM fx_patches GROUP BY 1""")
def derived_indices(i: Inputs) -> DataFrame:
    found = spectral.derived_indices(C["blue"], C["green"], C["red"], C["nir"])
    return i.fx_patches.groupBy("patch").agg(*[F.round(F.sum(c), 3 if n == "evi" else 4).alias(n) for n, c in found.items()])


@check("scalar_functions", "fx_points", sql="""SELECT point_id, CAST(FLOOR(value / 7) AS BIGINT) AS low, CAST(CEIL(value / 7) AS BIGINT) AS high, ROUND(SQRT(ABS(value - 250000)), 5) AS root,
    ROUND(LN(value), 6) AS ln, ROUND(EXP(value / 100000), 5) AS exp, ROUND(LOG10(GREATEST(value - 250000, 1)), 6) AS log10, LOWER(site) AS site,
    REGEXP_REPLACE(site, '[^A-Z]', '', 'g') AS letters, CASE WHEN value BETWEEN 100000 AND 200000 THEN 1 ELSE 0 END AS middle FROM fx_points""")
def scalar_functions(i: Inputs) -> DataFrame:
    v = F.col("value")
    return i.fx_points.select(
        "point_id", F.floor(v / 7).alias("low"), F.ceil(v / 7).alias("high"), F.round(F.sqrt(F.abs(v - 250000)), 5).alias("root"),
        F.round(F.log(v), 6).alias("ln"), F.round(F.exp(v / 100000), 5).alias("exp"),
        F.round(numbers.log10_floor1(v - 250000), 6).alias("log10"), F.lower("site").alias("site"),
        F.regexp_replace("site", "[^A-Z]", "").alias("letters"), v.between(100000, 200000).cast("int").alias("middle"),
    )


@check("date_stamps", sql="SELECT strftime(o_orderdate, '%y%m%d') AS stamp, COUNT(*) AS n FROM orders GROUP BY 1")
def date_stamps(i: Inputs) -> DataFrame:
    return i.table("orders").groupBy(numbers.date_stamp(F.col("o_orderdate")).alias("stamp")).agg(F.count(F.lit(1)).alias("n"))


@check("safe_divide", sql=f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {unsigned('v')} AS v
    FROM (SELECT *, ROUND(CASE WHEN ABS(l_tax - 0.02) > 1e-10 THEN l_discount / (l_tax - 0.02) ELSE 0 END, 6) AS v FROM lineitem) t""")
def safe_divide(i: Inputs) -> DataFrame:
    v = numbers.safe_divide(F.col("l_discount"), F.col("l_tax") - 0.02)
    return i.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(v, 6).alias("v"))


@check("nan_to_zero", "fx_preds", sql="SELECT id, ROUND(CASE WHEN y_pred IS NULL OR id % 5 = 0 THEN 0 ELSE y_pred END, 4) AS v FROM fx_preds")
def nan_to_zero(i: Inputs) -> DataFrame:
    spoiled = F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("y_pred"))
    return i.fx_preds.select("id", F.round(numbers.nan_to_zero(spoiled), 4).alias("v"))


@check("log_target_round_trip", "fx_preds", sql="SELECT id, ROUND(LN(y_true + 1), 6) AS logged, ROUND(GREATEST(EXP(LN(y_true + 1) - 8) - 1, 0), 4) AS restored FROM fx_preds")
def log_target_round_trip(i: Inputs) -> DataFrame:
    logged = numbers.log_target(F.col("y_true"))
    return i.fx_preds.select("id", F.round(logged, 6).alias("logged"), F.round(numbers.unlog_target(logged - 8.0), 4).alias("restored"))


@check("band_scaling", "fx_patches", sql="SELECT patch, epoch, ROUND(SUM(red / 4000), 4) AS red, ROUND(SUM((nir - 3500) / 577.5), 4) AS nir FROM fx_patches GROUP BY 1, 2")
def band_scaling(i: Inputs) -> DataFrame:
    scaled = change.standardise_fixed(change.scale_bands(i.fx_patches, ["red"]), ["nir"], [3500.0], [577.5])
    return scaled.groupBy("patch", "epoch").agg(F.round(F.sum("red"), 4).alias("red"), F.round(F.sum("nir"), 4).alias("nir"))


@check("band_stack", "fx_patches", sql="SELECT patch, pix, epoch, ROUND(blue / 4000, 6) AS first, ROUND(nir / 4000, 6) AS last FROM fx_patches")
def band_stack(i: Inputs) -> DataFrame:
    stack = change.stack_bands(["blue", "green", "red", "nir"])
    return i.fx_patches.select("patch", "pix", "epoch", F.round(stack[0], 6).alias("first"), F.round(stack[3], 6).alias("last"))


@check("percentile_stretch", "fx_patches", sql="""
    WITH e AS (SELECT patch, epoch, QUANTILE_CONT(red, 0.02) AS lo, QUANTILE_CONT(red, 0.98) AS hi FROM fx_patches GROUP BY 1, 2)
    SELECT p.patch, p.epoch, p.pix, ROUND(GREATEST(0, LEAST(1, (p.red - lo) / (hi - lo))), 5) AS red FROM fx_patches p JOIN e ON e.patch = p.patch AND e.epoch = p.epoch""")
def percentile_stretch(i: Inputs) -> DataFrame:
    out = change.percentile_stretch(i.fx_patches, ["patch", "epoch"], ["red"])
    return out.select("patch", "epoch", "pix", F.round("red", 5).alias("red"))


@check("scale_by_high_percentile", "fx_patches", sql="""
    WITH e AS (SELECT patch, epoch, QUANTILE_CONT(nir, 0.98) AS hi FROM fx_patches GROUP BY 1, 2)
    SELECT p.patch, p.epoch, p.pix, ROUND(p.nir / hi, 5) AS nir FROM fx_patches p JOIN e ON e.patch = p.patch AND e.epoch = p.epoch""")
def scale_by_high_percentile(i: Inputs) -> DataFrame:
    out = change.scale_by_high(i.fx_patches, ["patch", "epoch"], ["nir"])
    return out.select("patch", "epoch", "pix", F.round("nir", 5).alias("nir"))


@check("forest_masks", "fx_patches", sql="""SELECT patch, epoch, CAST(SUM(CASE WHEN (nir - red) / (nir + red) > 0.4 THEN 1 ELSE 0 END) AS BIGINT) AS by_index,
    CAST(SUM(CASE WHEN probability > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS by_model FROM fx_patches GROUP BY 1, 2""")
def forest_masks(i: Inputs) -> DataFrame:
    return i.fx_patches.groupBy("patch", "epoch").agg(
        F.sum(change.forest_mask(C["nir"], C["red"])).alias("by_index"),
        F.sum(change.threshold_mask(F.col("probability"), 0.5)).alias("by_model"),
    )


@check("paired_epochs", "fx_patches", sql="""SELECT patch, pix, MAX(CASE WHEN epoch = 0 THEN red END) AS red_t0, MAX(CASE WHEN epoch = 1 THEN red END) AS red_t1
    FROM fx_patches GROUP BY 1, 2 HAVING COUNT(CASE WHEN epoch = 0 THEN 1 END) > 0 AND COUNT(CASE WHEN epoch = 1 THEN 1 END) > 0""")
def paired_epochs(i: Inputs) -> DataFrame:
    return change.pair_epochs(i.fx_patches, ["patch", "pix"], ["red"])


LOSSES = """
    m AS (SELECT patch, epoch, CASE WHEN (nir - red) / (nir + red) > 0.4 THEN 1 ELSE 0 END AS a, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS b FROM fx_patches),
    s AS (SELECT patch, CAST(SUM(CASE WHEN epoch = 0 THEN a ELSE 0 END) AS BIGINT) AS a0, CAST(SUM(CASE WHEN epoch = 1 THEN a ELSE 0 END) AS BIGINT) AS a1,
                 CAST(SUM(CASE WHEN epoch = 0 THEN b ELSE 0 END) AS BIGINT) AS b0, CAST(SUM(CASE WHEN epoch = 1 THEN b ELSE 0 END) AS BIGINT) AS b1 FROM m GROUP BY 1),
    l AS (SELECT patch, a0, a1, COALESCE((a0 - a1) * 100.0 / NULLIF(a0, 0), 0) AS pa, (a0 - a1) * 100 AS ma,
                 COALESCE((b0 - b1) * 100.0 / NULLIF(b0, 0), 0) AS pb, (b0 - b1) * 100 AS mb FROM s)
"""


def index_losses(i: Inputs) -> DataFrame:
    return change_report.index_losses(i.fx_patches, ["patch"])


def compared(i: Inputs) -> DataFrame:
    return change.compare_methods(index_losses(i), change_report.probability_losses(i.fx_patches, ["patch"]), ["patch"])


@check("forest_loss", "fx_patches", sql=f"WITH {LOSSES.strip()} SELECT patch, a0 AS forest_t0, a1 AS forest_t1, ROUND(pa, 5) AS loss_pct, ma AS loss_m2 FROM l")
def forest_loss(i: Inputs) -> DataFrame:
    return index_losses(i).withColumn("loss_pct", F.round("loss_pct", 5))


@check("loss_summary", "fx_patches", sql=f"""WITH {LOSSES.strip()} SELECT CAST(SUM(ma) AS BIGINT) AS total_m2, ROUND(AVG(pa), 5) AS mean_pct, ROUND(MAX(pa), 5) AS max_pct,
    CAST(SUM(CASE WHEN pa > 10 THEN 1 ELSE 0 END) AS BIGINT) AS patches_above FROM l""")
def loss_summary(i: Inputs) -> DataFrame:
    out = change.loss_summary(index_losses(i))
    return out.withColumns({c: F.round(c, 5) for c in ("mean_pct", "max_pct")})


@check("method_disagreement", "fx_patches", sql=f"""WITH {LOSSES.strip()} SELECT ROUND(AVG(ABS(pa - pb)), 5) AS mean_difference, ROUND(MAX(ABS(pa - pb)), 5) AS max_difference,
    CAST(SUM(CASE WHEN ABS(pa - pb) > 20 THEN 1 ELSE 0 END) AS BIGINT) AS patches_above FROM l""")
def method_disagreement(i: Inputs) -> DataFrame:
    out = change.disagreement(compared(i))
    return out.withColumns({c: F.round(c, 5) for c in ("mean_difference", "max_difference")})


PICKS = LOSSES + """,
    c AS (SELECT patch, pa, pb, (pa + pb) / 2 AS mean_pct, ABS(pa - pb) AS difference FROM l),
    picks AS (SELECT 'high_loss' AS category, patch, pa, pb, difference, ROW_NUMBER() OVER (ORDER BY mean_pct > 15 DESC, mean_pct DESC, patch) AS place FROM c
    UNION ALL SELECT 'low_loss', patch, pa, pb, difference, ROW_NUMBER() OVER (ORDER BY mean_pct < 5 DESC, mean_pct, patch) FROM c
    UNION ALL SELECT 'high_difference', patch, pa, pb, difference, ROW_NUMBER() OVER (ORDER BY difference DESC, patch) FROM c)
"""


@check("representative_patches", "fx_patches", sql=f"WITH {PICKS.strip()} SELECT category, CAST(place AS INT) AS place, patch, ROUND(difference, 5) AS difference FROM picks WHERE place <= 2")
def representative_patches(i: Inputs) -> DataFrame:
    picks = change.representative_patches(compared(i), "patch")
    return picks.select("category", "place", "patch", F.round("difference", 5).alias("difference"))


@check("category_means", "fx_patches", sql=f"""WITH {PICKS.strip()} SELECT category, ROUND(AVG(pa), 5) AS mean_a, ROUND(AVG(pb), 5) AS mean_b, ROUND(AVG(difference), 5) AS mean_difference
    FROM picks WHERE place <= 2 GROUP BY 1""")
def category_means(i: Inputs) -> DataFrame:
    out = change.category_means(change.representative_patches(compared(i), "patch"))
    return out.select("category", *[F.round(c, 5).alias(c) for c in ("mean_a", "mean_b", "mean_difference")])


@check("change_report", "fx_patches", sql=f"""WITH {LOSSES.strip()}
    SELECT 'index' AS method, CAST(SUM(ma) AS BIGINT) AS total_m2, ROUND(AVG(pa), 5) AS mean_pct, ROUND(MAX(pa), 5) AS max_pct, CAST(SUM(CASE WHEN pa > 10 THEN 1 ELSE 0 END) AS BIGINT) AS patches_above FROM l
    UNION ALL SELECT 'model', CAST(SUM(mb) AS BIGINT), ROUND(AVG(pb), 5), ROUND(MAX(pb), 5), CAST(SUM(CASE WHEN pb > 10 THEN 1 ELSE 0 END) AS BIGINT) FROM l
    UNION ALL SELECT 'difference', NULL, ROUND(AVG(ABS(pa - pb)), 5), ROUND(MAX(ABS(pa - pb)), 5), CAST(SUM(CASE WHEN ABS(pa - pb) > 20 THEN 1 ELSE 0 END) AS BIGINT) FROM l""")
def report(i: Inputs) -> DataFrame:
    out = change_report.change_report(i.fx_patches, ["patch"])
    return out.select("method", "total_m2", F.round("mean_pct", 5).alias("mean_pct"), F.round("max_pct", 5).alias("max_pct"), "patches_above")


@check("loss_histogram", "fx_patches", sql=f"""WITH {LOSSES.strip()}, e AS (SELECT MIN(pa) - CASE WHEN MIN(pa) = MAX(pa) THEN 0.5 ELSE 0 END AS lo, MAX(pa) + CASE WHEN MIN(pa) = MAX(pa) THEN 0.5 ELSE 0 END AS hi FROM l),
    h AS (SELECT CAST(LEAST(29, FLOOR((pa - lo) / ((hi - lo) / 30))) AS INT) AS bin FROM l, e)
    SELECT CAST(b AS INT) AS bin, ROUND(lo + b * ((hi - lo) / 30), 5) AS low, COUNT(h.bin) AS n FROM e CROSS JOIN (SELECT UNNEST(RANGE(30)) AS b) k LEFT JOIN h ON h.bin = b GROUP BY 1, 2""")
def loss_histogram(i: Inputs) -> DataFrame:
    return metrics.histogram(index_losses(i), "loss_pct").withColumn("low", F.round("low", 5))


@check("log_loss_histogram", "fx_patches", sql=f"""WITH {LOSSES.strip()}, g AS (SELECT LOG10(GREATEST(ma, 1)) AS v FROM l), e AS (SELECT MIN(v) - CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS lo, MAX(v) + CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS hi FROM g),
    h AS (SELECT CAST(LEAST(29, FLOOR((v - lo) / ((hi - lo) / 30))) AS INT) AS bin FROM g, e)
    SELECT CAST(b AS INT) AS bin, ROUND(lo + b * ((hi - lo) / 30), 5) AS low, COUNT(h.bin) AS n FROM e CROSS JOIN (SELECT UNNEST(RANGE(30)) AS b) k LEFT JOIN h ON h.bin = b GROUP BY 1, 2""")
def log_loss_histogram(i: Inputs) -> DataFrame:
    logged = index_losses(i).withColumn("v", numbers.log10_floor1(F.col("loss_m2").cast("double")))
    return metrics.histogram(logged, "v").withColumn("low", F.round("low", 5))


CONFUSION = "c AS (SELECT CASE WHEN (nir - red) / (nir + red) > 0.4 THEN 1 ELSE 0 END AS truth, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS guess FROM fx_patches)"


def labelled(i: Inputs) -> DataFrame:
    return i.fx_patches.select(
        change.forest_mask(C["nir"], C["red"]).alias("truth"), change.threshold_mask(F.col("probability"), 0.5).alias("guess")
    )


@check("confusion_matrix", "fx_patches", sql=f"WITH {CONFUSION} SELECT truth, guess, COUNT(*) AS n FROM c GROUP BY 1, 2")
def confusion_matrix(i: Inputs) -> DataFrame:
    return metrics.confusion(labelled(i), "truth", "guess")


@check("class_iou", "fx_patches", sql=f"""WITH {CONFUSION} SELECT k AS label, ROUND(SUM(CASE WHEN truth = k AND guess = k THEN 1 ELSE 0 END) / SUM(CASE WHEN truth = k OR guess = k THEN 1 ELSE 0 END), 6) AS iou
    FROM c, (VALUES (0), (1)) AS v(k) GROUP BY 1""")
def class_iou(i: Inputs) -> DataFrame:
    return metrics.intersection_over_union(labelled(i), "truth", "guess").withColumn("iou", F.round("iou", 6))


@check("mean_iou", "fx_patches", sql=f"""WITH {CONFUSION}, q AS (SELECT k, SUM(CASE WHEN truth = k AND guess = k THEN 1 ELSE 0 END) / SUM(CASE WHEN truth = k OR guess = k THEN 1 ELSE 0 END) AS iou
    FROM c, (VALUES (0), (1)) AS v(k) GROUP BY 1) SELECT ROUND(AVG(iou), 6) AS mean_iou FROM q""")
def mean_iou(i: Inputs) -> DataFrame:
    return metrics.mean_iou(labelled(i), "truth", "guess").withColumn("mean_iou", F.round("mean_iou", 6))


@check("scene_selection", "fx_scenes", sql="""
    WITH f AS (SELECT * FROM fx_scenes WHERE cloud_pct <= 5 AND product = 'view' AND strftime(ts, '%m%d') BETWEEN '0101' AND '0630' AND year IN (2018, 2024)),
    n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tile, year ORDER BY ts DESC, scene_id DESC) AS r FROM f)
    SELECT tile, year, scene_id FROM n WHERE r = 1 AND tile IN (SELECT tile FROM f GROUP BY 1 HAVING COUNT(DISTINCT year) = 2)""")
def scene_selection(i: Inputs) -> DataFrame:
    return change.select_scenes(i.fx_scenes, [2018, 2024], 5.0, "view", "0101", "0630").drop("ts")


@check("newest_per_tile", "fx_scenes", sql="SELECT tile, scene_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tile ORDER BY ts DESC, scene_id DESC) AS r FROM fx_scenes) t WHERE r = 1")
def newest_per_tile(i: Inputs) -> DataFrame:
    return change.newest_per(i.fx_scenes, "tile", "ts", "scene_id")


@check("tiles_in_both_years", "fx_scenes", sql="SELECT tile FROM fx_scenes WHERE year = 2018 AND cloud_pct < 1 INTERSECT SELECT tile FROM fx_scenes WHERE year = 2024 AND cloud_pct < 1")
def tiles_in_both_years(i: Inputs) -> DataFrame:
    clear = F.col("cloud_pct") < 1
    return change.common_tiles(i.fx_scenes, clear & (F.col("year") == 2018), clear & (F.col("year") == 2024))


@check("keyed_diff", "fx_counts", sql="""
    WITH a AS (SELECT cell, CAST(SUM(cnt) AS BIGINT) AS v FROM fx_counts WHERE built < 20 GROUP BY 1), b AS (SELECT cell, CAST(SUM(cnt) AS BIGINT) AS v FROM fx_counts WHERE built > 20 GROUP BY 1)
    SELECT COALESCE(a.cell, b.cell) AS cell, a.v AS left_value, b.v AS right_value,
           CASE WHEN b.cell IS NULL THEN 'left_only' WHEN a.cell IS NULL THEN 'right_only' ELSE 'changed' END AS status
    FROM a FULL JOIN b ON a.cell = b.cell WHERE a.cell IS NULL OR b.cell IS NULL OR a.v <> b.v""")
def keyed_diff(i: Inputs) -> DataFrame:
    def side(condition):
        return i.fx_counts.filter(condition).groupBy("cell").agg(F.sum("cnt").alias("v"))

    return change.keyed_diff(side(F.col("built") < 20), side(F.col("built") > 20), ["cell"], "v")
