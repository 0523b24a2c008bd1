"""Vegetation change between two dates: masks, losses, method comparison, scene selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.joins import join_groups
from acreage.functions.numbers import clip
from acreage.functions.spectral import ndvi_clipped

# Reflectance scale, band order and mask thresholds.
REFLECTANCE_SCALE = 4000.0
BAND_ORDER = ["B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B11", "B12"]
NDVI_FOREST = 0.4
PROBABILITY_FOREST = 0.5
PIXEL_AREA_M2 = 100


def threshold_mask(value: Column, threshold: float) -> Column:
    """1 above the threshold, else 0; an undefined value is 0."""
    return F.coalesce((F.nanvl(value, F.lit(None).cast("double")) > threshold).cast("int"), F.lit(0))


def forest_mask(nir: Column, red: Column, threshold: float = NDVI_FOREST) -> Column:
    return threshold_mask(ndvi_clipped(nir, red), threshold)


def scale_bands(df: DataFrame, bands: Sequence[str], scale: float = REFLECTANCE_SCALE) -> DataFrame:
    """Reflectance columns divided by a fixed scale."""
    return df.withColumns({b: F.col(b) / F.lit(scale) for b in bands})


def standardise_fixed(df: DataFrame, bands: Sequence[str], means: Sequence[float], deviations: Sequence[float]) -> DataFrame:
    """z-scores with published band statistics."""
    return df.withColumns(
        {b: (F.col(b) - F.lit(float(m))) / F.lit(float(s)) for b, m, s in zip(bands, means, deviations, strict=True)}
    )


def stack_bands(bands: Sequence[str], scale: float = REFLECTANCE_SCALE) -> Column:
    """Model input of one pixel: scaled bands in fixed order as an array."""
    return F.array(*[F.col(b) / F.lit(scale) for b in bands])


def percentile_stretch(df: DataFrame, keys: Sequence[str], bands: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Per patch and band, map the 2nd..98th percentile to 0..1.

    The percentiles keep one counter per distinct band value of a patch, which
    the patch size bounds.
    """
    edges = df.groupBy(*keys).agg(
        *[F.percentile(b, F.array(F.lit(low), F.lit(high))).alias(f"_e_{b}") for b in bands]
    )
    joined = join_groups(df, edges, list(keys))

    def stretched(b: str) -> Column:
        edge = F.col(f"_e_{b}")
        return clip(F.try_divide(F.col(b) - edge[0], edge[1] - edge[0]), 0.0, 1.0)

    return joined.select(*[stretched(c).alias(c) if c in bands else F.col(c) for c in df.columns])


def scale_by_high(df: DataFrame, keys: Sequence[str], bands: Sequence[str], high: float = 0.98) -> DataFrame:
    """Per patch and band, divide by the 98th percentile."""
    edges = df.groupBy(*keys).agg(*[F.percentile(b, F.lit(high)).alias(f"_e_{b}") for b in bands])
    joined = join_groups(df, edges, list(keys))
    return joined.select(
        *[F.try_divide(F.col(c), F.col(f"_e_{c}")).alias(c) if c in bands else F.col(c) for c in df.columns]
    )


def pair_epochs(pixels: DataFrame, keys: Sequence[str], values: Sequence[str], epoch: str = "epoch") -> DataFrame:
    """One row per pixel seen in both epochs, values suffixed _t0 and _t1.

    A conditional aggregation: the pixels are shuffled once, where a self-join
    would read and shuffle them twice.
    """
    sides = [
        F.max(F.when(F.col(epoch) == e, F.col(v))).alias(f"{v}_t{e}") for e in (0, 1) for v in values
    ]
    seen = [F.count_if(F.col(epoch) == e).alias(f"_n{e}") for e in (0, 1)]
    paired = pixels.groupBy(*keys).agg(*sides, *seen)
    return paired.filter((F.col("_n0") > 0) & (F.col("_n1") > 0)).drop("_n0", "_n1")


def forest_loss(masks: DataFrame, patch: Sequence[str], mask: str = "mask", epoch: str = "epoch") -> DataFrame:
    """Forest pixels per epoch, loss in per cent (0 without forest before) and in square metres."""
    sums = masks.groupBy(*patch).agg(
        F.coalesce(F.sum(F.when(F.col(epoch) == 0, F.col(mask))), F.lit(0)).cast("bigint").alias("forest_t0"),
        F.coalesce(F.sum(F.when(F.col(epoch) == 1, F.col(mask))), F.lit(0)).cast("bigint").alias("forest_t1"),
    )
    lost = F.col("forest_t0") - F.col("forest_t1")
    return sums.withColumns(
        {
            "loss_pct": F.coalesce(F.try_divide(lost * 100.0, F.col("forest_t0")), F.lit(0.0)),
            "loss_m2": lost * PIXEL_AREA_M2,
        }
    )


def forest_losses(masks: DataFrame, patch: Sequence[str], names: Sequence[str], epoch: str = "epoch") -> DataFrame:
    """``forest_loss`` of several mask columns in one aggregation: {name}_loss_pct and {name}_loss_m2 per patch."""
    sums = masks.groupBy(*patch).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(epoch) == e, F.col(m))), F.lit(0)).cast("bigint").alias(f"_{m}{e}")
            for m in names
            for e in (0, 1)
        ]
    )
    out = {}
    for m in names:
        lost = F.col(f"_{m}0") - F.col(f"_{m}1")
        out[f"{m}_loss_pct"] = F.coalesce(F.try_divide(lost * 100.0, F.col(f"_{m}0")), F.lit(0.0))
        out[f"{m}_loss_m2"] = lost * PIXEL_AREA_M2
    return sums.select(*patch, *[c.alias(n) for n, c in out.items()])


def loss_summary(losses: DataFrame, above: float = 10.0) -> DataFrame:
    return losses.agg(
        F.sum("loss_m2").cast("bigint").alias("total_m2"),
        F.avg("loss_pct").alias("mean_pct"),
        F.max("loss_pct").alias("max_pct"),
        F.count_if(F.col("loss_pct") > above).alias("patches_above"),
    )


def compare_methods(a: DataFrame, b: DataFrame, patch: Sequence[str]) -> DataFrame:
    """Loss per cent of two methods side by side, their mean and absolute difference."""
    left = a.select(*patch, F.col("loss_pct").alias("pct_a"))
    right = b.select(*patch, F.col("loss_pct").alias("pct_b"))
    return left.join(right, list(patch)).withColumns(
        {
            "mean_pct": (F.col("pct_a") + F.col("pct_b")) / 2.0,
            "difference": F.abs(F.col("pct_a") - F.col("pct_b")),
        }
    )


def disagreement(compared: DataFrame, above: float = 20.0) -> DataFrame:
    return compared.agg(
        F.avg("difference").alias("mean_difference"),
        F.max("difference").alias("max_difference"),
        F.count_if(F.col("difference") > above).alias("patches_above"),
    )


def representative_patches(compared: DataFrame, key: str, n: int = 2, high: float = 15.0, low: float = 5.0) -> DataFrame:
    """n patches each of highest loss, lowest loss and largest method difference, ties by key.

    Patches beyond the thresholds come first; if fewer than n pass, the best
    available follow, which is the plain order by loss in both cases. Each pick
    is a bounded top-n.
    """
    def pick(category: str, *order: Column) -> DataFrame:
        chosen = compared.orderBy(*order, key).limit(n)
        place = F.row_number().over(Window.orderBy(*order, F.col(key)))  # n rows
        return chosen.select("*", F.lit(category).alias("category"), place.alias("place"))

    highest = pick("high_loss", F.desc(F.expr(f"mean_pct > {high}")), F.desc("mean_pct"))
    lowest = pick("low_loss", F.desc(F.expr(f"mean_pct < {low}")), F.asc("mean_pct"))
    return highest.unionByName(lowest).unionByName(pick("high_difference", F.desc("difference")))


def category_means(picks: DataFrame) -> DataFrame:
    return picks.groupBy("category").agg(
        F.avg("pct_a").alias("mean_a"), F.avg("pct_b").alias("mean_b"), F.avg("difference").alias("mean_difference")
    )


def select_scenes(
    scenes: DataFrame,
    years: Sequence[int],
    max_cloud: float,
    product: str,
    first_day: str,
    last_day: str,
    tile: str = "tile",
) -> DataFrame:
    """Newest scene per tile and year among cloud-free products inside the yearly window, for tiles seen in every year.

    ``first_day`` and ``last_day`` are 'MMdd'. The newest scene is a max_by
    aggregation, so a tile with very many scenes is reduced before the shuffle.
    """
    day = F.date_format("ts", "MMdd")
    fit = scenes.filter(
        F.col("year").isin(*years)
        & (F.col("cloud_pct") <= max_cloud)
        & (F.col("product") == product)
        & day.between(first_day, last_day)
    )
    newest = fit.groupBy(tile, "year").agg(
        F.max_by("scene_id", F.struct("ts", "scene_id")).alias("scene_id"), F.max("ts").alias("ts")
    )
    both = newest.groupBy(tile).agg(F.count(F.lit(1)).alias("_years")).filter(F.col("_years") == len(set(years)))
    return newest.join(both.select(tile), tile, "left_semi")


def newest_per(df: DataFrame, key: str, when: str, pick: str) -> DataFrame:
    """The ``pick`` value with the latest ``when`` per key, ties by the larger pick."""
    return df.groupBy(key).agg(F.max_by(pick, F.struct(when, pick)).alias(pick))


def common_tiles(df: DataFrame, first: Column, second: Column, tile: str = "tile") -> DataFrame:
    """Tiles present under both conditions."""
    return df.filter(first).select(tile).intersect(df.filter(second).select(tile))


def keyed_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows that differ between two keyed tables: status left_only, right_only or changed."""
    a = left.select(*keys, F.col(value).alias("left_value"), F.lit(1).alias("_l"))
    b = right.select(*keys, F.col(value).alias("right_value"), F.lit(1).alias("_r"))
    joined = a.join(b, list(keys), "full")
    status = (
        F.when(F.col("_r").isNull(), "left_only")
        .when(F.col("_l").isNull(), "right_only")
        .when(~F.col("left_value").eqNullSafe(F.col("right_value")), "changed")
    )
    return joined.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_l", "_r")


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the left relation that the right one lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")
