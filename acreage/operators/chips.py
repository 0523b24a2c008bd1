"""Image chips: cutting, validity, imputation, standardisation, augmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.joins import join_groups
from acreage.functions.numbers import nan_to_null, order_hash, uniform_from
from acreage.session import broadcast_counted

# Geometric variants of a chip: flips along either axis and turns by quarter circles.
VARIANTS = ["identity", "flip_rows", "flip_columns", "turn_90", "turn_180", "turn_270"]


def chip_stride(size: int, overlap: float) -> int:
    return int(size * (1 - overlap))


def chip_positions(length: int, size: int, stride: int) -> int:
    """Chips that fit along one axis."""
    return max(0, (length - size) // stride + 1)


def cut_chips(pixels: DataFrame, width: int, height: int, size: int = 24, stride: int = 21) -> DataFrame:
    """Copy every pixel into the overlapping chips that cover it.

    Adds the chip's row and column and the position inside it. A pixel lies in
    at most ceil(size / stride) squared chips; the rest of the image edge that
    no chip covers is dropped. No shuffle.
    """
    def covering(pos: Column, length: int) -> Column:
        first = F.greatest(F.lit(0), F.ceil((pos - (size - 1)) / F.lit(stride)))
        last = F.least(F.lit(chip_positions(length, size, stride) - 1), F.floor(pos / F.lit(stride)))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    placed = pixels.withColumn("chip_col", F.explode(covering(F.col("px"), width)))
    placed = placed.withColumn("chip_row", F.explode(covering(F.col("py"), height)))
    return placed.withColumns(
        {
            "cx": (F.col("px") - F.col("chip_col") * stride).cast("int"),
            "cy": (F.col("py") - F.col("chip_row") * stride).cast("int"),
        }
    )


def chip_centres(chips: DataFrame, origin_x: float, origin_y: float, pixel: float, size: int = 24, stride: int = 21) -> DataFrame:
    """Map position of the chip's centre pixel; rows run southwards from the origin."""
    col = F.col("chip_col") * stride + size // 2
    row = F.col("chip_row") * stride + size // 2
    return chips.withColumns(
        {"x": F.lit(origin_x) + (col + 0.5) * pixel, "y": F.lit(origin_y) - (row + 0.5) * pixel}
    )


def site_centres(points: DataFrame, site: str = "site", x: str = "x", y: str = "y") -> DataFrame:
    """Middle of each site's bounding box."""
    return points.groupBy(site).agg(
        ((F.min(x) + F.max(x)) / 2.0).alias("x"), ((F.min(y) + F.max(y)) / 2.0).alias("y")
    )


def chip_targets(pixels: DataFrame, chip: Sequence[str], target: str, minimum: float = 0.7, log: bool = True) -> DataFrame:
    """Valid fraction and mean target per chip, whether the chip is usable, and the (log) target."""
    value = nan_to_null(F.col(target))
    stats = pixels.groupBy(*chip).agg(
        F.avg(value.isNotNull().cast("double")).alias("valid_fraction"), F.avg(value).alias("mean_target")
    )
    usable = (F.col("valid_fraction") >= minimum) & F.coalesce(F.col("mean_target") > 0, F.lit(False))
    label = F.log(F.col("mean_target") + 1.0) if log else F.col("mean_target")
    return stats.withColumns({"usable": usable.cast("int"), "target": F.when(usable, label)})


def missing_fraction(bands: DataFrame, chip: Sequence[str], value: str = "v") -> DataFrame:
    return bands.groupBy(*chip).agg(
        F.avg(nan_to_null(F.col(value)).isNull().cast("double")).alias("missing_fraction")
    )


def impute_bands(
    bands: DataFrame, chip: Sequence[str], band: str = "band", value: str = "v", maximum: float = 0.3
) -> DataFrame:
    """Replace missing pixels by the median of their chip and band, 0 for a band without any.

    Chips with more than ``maximum`` missing pixels are dropped. Statistics are
    partial aggregates per (chip, band); the median keeps one counter per
    distinct value of a chip's band.
    """
    clean = bands.withColumn(value, nan_to_null(F.col(value)))
    stats = clean.groupBy(*chip, band).agg(
        F.median(value).alias("_median"), F.count(F.lit(1)).alias("_n"), F.count(value).alias("_ok")
    )
    kept = (
        stats.groupBy(*chip)
        .agg(((F.sum("_n") - F.sum("_ok")) / F.sum("_n")).alias("_missing"))
        .filter(F.col("_missing") <= maximum)
        .select(*chip)
    )
    medians = stats.select(*chip, band, "_median")
    medians = join_groups(medians, kept, list(chip), "left_semi")
    joined = join_groups(clean, medians, [*chip, band])
    filled = F.coalesce(F.col(value), F.col("_median"), F.lit(0.0))
    return joined.select(*[filled.alias(value) if c == value else F.col(c) for c in bands.columns])


def quality_funnel(targets: DataFrame, missing: DataFrame, chip: Sequence[str], maximum: float = 0.3) -> DataFrame:
    """Chips by outcome: discarded for the target or for missing bands, imputed, clean; with their share."""
    joined = targets.join(missing, list(chip), "left")
    gap = F.coalesce(F.col("missing_fraction"), F.lit(0.0))
    reason = (
        F.when(F.col("usable") == 0, "discarded_target")
        .when(gap > maximum, "discarded_missing")
        .when(gap > 0, "imputed")
        .otherwise("clean")
    )
    counted = joined.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("chips"))
    total = joined.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()
    return counted.withColumn("share", F.col("chips") / total)


def standardise_by_train(df: DataFrame, is_train: Column, band: str = "band", value: str = "v") -> DataFrame:
    """z-score per band with mean and population deviation of the training rows; undefined becomes 0.

    The statistics are one row per band and are counted before they are broadcast.
    """
    stats = df.filter(is_train).groupBy(band).agg(
        F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std")
    )
    joined = join_groups(df, broadcast_counted(stats), [band], "left")
    spread = F.when(F.col("_std") == 0, F.lit(1.0)).otherwise(F.col("_std"))
    z = F.coalesce(F.try_divide(F.col(value) - F.col("_mean"), spread), F.lit(0.0))
    return joined.select(*[z.alias(value) if c == value else F.col(c) for c in df.columns])


def coordinate_channels(df: DataFrame, width: int, height: int, px: str = "cx", py: str = "cy") -> DataFrame:
    """Position inside the chip from -1 to 1 along both axes."""
    return df.withColumns(
        {
            "x_channel": F.lit(-1.0) + F.col(px) * (2.0 / (width - 1)),
            "y_channel": F.lit(-1.0) + F.col(py) * (2.0 / (height - 1)),
        }
    )


def geometric_variants(df: DataFrame, size: int, variants: Sequence[str] = tuple(VARIANTS), px: str = "cx", py: str = "cy") -> DataFrame:
    """Every chip pixel once per variant, at its place in the flipped or turned chip. No shuffle."""
    x, y, end = F.col(px), F.col(py), F.lit(size - 1)
    places = {
        "identity": (x, y),
        "flip_rows": (x, end - y),
        "flip_columns": (end - x, y),
        "turn_90": (y, end - x),
        "turn_180": (end - x, end - y),
        "turn_270": (end - y, x),
    }
    rows = F.array(
        *[
            F.struct(F.lit(v).alias("variant"), places[v][0].cast("int").alias("_x"), places[v][1].cast("int").alias("_y"))
            for v in variants
        ]
    )
    rest = [c for c in df.columns if c not in (px, py)]
    return df.select(*rest, F.inline(rows)).withColumnsRenamed({"_x": px, "_y": py})


def spectral_jitter(
    df: DataFrame, chip: str, bands: int, band: str = "band", value: str = "v", seed: int = 0,
    brightness: float = 0.1, contrast: float = 0.1, probability: float = 0.5,
) -> DataFrame:
    """Change brightness and contrast of a few random bands of some chips by up to 10 %, each half of the time.

    A chip is changed with the given probability; then one to four or, with fewer
    than 18 bands, less than a third of its bands (one at least) are picked at
    random. Draws are functions of (chip, band, seed), so a rerun gives the
    same chips. Contrast turns around the band's mean after the brightness change.
    """
    upper = min(6, max(2, bands // 3))  # exclusive
    key = F.col(chip) * F.lit(bands) + F.col(band)
    means = df.groupBy(chip, band).agg(F.avg(value).alias("_mean"))
    # A chip has as many rows here as bands.
    place = F.row_number().over(Window.partitionBy(chip).orderBy(order_hash(key, seed + 1), band))
    wanted = 1 + order_hash(F.col(chip), seed) % F.lit(upper - 1)
    changed = (uniform_from(F.col(chip), seed + 6) < probability) & (place <= wanted)

    def factor(reach: float, offset: int) -> Column:
        drawn = 1.0 + (uniform_from(key, seed + offset) * 2.0 - 1.0) * reach
        return F.when(F.col("_on") & (uniform_from(key, seed + offset + 1) < 0.5), drawn).otherwise(F.lit(1.0))

    factors = means.withColumn("_on", changed).withColumns({"_b": factor(brightness, 2), "_c": factor(contrast, 4)})
    joined = join_groups(df, factors.drop("_on"), [chip, band])
    centre = F.col("_mean") * F.col("_b")
    result = (F.col(value) * F.col("_b") - centre) * F.col("_c") + centre
    return joined.select(*[result.alias(value) if c == value else F.col(c) for c in df.columns])
