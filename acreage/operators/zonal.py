"""Class counts and statistics of raster pixels per grid cell.

Every operator is one partial + final hash aggregation over the pixels: counts
per known class are conditional sums, so a cell with no pixel of a class keeps
its zero without a join against a class list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.contracts import require_columns
from acreage.functions import classes as cls
from acreage.session import spread
from acreage.sources.tiles import pixel_chunks, slim_strips

# Rows of cells of a tile whose strips are counted in one task.
BAND_CELLS = 16


def is_valid(code: Column, nodata: int = cls.NODATA) -> Column:
    """True for a pixel that carries a class: neither NULL nor the nodata code."""
    return code.isNotNull() & (code != nodata)


def drop_nodata(pixels: DataFrame, code: str = "code", nodata: int = cls.NODATA) -> DataFrame:
    return pixels.filter(is_valid(F.col(code), nodata))


def _measure(code: str, condition: Column, weight: str | None) -> Column:
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def class_counts_wide(
    pixels: DataFrame,
    keys: Sequence[str],
    code: str = "code",
    codes: Iterable[int] = cls.BUILT_CLASSES,
    prefix: str = "class_",
    weight: str | None = None,
) -> DataFrame:
    """One row per cell: a count per class, valid and nodata pixels.

    ``weight`` names a count column of pre-aggregated pixels.
    """
    require_columns(pixels, [*keys, code], "pixels")
    value = F.col(code)
    return pixels.groupBy(*keys).agg(
        *[_measure(code, value == k, weight).alias(f"{prefix}{k}") for k in codes],
        _measure(code, is_valid(value), weight).alias("valid_pixels"),
        _measure(code, value == cls.NODATA, weight).alias("nodata_pixels"),
    )


def class_counts_labelled(
    pixels: DataFrame, keys: Sequence[str], labels: dict[int, str], code: str = "code", prefix: str = "count_"
) -> DataFrame:
    """Wide counts whose columns carry the class label, made safe for a column name."""
    wide = class_counts_wide(pixels, keys, code, labels)
    names = {f"class_{k}": f"{prefix}{k}_{cls.column_safe_name(v)}" for k, v in labels.items()}
    return wide.withColumnsRenamed(names)


def class_counts_long(
    pixels: DataFrame,
    keys: Sequence[str],
    code: str = "code",
    codes: Sequence[int] = tuple(cls.BUILT_CLASSES),
    weight: str | None = None,
) -> DataFrame:
    """One row per cell x class, zeros kept, with the share of valid pixels (NULL if there are none)."""
    wide = class_counts_wide(pixels, keys, code, codes, weight=weight)
    pairs = F.array(*[F.struct(F.lit(k).alias("built"), F.col(f"class_{k}").alias("count")) for k in codes])
    long = wide.select(*keys, "valid_pixels", "nodata_pixels", F.inline(pairs))
    share = F.when(F.col("valid_pixels") > 0, F.col("count") / F.col("valid_pixels"))
    return long.withColumn("share", share)


def zonal_stats(pixels: DataFrame, keys: Sequence[str], code: str = "code") -> DataFrame:
    """Mean, median, max, min, population deviation, sum, count and coverage of valid pixels.

    The exact median keeps one counter per distinct code, at most 255 for byte rasters.
    """
    valid = F.when(is_valid(F.col(code)), F.col(code))
    return pixels.groupBy(*keys).agg(
        F.avg(valid).alias("mean"),
        F.median(valid).alias("median"),
        F.max(valid).alias("max"),
        F.min(valid).alias("min"),
        F.stddev_pop(valid).alias("std"),
        F.sum(valid).cast("bigint").alias("sum"),
        F.count(valid).alias("pixel_count"),
        (F.count(valid) * 100.0 / F.count(F.lit(1))).alias("coverage"),
    )


def dominant_class(pixels: DataFrame, keys: Sequence[str], code: str = "code") -> DataFrame:
    """Most frequent valid class per cell, the lowest code on a tie; NULL class and 0 where all is nodata.

    Counts per (cell, class) come first, so a cell is decided from at most 255 rows.
    """
    counted = pixels.groupBy(*keys, code).agg(F.count(F.lit(1)).alias("_n"))
    valid = is_valid(F.col(code))
    best = counted.groupBy(*keys).agg(
        F.max(F.when(valid, F.struct(F.col("_n").alias("n"), (-F.col(code)).alias("neg")))).alias("_best"),
        F.coalesce(F.sum(F.when(valid, F.col("_n"))), F.lit(0)).alias("valid_pixels"),
    )
    return best.select(
        *keys,
        (-F.col("_best.neg")).cast("int").alias("dominant_class"),
        F.coalesce(F.col("_best.n"), F.lit(0)).alias("dominant_count"),
        F.coalesce(F.col("_best.n") * 100.0 / F.nullif(F.col("valid_pixels"), F.lit(0)), F.lit(0.0)).alias(
            "dominant_percentage"
        ),
        F.col("valid_pixels"),
    )


def coverage(pixels: DataFrame, keys: Sequence[str], code: str = "code") -> DataFrame:
    valid = is_valid(F.col(code))
    return pixels.groupBy(*keys).agg(
        F.count_if(valid).alias("valid_pixels"),
        F.count_if(~valid).alias("nodata_pixels"),
        (F.count_if(valid) * 100.0 / F.count(F.lit(1))).alias("coverage"),
    )


def settlement_groups(pixels: DataFrame, keys: Sequence[str], code: str = "smod") -> DataFrame:
    """Pixels per settlement group, the dominant group (lowest on a tie, NULL if none) and group shares."""
    group = cls.settlement_group(F.col(code))
    counted = pixels.groupBy(*keys).agg(*[F.count_if(group == g).alias(f"group_{g}") for g in range(3)])
    g0, g1, g2 = (F.col(f"group_{g}") for g in range(3))
    total = g0 + g1 + g2
    top = F.greatest(g0, g1, g2)
    urban = F.when(total > 0, F.when(g0 == top, 0).when(g1 == top, 1).otherwise(2)).cast("int")
    return counted.select(
        *keys,
        g0,
        g1,
        g2,
        total.alias("smod_total_valid_pixels"),
        urban.alias("urban"),
        *[F.try_divide(g, total).alias(f"share_{i}") for i, g in enumerate((g0, g1, g2))],
    )


def attach_settlement(counts: DataFrame, settlement: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Left-join the settlement group; without settlement data the columns are typed NULLs.

    Repeated keys on the settlement side collapse to their lowest group.
    """
    if settlement is None:
        return counts.withColumns(
            {
                "urban": F.lit(None).cast("int"),
                "smod_total_valid_pixels": F.lit(None).cast("bigint"),
            }
        )
    once = settlement.groupBy(*keys).agg(
        F.min(F.struct("urban", "smod_total_valid_pixels")).alias("_s")
    )
    return counts.join(
        once.select(*keys, "_s.urban", "_s.smod_total_valid_pixels"), list(keys), "left"
    )


def merge_datasets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge of two per-cell results; other shared columns keep the first non-NULL value."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    joined = left.join(renamed, list(keys), "full")
    merged = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_r_{c}")) for c in shared})
    return merged.drop(*[f"_r_{c}" for c in shared])


def cell_counts(
    pixels: DataFrame, keys: Sequence[str], built: str = "code", smod: str = "smod"
) -> DataFrame:
    """Long built-class counts with the settlement group, from one pass over pixels that carry both codes."""
    value, group = F.col(built), cls.settlement_group(F.col(smod))
    wide = pixels.groupBy(*keys).agg(
        *[F.count_if(value == k).alias(f"class_{k}") for k in cls.BUILT_CLASSES],
        F.count_if(is_valid(value)).alias("built_total_valid_pixels"),
        *[F.count_if(group == g).alias(f"_g{g}") for g in range(3)],
    )
    top = F.greatest("_g0", "_g1", "_g2")
    urban = F.when(
        top > 0, F.when(F.col("_g0") == top, 0).when(F.col("_g1") == top, 1).otherwise(2)
    ).cast("int")
    pairs = F.array(
        *[F.struct(F.lit(k).alias("built"), F.col(f"class_{k}").alias("count")) for k in cls.BUILT_CLASSES]
    )
    return wide.select(
        *keys,
        "built_total_valid_pixels",
        (F.col("_g0") + F.col("_g1") + F.col("_g2")).alias("smod_total_valid_pixels"),
        urban.alias("urban"),
        F.inline(pairs),
    )


def run_report(cells: DataFrame, value: str, pixels: str = "pixel_count", tile: str = "tile") -> DataFrame:
    """Cells, cells with data, coverage per cent, mean value, and tiles with and without data."""
    per_tile = cells.groupBy(tile).agg(
        F.count(F.lit(1)).alias("_cells"),
        F.count_if(F.col(pixels) > 0).alias("_valid"),
        F.sum(value).alias("_sum"),
        F.count(value).alias("_n"),
    )
    return per_tile.agg(
        F.sum("_cells").cast("bigint").alias("cells"),
        F.sum("_valid").cast("bigint").alias("valid_cells"),
        (F.sum("_valid") * 100.0 / F.sum("_cells")).alias("coverage"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean_value"),
        F.count_if(F.col("_valid") > 0).alias("tiles_ok"),
        F.count_if(F.col("_valid") == 0).alias("tiles_failed"),
    )


def class_counts_from_tiles(
    tiles: DataFrame, cell_pixels: int, codes: Iterable[int] = cls.BUILT_CLASSES
) -> DataFrame:
    """Long counts straight from raw-byte raster strips, without a row per pixel.

    Strips are reduced to (cell, code, n) where they are decoded; only those
    partial counts are shuffled. ``tiles`` holds tile_id, row0 (first pixel row
    of the strip), width and data. Strips are dealt over all cores first, bands
    of a tile together: files are split by bytes, and well compressed strips
    hold many cells a byte, all of which a task would count at once.
    """

    def reduce_strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, px, py, code in pixel_chunks(batch):
                names, slot = np.unique(tile, return_inverse=True)
                ci, cj = px // cell_pixels, py // cell_pixels
                wide, high = int(ci.max()) + 1, int(cj.max()) + 1
                key, n = np.unique(((slot * high + cj) * wide + ci) * 256 + code, return_counts=True)
                cell = key // 256
                yield pa.RecordBatch.from_pydict(
                    {
                        "tile_id": pa.array(names[cell // (wide * high)], pa.int64()),
                        "ci": pa.array(cell % wide, pa.int64()),
                        "cj": pa.array(cell // wide % high, pa.int64()),
                        "code": pa.array((key % 256).astype(np.int32), pa.int32()),
                        "n": pa.array(n, pa.int64()),
                    }
                )

    schema = "tile_id bigint, ci bigint, cj bigint, code int, n bigint"
    dealt = spread(slim_strips(tiles), "tile_id", F.floor(F.col("row0") / F.lit(BAND_CELLS * cell_pixels)))
    partial = dealt.mapInArrow(reduce_strips, schema)
    return class_counts_long(partial, ["tile_id", "ci", "cj"], "code", tuple(codes), weight="n")
