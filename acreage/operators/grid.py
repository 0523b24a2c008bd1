"""Regular grids: extents, cell centres, indices, tile assignment, pixel windows, patches."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.contracts import require_columns
from acreage.functions.projection import mollweide_to_lonlat
from acreage.session import broadcast_counted, spread


def snap_extent(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """One row x0, y0, x1, y1: the bounds of the points, moved outwards to multiples of the cell."""
    step = F.lit(float(cell))
    return points.agg(
        (F.floor(F.min(x) / step) * step).alias("x0"),
        (F.floor(F.min(y) / step) * step).alias("y0"),
        (F.ceil(F.max(x) / step) * step).alias("x1"),
        (F.ceil(F.max(y) / step) * step).alias("y1"),
    )


def cell_mesh(spark: SparkSession, bounds: tuple[float, float, float, float], cell: float) -> DataFrame:
    """All cell centres of a snapped extent, generated by executors from one distributed range."""
    x0, y0, x1, y1 = bounds
    columns, rows = max(0, math.ceil((x1 - x0) / cell)), max(0, math.ceil((y1 - y0) / cell))
    i, j = F.col("id") % F.lit(max(columns, 1)), F.floor(F.col("id") / F.lit(max(columns, 1)))
    return spark.range(columns * rows).select(
        i.cast("bigint").alias("i_idx"),
        j.cast("bigint").alias("j_idx"),
        (F.lit(x0 + cell / 2.0) + i * F.lit(float(cell))).alias("centroid_x"),
        (F.lit(y0 + cell / 2.0) + j * F.lit(float(cell))).alias("centroid_y"),
    )


def mesh_over(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """Mesh over the extent of a relation; only the four bounds visit the driver."""
    bounds = snap_extent(points, cell, x, y).first()
    if bounds is None or bounds["x0"] is None:
        return cell_mesh(points.sparkSession, (0.0, 0.0, 0.0, 0.0), cell)
    return cell_mesh(points.sparkSession, tuple(bounds), cell)


def cell_index(centre: Column, origin: float | Column, cell: float) -> Column:
    """Index of a cell centre; centres may carry rounding noise."""
    start = origin if isinstance(origin, Column) else F.lit(origin)
    return F.round((centre - (start + cell / 2.0)) / F.lit(float(cell))).cast("bigint")


def grid_id(i: Column, j: Column) -> Column:
    return F.concat(F.lit("G_"), j.cast("string"), F.lit("_"), i.cast("string"))


def with_cell_ids(cells: DataFrame, x0: float, y0: float, cell: float) -> DataFrame:
    indexed = cells.withColumns(
        {
            "i_idx": cell_index(F.col("centroid_x"), x0, cell),
            "j_idx": cell_index(F.col("centroid_y"), y0, cell),
        }
    )
    return indexed.withColumn("grid_id", grid_id(F.col("i_idx"), F.col("j_idx")))


def with_bounds(cells: DataFrame, cell: float) -> DataFrame:
    """Cell bounds from the centre; bounds that are already there are kept."""
    require_columns(cells, ["centroid_x", "centroid_y"], "cells")
    half = cell / 2.0
    bounds = {
        "grid_minx": F.col("centroid_x") - half,
        "grid_miny": F.col("centroid_y") - half,
        "grid_maxx": F.col("centroid_x") + half,
        "grid_maxy": F.col("centroid_y") + half,
    }
    if all(b in cells.columns for b in bounds):
        return cells
    return cells.withColumns(bounds)


def with_lonlat(cells: DataFrame, x: str = "centroid_x", y: str = "centroid_y") -> DataFrame:
    lon, lat = mollweide_to_lonlat(F.col(x), F.col(y))
    return cells.withColumns({"lon": lon, "lat": lat})


def bucket(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size)))


def assign_regular_tile(points: DataFrame, width: float, height: float, x: str, y: str) -> DataFrame:
    """Tile row and column where the footprints form a regular lattice: arithmetic, no join."""
    col, row = bucket(F.col(x), width), bucket(F.col(y), height)
    name = F.concat(F.lit("R"), row.cast("string"), F.lit("_C"), col.cast("string"))
    return points.withColumn("tile_id", name)


def assign_footprint(
    points: DataFrame, footprints: DataFrame, size: float, x: str = "centroid_x", y: str = "centroid_y"
) -> DataFrame:
    """Tile whose rectangle strictly contains the point; NULL if none, the lowest tile_id if several.

    Footprints (tile_id, minx, miny, maxx, maxy) are spread over buckets of side
    ``size``; of equal rectangles the lowest name is enough. Distinct positions
    meet the footprints of their bucket and keep the lowest name by a map-side
    minimum, however crowded a bucket is; rows then take the name of their
    position, so that repeated rows stay repeated.
    """
    rectangle = ["minx", "miny", "maxx", "maxy"]
    spread = (
        footprints.groupBy(*rectangle).agg(F.min("tile_id").alias("_tile"))
        .withColumn("_bx", F.explode(F.sequence(bucket(F.col("minx"), size), bucket(F.col("maxx"), size))))
        .withColumn("_by", F.explode(F.sequence(bucket(F.col("miny"), size), bucket(F.col("maxy"), size))))
    )
    spots = points.select(F.col(x).alias("_px"), F.col(y).alias("_py")).distinct()
    keyed = spots.withColumns({"_bx": bucket(F.col("_px"), size), "_by": bucket(F.col("_py"), size)})
    inside = (
        (F.col("_px") > F.col("minx")) & (F.col("_px") < F.col("maxx"))
        & (F.col("_py") > F.col("miny")) & (F.col("_py") < F.col("maxy"))
    )
    lowest = keyed.join(broadcast_counted(spread), ["_bx", "_by"]).filter(inside).groupBy("_px", "_py").agg(
        F.min("_tile").alias("tile_id")
    )
    joined = points.join(lowest, (points[x] == lowest["_px"]) & (points[y] == lowest["_py"]), "left")
    return joined.select(*[points[c] for c in points.columns], "tile_id")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``.

    A min_by aggregation with map-side partials, so a key that holds much of the
    relation is reduced before the shuffle instead of being sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(1)
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def pixel_cell(pixels: DataFrame, cell_pixels: int, px: str = "px", py: str = "py") -> DataFrame:
    """Cell column and row of a pixel by its centre."""
    return pixels.withColumns(
        {
            "ci": F.floor(F.col(px) / F.lit(cell_pixels)),
            "cj": F.floor(F.col(py) / F.lit(cell_pixels)),
        }
    )


def patches(pixels: DataFrame, size: int, width: Column | int, height: Column | int) -> DataFrame:
    """Non-overlapping square patches; pixels of an incomplete last row or column are dropped."""
    w = F.lit(width) if isinstance(width, int) else width
    h = F.lit(height) if isinstance(height, int) else height
    placed = pixels.withColumns(
        {"patch_i": F.floor(F.col("py") / F.lit(size)), "patch_j": F.floor(F.col("px") / F.lit(size))}
    )
    return placed.filter(
        (F.col("patch_i") < F.floor(h / F.lit(size))) & (F.col("patch_j") < F.floor(w / F.lit(size)))
    )


def tile_subset(df: DataFrame, tile: str | None = None, first: int | None = None) -> DataFrame:
    """Test mode: one tile, or the first tiles in name order; the filter stays a semi-join."""
    if tile is not None:
        return df.filter(F.col("tile_id") == tile)
    if first is None:
        return df
    chosen = distinct_tiles(df).orderBy("tile_id").limit(first)
    return df.join(F.broadcast(chosen), "tile_id", "left_semi") if first <= 100_000 else df.join(
        chosen, "tile_id", "left_semi"
    )


def distinct_tiles(df: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Tile names without NULL and blank ones."""
    return df.filter(F.col(tile).isNotNull() & (F.trim(F.col(tile)) != "")).select(tile).distinct()


def coalesce_pairs(df: DataFrame, columns: Sequence[str], left: str = "_x", right: str = "_y") -> DataFrame:
    """Fold the two copies that a join leaves of a column into one, the left copy first."""
    out = df
    for c in columns:
        both = [n for n in (f"{c}{left}", f"{c}{right}") if n in df.columns]
        if both:
            out = out.withColumn(c, F.coalesce(*[F.col(n) for n in both])).drop(*both)
    return out


# Side, in source pixels, of the blocks that are enlarged by one task.
UPSAMPLE_BLOCK = 64


def upsample_bilinear(pixels: DataFrame, width: int, height: int, factor: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """Align-corners bilinear enlargement of (keys, px, py, v).

    A target pixel t sits at t*(n-1)/(factor*n-1) in source pixels. Every source
    pixel is sent to the targets it contributes to, with its weight, and one
    aggregation adds the up to four parts of a target. Blocks of source pixels
    are dealt over all cores, so that most parts of a target meet in their task.
    """
    def targets(pos: Column, n: int) -> Column:
        ratio = (n - 1) / (factor * n - 1) if n > 1 else 0.0
        reach = F.lit(1.0 / ratio) if ratio else F.lit(float(factor))
        low = F.greatest(F.lit(0), F.ceil((pos - 1) * reach) if ratio else F.lit(0))
        high = F.least(F.lit(factor * n - 1), F.floor((pos + 1) * reach) if ratio else F.lit(factor * n - 1))
        return F.transform(
            F.sequence(low.cast("bigint"), high.cast("bigint")),
            lambda t: F.struct(
                t.alias("t"), F.greatest(F.lit(0.0), 1.0 - F.abs(t * F.lit(ratio) - pos)).alias("w")
            ),
        )

    block = [F.floor(F.col(c) / F.lit(UPSAMPLE_BLOCK)) for c in ("px", "py")]
    sent = (
        spread(pixels, *keys, *block).withColumn("_tx", F.explode(targets(F.col("px"), width)))
        .filter(F.col("_tx.w") > 0)
        .withColumn("_ty", F.explode(targets(F.col("py"), height)))
        .filter(F.col("_ty.w") > 0)
    )
    return sent.groupBy(*keys, F.col("_tx.t").alias("px"), F.col("_ty.t").alias("py")).agg(
        F.sum(F.col("v") * F.col("_tx.w") * F.col("_ty.w")).alias("v")
    )


def tile_manifest(tiles: DataFrame, present: DataFrame, datasets: dict[str, str]) -> DataFrame:
    """Every tile x dataset with status 'exists' or 'missing' and the address of a missing file.

    ``datasets`` maps a dataset to its address template with ``{tile_id}``; tiles
    are repeated by an array of that fixed list, not by a cross join.
    """
    names = F.array(
        *[F.struct(F.lit(d).alias("dataset"), F.lit(t).alias("_template")) for d, t in datasets.items()]
    )
    wanted = tiles.select("tile_id").distinct().select("tile_id", F.inline(names))
    here = present.select("tile_id", "dataset").distinct().withColumn("_here", F.lit(1))
    joined = wanted.join(here, ["tile_id", "dataset"], "left")
    missing = F.col("_here").isNull()
    return joined.select(
        "tile_id",
        "dataset",
        F.when(missing, "missing").otherwise("exists").alias("status"),
        F.when(missing, F.replace(F.col("_template"), F.lit("{tile_id}"), F.col("tile_id"))).alias("url"),
    )


def missing_tiles(tiles: DataFrame, present: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Tile x dataset pairs without a file."""
    wanted = tiles.select("tile_id").distinct().select(
        "tile_id", F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset")
    )
    return wanted.join(present.select("tile_id", "dataset").distinct(), ["tile_id", "dataset"], "left_anti")
