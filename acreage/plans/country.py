"""Country exposure: cells, zonal counts, storey distribution, summary and export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions import classes as cls
from acreage.operators import exposure, grid, polygons, zonal
from acreage.operators.ranking import global_order_id
from acreage.session import cut_lineage
from acreage.sources import sinks

CELL_KEYS, CELL_POSITION = exposure.CELL_KEYS, exposure.CELL_POSITION


def country_cells(edges: DataFrame, footprints: DataFrame, cell: float) -> DataFrame:
    """Grid cells whose centre lies in the country, with ids, bounds, lon/lat, tile and boundary flag.

    ``edges`` and ``footprints`` are in projected metres. The origin is the
    snapped corner of the tiles that meet the country; four numbers visit the
    driver. Cells come from scan lines, so empty parts of the extent cost nothing.
    """
    tiles = polygons.candidate_tiles(footprints, edges, cell * 50)
    corner = tiles.agg(F.min("minx"), F.min("miny")).first()
    if corner[0] is None:
        raise ValueError("no tile meets the country")
    x0, y0 = (float(int(v // cell) * cell) for v in corner)
    inside = polygons.fill_cells(edges, x0, y0, cell).select("i_idx", "j_idx").distinct()
    centred = inside.withColumns(
        {
            "centroid_x": F.lit(x0 + cell / 2.0) + F.col("i_idx") * F.lit(float(cell)),
            "centroid_y": F.lit(y0 + cell / 2.0) + F.col("j_idx") * F.lit(float(cell)),
            "grid_id": grid.grid_id(F.col("i_idx"), F.col("j_idx")),
        }
    )
    placed = grid.assign_footprint(grid.with_bounds(centred, cell), tiles, cell * 50)
    flagged = polygons.flag_boundary(placed, edges, x0, y0, cell)
    return grid.with_lonlat(flagged)


def masked_pixels(pixels: DataFrame, cells: DataFrame, edges: DataFrame, cell: float, x0: float, y0: float) -> DataFrame:
    """Pixels (tile_id, px, py, x, y, code) with their cell, those outside the country set to nodata."""
    keyed = pixels.withColumns(
        {
            "i_idx": grid.bucket(F.col("x") - F.lit(x0), cell),
            "j_idx": grid.bucket(F.col("y") - F.lit(y0), cell),
        }
    )
    joined = keyed.join(cells.select("i_idx", "j_idx", "grid_id", "is_boundary"), ["i_idx", "j_idx"])
    return polygons.mask_outside(joined, edges, cell, ["tile_id", "px", "py"], x0, y0)


def country_counts(pixels: DataFrame, edges: DataFrame, cell: float, x0: float, y0: float, nodata: int = 255) -> DataFrame:
    """(i_idx, j_idx, code, pixels, is_boundary) of the pixels inside the country, per cell and class.

    Cells are those whose centre is inside or that the border passes through.
    """
    border = polygons.boundary_cells(edges, x0, y0, cell)
    filled = polygons.fill_cells(edges, x0, y0, cell).select("i_idx", "j_idx")
    cells = filled.union(border).distinct().withColumn("grid_id", grid.grid_id(F.col("i_idx"), F.col("j_idx")))
    masked = masked_pixels(pixels, polygons.flag_boundary(cells, edges, x0, y0, cell), edges, cell, x0, y0)
    kept = masked.filter(F.col("code") != nodata)
    return kept.groupBy("i_idx", "j_idx", "code").agg(F.count(F.lit(1)).alias("pixels"), F.max("is_boundary").alias("is_boundary"))


def enriched(
    counts: DataFrame, props: DataFrame, tsi: DataFrame, keys: Sequence[str] = CELL_KEYS, carried: Sequence[str] = ()
) -> DataFrame:
    """Imputed profiles per non-empty cell and line of business."""
    cells = exposure.drop_empty_cells(exposure.pivot_counts(counts, keys, carried))
    return exposure.impute_shares(exposure.storey_profiles(cells, props, tsi))


def country_summary(counts: DataFrame, props: DataFrame, tsi: DataFrame, keys: Sequence[str] = CELL_KEYS) -> DataFrame:
    """Summary of buildings and values; shares are not summed, so nothing is imputed for it."""
    cells = exposure.pivot_counts(counts, keys)
    return exposure.area_summary(exposure.storey_profiles(cells, props, tsi))


def exposure_table(counts: DataFrame, props: DataFrame, tsi: DataFrame) -> DataFrame:
    """Wide exposure per cell with the lon/lat id and the position in lon, lat order."""
    profiles = enriched(counts, props, tsi, CELL_KEYS, CELL_POSITION)
    wide = exposure.wide_exposure(profiles, CELL_KEYS, CELL_POSITION)
    named = wide.withColumn("lonlat_id", exposure.lonlat_id(F.col("lon"), F.col("lat")))
    return global_order_id(named, ["lon", "lat", "grid_id"], "ID_ORDER_XY")


def export(counts: DataFrame, props: DataFrame, tsi: DataFrame, folder: str) -> None:
    """The exposure table, the three point views and the summary as CSV folders.

    The profiles are written once and feed all five outputs; the order is found
    on one row per cell.
    """
    profiles = cut_lineage(enriched(counts, props, tsi, CELL_KEYS, CELL_POSITION))
    cells = profiles.filter("lob = 'RES'").select("grid_id", "lon", "lat")
    ordered = global_order_id(cells, ["lon", "lat", "grid_id"], "ID_ORDER_XY").select("grid_id", "ID_ORDER_XY")
    placed = profiles.join(ordered, "grid_id")
    wide = exposure.wide_exposure(profiles, CELL_KEYS, CELL_POSITION)
    sinks.write_reports(
        {
            "exposure": wide.join(ordered, "grid_id"),
            **{
                f"view_{lob.lower()}": exposure.lob_view(placed, lob, "grid_id", "lon", "lat", "ID_ORDER_XY")
                for lob in cls.LOBS
            },
            "summary": exposure.area_summary(profiles),
        },
        folder,
    )


def counts_with_settlement(built: DataFrame, settlement: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long built counts with the settlement group of separately tiled rasters."""
    counts = zonal.class_counts_long(built, keys).drop("share").withColumnRenamed("valid_pixels", "built_total_valid_pixels")
    groups = zonal.settlement_groups(settlement, keys)
    return zonal.attach_settlement(counts, groups, keys)
