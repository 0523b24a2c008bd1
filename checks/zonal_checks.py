"""Zonal counts and statistics of classified pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions import classes as cls
from acreage.operators import grid, zonal
from acreage.sources import tiles
from checks.base import Inputs, check

CELL = ["tile", "ci", "cj"]
COUNTS = ", ".join(f"CAST(SUM(CASE WHEN code = {c} THEN 1 ELSE 0 END) AS BIGINT) AS class_{c}" for c in cls.BUILT_CLASSES)
VALID = "CAST(SUM(CASE WHEN code <> 255 THEN 1 ELSE 0 END) AS BIGINT)"
NODATA = "CAST(SUM(CASE WHEN code = 255 THEN 1 ELSE 0 END) AS BIGINT)"
CLASS_LIST = ", ".join(f"({c})" for c in cls.BUILT_CLASSES)


@check("class_counts_wide", "fx_pixels", sql=f"SELECT tile, ci, cj, {COUNTS}, {VALID} AS valid_pixels, {NODATA} AS nodata_pixels FROM fx_pixels GROUP BY 1, 2, 3")
def class_counts_wide(i: Inputs) -> DataFrame:
    return zonal.class_counts_wide(i.fx_pixels, CELL)


@check("class_counts_long", "fx_pixels", sql=f"""
    WITH cells AS (SELECT tile, ci, cj, {VALID} AS valid_pixels, {NODATA} AS nodata_pixels FROM fx_pixels GROUP BY 1, 2, 3),
    seen AS (SELECT tile, ci, cj, code, COUNT(*) AS n FROM fx_pixels GROUP BY 1, 2, 3, 4)
    SELECT c.tile, c.ci, c.cj, k.built, COALESCE(s.n, 0) AS count, c.valid_pixels, c.nodata_pixels,
           ROUND(CASE WHEN c.valid_pixels > 0 THEN COALESCE(s.n, 0) / c.valid_pixels END, 6) AS share
    FROM cells c CROSS JOIN (VALUES {CLASS_LIST}) AS k(built)
    LEFT JOIN seen s ON s.tile = c.tile AND s.ci = c.ci AND s.cj = c.cj AND s.code = k.built""")
def class_counts_long(i: Inputs) -> DataFrame:
    return zonal.class_counts_long(i.fx_pixels, CELL).withColumn("share", F.round("share", 6))


@check("class_counts_labelled", "fx_pixels", sql="""
    SELECT tile, ci, cj, CAST(SUM(CASE WHEN code = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "count_0_Non-built",
           CAST(SUM(CASE WHEN code = 15 THEN 1 ELSE 0 END) AS BIGINT) AS "count_15_Residential_gt30m",
           CAST(SUM(CASE WHEN code = 22 THEN 1 ELSE 0 END) AS BIGINT) AS "count_22_Non-residential_3-6m" FROM fx_pixels GROUP BY 1, 2, 3""")
def class_counts_labelled(i: Inputs) -> DataFrame:
    out = zonal.class_counts_labelled(i.fx_pixels, CELL, cls.BUILT_LABELS)
    return out.select(*CELL, "`count_0_Non-built`", "`count_15_Residential_gt30m`", "`count_22_Non-residential_3-6m`")


@check("class_labels", "fx_pixels", sql="""
    SELECT code, CASE code WHEN 0 THEN 'Non-built' WHEN 11 THEN 'Residential ≤3m' WHEN 12 THEN 'Residential 3-6m' WHEN 13 THEN 'Residential 6-15m'
      WHEN 14 THEN 'Residential 15-30m' WHEN 15 THEN 'Residential >30m' WHEN 21 THEN 'Non-residential ≤3m' WHEN 22 THEN 'Non-residential 3-6m'
      WHEN 23 THEN 'Non-residential 6-15m' WHEN 24 THEN 'Non-residential 15-30m' WHEN 25 THEN 'Non-residential >30m' WHEN 255 THEN 'NoData' ELSE 'Other' END AS label,
      REPLACE(REPLACE(CASE smod WHEN 10 THEN 'Water' WHEN 11 THEN 'Very Low Density Rural' WHEN 12 THEN 'Low Density Rural' WHEN 13 THEN 'Rural Cluster'
      WHEN 21 THEN 'Suburban' WHEN 30 THEN 'Urban Centre' WHEN 255 THEN 'NoData' ELSE 'Other' END, ' ', '_'), '>', 'gt') AS smod_name, COUNT(*) AS n
    FROM fx_pixels GROUP BY 1, 2, 3""")
def class_labels(i: Inputs) -> DataFrame:
    return i.fx_pixels.groupBy(
        "code",
        cls.label_of(F.col("code"), cls.BUILT_LABELS).alias("label"),
        cls.column_safe(cls.label_of(F.col("smod"), cls.SETTLEMENT_LABELS)).alias("smod_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("settlement_reclass", "fx_pixels", sql="""SELECT smod, CASE WHEN smod IN (30, 23) THEN 2 WHEN smod IN (22, 21) THEN 1 WHEN smod IN (0, 10, 11, 12, 13) THEN 0 END AS grp,
    COUNT(*) AS n FROM fx_pixels GROUP BY 1, 2""")
def settlement_reclass(i: Inputs) -> DataFrame:
    return i.fx_pixels.groupBy("smod", cls.settlement_group(F.col("smod")).alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@check("nodata_filter", "fx_pixels", sql="SELECT tile, code, COUNT(*) AS n FROM fx_pixels WHERE code <> 255 GROUP BY 1, 2")
def nodata_filter(i: Inputs) -> DataFrame:
    return zonal.drop_nodata(i.fx_pixels).groupBy("tile", "code").agg(F.count(F.lit(1)).alias("n"))


@check("pixel_to_cell", "fx_pixels", sql="SELECT tile, CAST(FLOOR(px / 200) AS BIGINT) AS ci, CAST(FLOOR(py / 200) AS BIGINT) AS cj, COUNT(*) AS n FROM fx_pixels GROUP BY 1, 2, 3")
def pixel_to_cell(i: Inputs) -> DataFrame:
    placed = grid.pixel_cell(i.fx_pixels.select("tile", "px", "py"), 200)
    return placed.groupBy("tile", "ci", "cj").agg(F.count(F.lit(1)).alias("n"))


@check("zonal_stats", "fx_pixels", sql="""
    SELECT tile, ci, cj, ROUND(AVG(v), 6) AS mean, ROUND(MEDIAN(v), 6) AS median, MAX(v) AS max, MIN(v) AS min, ROUND(STDDEV_POP(v), 6) AS std,
           CAST(SUM(v) AS BIGINT) AS sum, COUNT(v) AS pixel_count, ROUND(COUNT(v) * 100.0 / COUNT(*), 6) AS coverage
    FROM (SELECT *, CASE WHEN code <> 255 THEN code END AS v FROM fx_pixels) t GROUP BY 1, 2, 3""")
def zonal_stats(i: Inputs) -> DataFrame:
    out = zonal.zonal_stats(i.fx_pixels, CELL)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std", "coverage")})


@check("dominant_class", "fx_pixels", sql="""
    WITH n AS (SELECT tile, ci, cj, code, COUNT(*) AS n FROM fx_pixels WHERE code <> 255 GROUP BY 1, 2, 3, 4),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tile, ci, cj ORDER BY n DESC, code) AS r, SUM(n) OVER (PARTITION BY tile, ci, cj) AS t FROM n)
    SELECT c.tile, c.ci, c.cj, r.code AS dominant_class, COALESCE(r.n, 0) AS dominant_count,
           ROUND(COALESCE(r.n * 100.0 / r.t, 0), 6) AS dominant_percentage, CAST(COALESCE(r.t, 0) AS BIGINT) AS valid_pixels
    FROM (SELECT DISTINCT tile, ci, cj FROM fx_pixels) c LEFT JOIN r ON r.tile = c.tile AND r.ci = c.ci AND r.cj = c.cj AND r.r = 1""")
def dominant_class(i: Inputs) -> DataFrame:
    out = zonal.dominant_class(i.fx_pixels, CELL)
    return out.withColumn("dominant_percentage", F.round("dominant_percentage", 6))


@check("pixel_coverage", "fx_pixels", sql=f"SELECT tile, ci, cj, {VALID} AS valid_pixels, {NODATA} AS nodata_pixels, ROUND({VALID} * 100.0 / COUNT(*), 6) AS coverage FROM fx_pixels GROUP BY 1, 2, 3")
def pixel_coverage(i: Inputs) -> DataFrame:
    return zonal.coverage(i.fx_pixels, CELL).withColumn("coverage", F.round("coverage", 6))


GROUPS = """
    g AS (SELECT tile, ci, cj, CAST(SUM(CASE WHEN smod IN (0, 10, 11, 12, 13) THEN 1 ELSE 0 END) AS BIGINT) AS group_0,
                 CAST(SUM(CASE WHEN smod IN (21, 22) THEN 1 ELSE 0 END) AS BIGINT) AS group_1,
                 CAST(SUM(CASE WHEN smod IN (23, 30) THEN 1 ELSE 0 END) AS BIGINT) AS group_2 FROM fx_pixels GROUP BY 1, 2, 3),
    s AS (SELECT *, group_0 + group_1 + group_2 AS smod_total_valid_pixels,
                 CASE WHEN group_0 + group_1 + group_2 = 0 THEN NULL WHEN group_0 >= group_1 AND group_0 >= group_2 THEN 0
                      WHEN group_1 >= group_2 THEN 1 ELSE 2 END AS urban FROM g)
"""


@check("settlement_groups", "fx_pixels", sql=f"""WITH {GROUPS.strip()}
    SELECT tile, ci, cj, group_0, group_1, group_2, smod_total_valid_pixels, urban, ROUND(group_0 / NULLIF(smod_total_valid_pixels, 0), 6) AS share_0,
           ROUND(group_1 / NULLIF(smod_total_valid_pixels, 0), 6) AS share_1, ROUND(group_2 / NULLIF(smod_total_valid_pixels, 0), 6) AS share_2 FROM s""")
def settlement_groups(i: Inputs) -> DataFrame:
    out = zonal.settlement_groups(i.fx_pixels, CELL)
    return out.withColumns({f"share_{k}": F.round(f"share_{k}", 6) for k in range(3)})


LONG = f"""
    b AS (SELECT c.tile, c.ci, c.cj, k.built, COALESCE(n.n, 0) AS count, c.valid_pixels
          FROM (SELECT tile, ci, cj, {VALID} AS valid_pixels FROM fx_pixels GROUP BY 1, 2, 3) c CROSS JOIN (VALUES {CLASS_LIST}) AS k(built)
          LEFT JOIN (SELECT tile, ci, cj, code, COUNT(*) AS n FROM fx_pixels GROUP BY 1, 2, 3, 4) n
            ON n.tile = c.tile AND n.ci = c.ci AND n.cj = c.cj AND n.code = k.built)
"""


@check("counts_with_settlement", "fx_pixels", sql=f"""WITH {GROUPS.strip()}, {LONG.strip()}
    SELECT b.tile, b.ci, b.cj, b.built, b.count, b.valid_pixels, s.urban, s.smod_total_valid_pixels
    FROM b LEFT JOIN s ON s.tile = b.tile AND s.ci = b.ci AND s.cj = b.cj AND s.smod_total_valid_pixels > 30""")
def counts_with_settlement(i: Inputs) -> DataFrame:
    built = zonal.class_counts_long(i.fx_pixels, CELL).drop("share", "nodata_pixels")
    groups = zonal.settlement_groups(i.fx_pixels, CELL).filter(F.col("smod_total_valid_pixels") > 30)
    # The settlement side arrives twice, as overlapping tiles deliver it.
    return zonal.attach_settlement(built, groups.unionByName(groups), CELL)


@check("counts_without_settlement", "fx_pixels", sql=f"""WITH {LONG.strip()}
    SELECT tile, ci, cj, built, count, valid_pixels, CAST(NULL AS INT) AS urban, CAST(NULL AS BIGINT) AS smod_total_valid_pixels FROM b""")
def counts_without_settlement(i: Inputs) -> DataFrame:
    built = zonal.class_counts_long(i.fx_pixels, CELL).drop("share", "nodata_pixels")
    return zonal.attach_settlement(built, None, CELL)


@check("cell_counts_one_pass", "fx_pixels", sql=f"""WITH {GROUPS.strip()}, {LONG.strip()}
    SELECT b.tile, b.ci, b.cj, b.valid_pixels AS built_total_valid_pixels, s.smod_total_valid_pixels, s.urban, b.built, b.count
    FROM b JOIN s ON s.tile = b.tile AND s.ci = b.ci AND s.cj = b.cj""")
def cell_counts_one_pass(i: Inputs) -> DataFrame:
    return zonal.cell_counts(i.fx_pixels, CELL)


@check("dataset_merge", "fx_pixels", sql="""
    WITH a AS (SELECT tile, ci, cj, COUNT(*) AS built_pixels FROM fx_pixels WHERE code > 10 AND code < 255 GROUP BY 1, 2, 3),
    b AS (SELECT tile, ci, cj, COUNT(*) AS centre_pixels FROM fx_pixels WHERE smod = 30 GROUP BY 1, 2, 3)
    SELECT COALESCE(a.tile, b.tile) AS tile, COALESCE(a.ci, b.ci) AS ci, COALESCE(a.cj, b.cj) AS cj, built_pixels, centre_pixels
    FROM a FULL JOIN b ON a.tile = b.tile AND a.ci = b.ci AND a.cj = b.cj""")
def dataset_merge(i: Inputs) -> DataFrame:
    n = F.count(F.lit(1))
    a = i.fx_pixels.filter((F.col("code") > 10) & (F.col("code") < 255)).groupBy(*CELL).agg(n.alias("built_pixels"))
    b = i.fx_pixels.filter(F.col("smod") == 30).groupBy(*CELL).agg(n.alias("centre_pixels"))
    return zonal.merge_datasets(a, b, CELL)


@check("coalesced_columns", sql="""SELECT c.c_custkey, COALESCE(c.c_nationkey, s.s_nationkey) AS nationkey FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey""")
def coalesced_columns(i: Inputs) -> DataFrame:
    c, s = i.table("customer"), i.table("supplier")
    joined = c.join(s, c["c_custkey"] == s["s_suppkey"], "left").select(
        "c_custkey", F.col("c_nationkey").alias("nationkey_x"), F.col("s_nationkey").alias("nationkey_y")
    )
    return grid.coalesce_pairs(joined, ["nationkey"])


@check("tile_union", "fx_pixels", sql="SELECT tile, code, COUNT(*) AS n, COUNT(smod) AS with_smod FROM (SELECT tile, code, smod FROM fx_pixels UNION ALL SELECT tile, code, NULL FROM fx_pixels) t GROUP BY 1, 2")
def tile_union(i: Inputs) -> DataFrame:
    both = i.fx_pixels.select("tile", "code", "smod").unionByName(i.fx_pixels.select("code", "tile"), allowMissingColumns=True)
    return both.groupBy("tile", "code").agg(F.count(F.lit(1)).alias("n"), F.count("smod").alias("with_smod"))


@check("zonal_run_report", "fx_pixels", sql="""
    WITH c AS (SELECT tile, ci, cj, SUM(CASE WHEN code <> 255 THEN code END) / COUNT(CASE WHEN code <> 255 THEN 1 END) AS mean,
                      SUM(CASE WHEN code <> 255 THEN 1 ELSE 0 END) AS n FROM fx_pixels GROUP BY 1, 2, 3)
    SELECT COUNT(*) AS cells, CAST(SUM(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS valid_cells,
           ROUND(SUM(CASE WHEN n > 0 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) AS coverage, ROUND(AVG(mean), 6) AS mean_value,
           (SELECT COUNT(DISTINCT tile) FROM c WHERE n > 0) AS tiles_ok,
           (SELECT COUNT(*) FROM (SELECT tile FROM c GROUP BY tile HAVING MAX(n) = 0)) AS tiles_failed FROM c""")
def zonal_run_report(i: Inputs) -> DataFrame:
    out = zonal.run_report(zonal.zonal_stats(i.fx_pixels, CELL), "mean")
    return out.withColumns({c: F.round(c, 6) for c in ("coverage", "mean_value")})


@check("distinct_tiles", "fx_counts", sql="SELECT DISTINCT tile_id FROM fx_counts")
def distinct_tiles(i: Inputs) -> DataFrame:
    blank = i.fx_counts.select(F.when(F.col("cell") % 2 == 0, F.col("tile_id")).otherwise(F.lit(" ")).alias("tile_id"))
    return grid.distinct_tiles(i.fx_counts.select("tile_id").unionByName(blank))


@check("tile_subset", "fx_counts", sql="""SELECT tile_id, CAST(SUM(cnt) AS BIGINT) AS n FROM fx_counts
    WHERE tile_id IN (SELECT DISTINCT tile_id FROM fx_counts ORDER BY 1 LIMIT 2) GROUP BY 1""")
def tile_subset(i: Inputs) -> DataFrame:
    return grid.tile_subset(i.fx_counts, first=2).groupBy("tile_id").agg(F.sum("cnt").alias("n"))


# One small raw-byte raster per part: 12 x 8 pixels whose bytes follow from the key.
def byte_tiles(i: Inputs) -> DataFrame:
    byte = F.transform(
        F.sequence(F.lit(0), F.lit(12 * 8 - 1)),
        lambda k: F.lpad(F.hex((F.col("p_partkey") * 31 + k * 7 + F.col("p_size") * F.floor(k / 12)) % 26), 2, "0"),
    )
    return i.table("part").select(
        F.col("p_partkey").alias("tile_id"), F.lit(12).alias("width"), F.lit(8).alias("height"),
        F.unhex(F.array_join(byte, "")).alias("data"),
    )


BYTES = """bytes AS (SELECT p_partkey AS tile_id, CAST(k % 12 AS BIGINT) AS px, CAST(FLOOR(k / 12) AS BIGINT) AS py,
    CAST((p_partkey * 31 + k * 7 + p_size * CAST(FLOOR(k / 12) AS BIGINT)) % 26 AS INT) AS code FROM part CROSS JOIN (SELECT UNNEST(RANGE(96)) AS k) r)"""


@check("raster_tile_pixels", sql=f"WITH {BYTES} SELECT tile_id, px, py, code FROM bytes WHERE code <> 13")
def raster_tile_pixels(i: Inputs) -> DataFrame:
    return tiles.decode_pixels(tiles.split_strips(byte_tiles(i), 3), nodata=13)


@check("raster_tile_counts", sql=f"""WITH {BYTES}, cells AS (SELECT tile_id, CAST(FLOOR(px / 4) AS BIGINT) AS ci, CAST(FLOOR(py / 4) AS BIGINT) AS cj, code FROM bytes)
    SELECT c.tile_id, c.ci, c.cj, k.built, c.valid_pixels, c.nodata_pixels, COALESCE(s.n, 0) AS count, ROUND(COALESCE(s.n, 0) / c.valid_pixels, 6) AS share
    FROM (SELECT tile_id, ci, cj, COUNT(*) AS valid_pixels, CAST(0 AS BIGINT) AS nodata_pixels FROM cells GROUP BY 1, 2, 3) c
    CROSS JOIN (VALUES {CLASS_LIST}) AS k(built)
    LEFT JOIN (SELECT tile_id, ci, cj, code, COUNT(*) AS n FROM cells GROUP BY 1, 2, 3, 4) s
      ON s.tile_id = c.tile_id AND s.ci = c.ci AND s.cj = c.cj AND s.code = k.built""")
def raster_tile_counts(i: Inputs) -> DataFrame:
    out = zonal.class_counts_from_tiles(tiles.split_strips(byte_tiles(i), 3), 4)
    return out.withColumn("share", F.round("share", 6))


@check("raster_window_read", sql=f"WITH {BYTES} SELECT tile_id, COUNT(*) AS n, MIN(py) AS first_row, MAX(py) AS last_row FROM bytes WHERE py BETWEEN 2 AND 5 GROUP BY 1")
def raster_window_read(i: Inputs) -> DataFrame:
    strips = tiles.strips_in_window(tiles.split_strips(byte_tiles(i), 2), 3, 4)
    return tiles.decode_pixels(strips, nodata=None).groupBy("tile_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("py").alias("first_row"), F.max("py").alias("last_row")
    )
