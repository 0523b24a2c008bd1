"""Grid, projection, polygons, tiles, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.projection import lonlat_to_mollweide, mollweide_to_lonlat
from acreage.operators import change, grid, neighbours, polygons, ranking
from acreage.plans import country
from checks.base import Inputs, check

CELL = 20000.0
RADIUS = 6378137.0


@check("snapped_extent", "fx_points", sql="""SELECT FLOOR(MIN(x) / 2000) * 2000 AS x0, FLOOR(MIN(y) / 2000) * 2000 AS y0,
    CEIL(MAX(x) / 2000) * 2000 AS x1, CEIL(MAX(y) / 2000) * 2000 AS y1 FROM fx_points""")
def snapped_extent(i: Inputs) -> DataFrame:
    return grid.snap_extent(i.fx_points, 2000)


MESH = f"""
    e AS (SELECT FLOOR(MIN(x) / {CELL}) * {CELL} AS x0, FLOOR(MIN(y) / {CELL}) * {CELL} AS y0, CEIL(MAX(x) / {CELL}) * {CELL} AS x1, CEIL(MAX(y) / {CELL}) * {CELL} AS y1 FROM fx_points),
    mesh AS (SELECT i AS i_idx, j AS j_idx, x0 + {CELL} / 2 + i * {CELL} AS centroid_x, y0 + {CELL} / 2 + j * {CELL} AS centroid_y
             FROM e, (SELECT UNNEST(RANGE(0, 2000)) AS i) a, (SELECT UNNEST(RANGE(0, 2000)) AS j) b
             WHERE i < (x1 - x0) / {CELL} AND j < (y1 - y0) / {CELL})
"""


@check("cell_mesh", "fx_points", sql=f"WITH {MESH.strip()} SELECT i_idx, j_idx, centroid_x, centroid_y FROM mesh")
def cell_mesh(i: Inputs) -> DataFrame:
    return grid.mesh_over(i.fx_points, CELL)


@check("cell_ids_and_bounds", "fx_points", sql=f"""WITH {MESH.strip()} SELECT CONCAT('G_', CAST(j_idx AS STRING), '_', CAST(i_idx AS STRING)) AS grid_id,
    centroid_x - {CELL} / 2 AS grid_minx, centroid_y - {CELL} / 2 AS grid_miny, centroid_x + {CELL} / 2 AS grid_maxx, centroid_y + {CELL} / 2 AS grid_maxy FROM mesh""")
def cell_ids_and_bounds(i: Inputs) -> DataFrame:
    mesh = grid.mesh_over(i.fx_points, CELL).select("centroid_x", "centroid_y")
    named = grid.with_cell_ids(mesh, 0.0, 0.0, CELL)
    return grid.with_bounds(named, CELL).select("grid_id", "grid_minx", "grid_miny", "grid_maxx", "grid_maxy")


RAYCAST = """(e.y1 > p.{y}) <> (e.y2 > p.{y}) AND p.{x} < e.x1 + (p.{y} - e.y1) * (e.x2 - e.x1) / NULLIF(e.y2 - e.y1, 0)"""


def inside_sql(points: str, edges: str, columns: str, x: str = "x", y: str = "y") -> str:
    return f"""SELECT {columns}, e.poly FROM {points} p JOIN (SELECT * FROM {edges} WHERE y1 <> y2) e
        ON {RAYCAST.format(x=x, y=y)} GROUP BY {columns}, e.poly HAVING COUNT(*) % 2 = 1"""


@check("points_in_polygon", "fx_points", "fx_edges", sql=inside_sql("fx_points", "fx_edges", "p.point_id, p.x, p.y"))
def points_in_polygon(i: Inputs) -> DataFrame:
    return polygons.points_in_polygons(i.fx_points.select("point_id", "x", "y"), i.fx_edges, 50000.0)


@check("points_in_many_polygons", "fx_points", "fx_diamond_edges", sql=f"""SELECT poly, COUNT(*) AS n, CAST(SUM(point_id) AS BIGINT) AS ids
    FROM ({inside_sql('fx_points', 'fx_diamond_edges', 'p.point_id, p.x, p.y')}) t GROUP BY 1""")
def points_in_many_polygons(i: Inputs) -> DataFrame:
    inside = polygons.points_in_polygons(i.fx_points.select("point_id", "x", "y"), i.fx_diamond_edges, 20000.0, column=100000.0)
    return inside.groupBy("poly").agg(F.count(F.lit(1)).alias("n"), F.sum("point_id").alias("ids"))


@check("dissolved_membership", "fx_points", "fx_diamond_edges", sql=f"""SELECT DISTINCT point_id
    FROM ({inside_sql('fx_points', 'fx_diamond_edges', 'p.point_id, p.x, p.y')}) t""")
def dissolved_membership(i: Inputs) -> DataFrame:
    return polygons.points_in_any(i.fx_points.select("point_id", "x", "y"), i.fx_diamond_edges, 20000.0, column=100000.0).select("point_id")


DIAMOND_CELL = 5000.0


@check("polygon_fill", "fx_diamonds", sql=f"""
    WITH r AS (SELECT *, UNNEST(RANGE(CAST(FLOOR((cy - r) / {DIAMOND_CELL}) - 1 AS BIGINT), CAST(CEIL((cy + r) / {DIAMOND_CELL}) + 1 AS BIGINT))) AS j_idx FROM fx_diamonds),
    c AS (SELECT *, UNNEST(RANGE(CAST(FLOOR((cx - r) / {DIAMOND_CELL}) - 1 AS BIGINT), CAST(CEIL((cx + r) / {DIAMOND_CELL}) + 1 AS BIGINT))) AS i_idx FROM r),
    p AS (SELECT poly, i_idx, j_idx, r, (i_idx + 0.5) * {DIAMOND_CELL} - cx AS dx, (j_idx + 0.5) * {DIAMOND_CELL} - cy AS dy FROM c)
    SELECT poly, i_idx, j_idx FROM p WHERE dy >= -r AND dy < r AND dx >= -(r - ABS(dy)) AND dx < r - ABS(dy)""")
def polygon_fill(i: Inputs) -> DataFrame:
    return polygons.fill_cells(i.fx_diamond_edges, 0.0, 0.0, DIAMOND_CELL)


@check("footprint_tiles", "fx_points", "fx_footprints", sql="""SELECT p.point_id, MIN(f.tile_id) AS tile_id FROM fx_points p
    LEFT JOIN fx_footprints f ON p.x > f.minx AND p.x < f.maxx AND p.y > f.miny AND p.y < f.maxy GROUP BY 1""")
def footprint_tiles(i: Inputs) -> DataFrame:
    return grid.assign_footprint(i.fx_points, i.fx_footprints, 50000.0, "x", "y").select("point_id", "tile_id")


@check("regular_tiles", "fx_points", sql="""SELECT CONCAT('R', CAST(CAST(FLOOR(y / 100000) AS BIGINT) AS STRING), '_C', CAST(CAST(FLOOR(x / 100000) AS BIGINT) AS STRING)) AS tile_id,
    COUNT(*) AS n FROM fx_points GROUP BY 1""")
def regular_tiles(i: Inputs) -> DataFrame:
    return grid.assign_regular_tile(i.fx_points, 100000.0, 100000.0, "x", "y").groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"))


SIDES = ["(e.x2 - e.x1) * (f.{cy} - e.y1) - (e.y2 - e.y1) * (f.{cx} - e.x1)".format(cx=cx, cy=cy) for cx in ("minx", "maxx") for cy in ("miny", "maxy")]


@check("candidate_tiles", "fx_footprints", "fx_edges", sql=f"""
    SELECT tile_id FROM fx_footprints f WHERE EXISTS (SELECT 1 FROM fx_edges e WHERE LEAST(e.x1, e.x2) <= f.maxx AND GREATEST(e.x1, e.x2) >= f.minx
      AND LEAST(e.y1, e.y2) <= f.maxy AND GREATEST(e.y1, e.y2) >= f.miny AND LEAST({', '.join(SIDES)}) <= 0 AND GREATEST({', '.join(SIDES)}) >= 0)
    UNION SELECT tile_id FROM ({inside_sql('fx_footprints', 'fx_edges', 'p.tile_id', 'minx', 'miny')}) t""")
def candidate_tiles(i: Inputs) -> DataFrame:
    return polygons.candidate_tiles(i.fx_footprints, i.fx_edges, 50000.0).select("tile_id")


# A diamond passes through a cell where |dx| + |dy| = r is reached inside the cell's box; cells are compared
# one unit inside their border, where touching and crossing are the same.
@check("boundary_cells", "fx_diamonds", sql="""
    WITH k AS (SELECT poly, cx, cy, r + 0.25 AS r FROM fx_diamonds),
    b AS (SELECT *, UNNEST(RANGE(CAST(FLOOR((cy - r) / 5000) - 1 AS BIGINT), CAST(CEIL((cy + r) / 5000) + 1 AS BIGINT))) AS j_idx FROM k),
    c AS (SELECT *, UNNEST(RANGE(CAST(FLOOR((cx - r) / 5000) - 1 AS BIGINT), CAST(CEIL((cx + r) / 5000) + 1 AS BIGINT))) AS i_idx FROM b),
    d AS (SELECT i_idx, j_idx, r, GREATEST(0, i_idx * 5000 - cx, cx - (i_idx + 1) * 5000) + GREATEST(0, j_idx * 5000 - cy, cy - (j_idx + 1) * 5000) AS near,
                 GREATEST(ABS(i_idx * 5000 - cx), ABS((i_idx + 1) * 5000 - cx)) + GREATEST(ABS(j_idx * 5000 - cy), ABS((j_idx + 1) * 5000 - cy)) AS far FROM c)
    SELECT DISTINCT i_idx, j_idx FROM d WHERE near < r AND far > r""")
def boundary_cells(i: Inputs) -> DataFrame:
    wide = i.fx_diamonds.withColumn("r", F.col("r") + 0.25)
    cx, cy, r = (F.col(c) for c in ("cx", "cy", "r"))
    ring = F.array(
        *[F.struct(px.alias("x"), py.alias("y")) for px, py in ((cx - r, cy), (cx, cy + r), (cx + r, cy), (cx, cy - r), (cx - r, cy))]
    )
    edges = polygons.ring_edges(wide.select("poly", ring.alias("ring")))
    return polygons.boundary_cells(edges, 0.0, 0.0, 5000.0)


@check("boundary_pixel_mask", "fx_points", "fx_edges", sql=f"""
    WITH inside AS ({inside_sql('fx_points', 'fx_edges', 'p.point_id')}),
    flagged AS (SELECT point_id, CAST(point_id % 200 AS INT) AS code, CASE WHEN point_id % 3 = 0 THEN 1 ELSE 0 END AS is_boundary FROM fx_points)
    SELECT f.point_id, f.is_boundary, CASE WHEN is_boundary = 1 AND i.point_id IS NULL THEN 255 ELSE code END AS code
    FROM flagged f LEFT JOIN inside i ON i.point_id = f.point_id""")
def boundary_pixel_mask(i: Inputs) -> DataFrame:
    pixels = i.fx_points.select(
        "point_id", "x", "y", (F.col("point_id") % 200).cast("int").alias("code"),
        (F.col("point_id") % 3 == 0).cast("int").alias("is_boundary"),
        F.floor(F.col("x") / 50000).alias("i_idx"), F.floor(F.col("y") / 50000).alias("j_idx"),
    )
    return polygons.mask_outside(pixels, i.fx_edges, 50000.0, ["point_id"]).select("point_id", "is_boundary", "code")


@check("masked_zonal_counts", "fx_ring", "fx_country_px", sql=f"""
    WITH inside AS ({inside_sql('fx_country_px', 'fx_ring', 'p.tile_id, p.px, p.py')})
    SELECT CAST(FLOOR(f.x / 50) AS BIGINT) AS i_idx, CAST(FLOOR(f.y / 50) AS BIGINT) AS j_idx, f.code, COUNT(*) AS pixels
    FROM fx_country_px f JOIN inside i ON i.tile_id = f.tile_id AND i.px = f.px AND i.py = f.py WHERE f.code <> 255 GROUP BY 1, 2, 3""")
def masked_zonal_counts(i: Inputs) -> DataFrame:
    """Cells of a country whose border has two vertices per supplier, pixels masked in border cells, classes counted."""
    return country.country_counts(i.fx_country_px, i.fx_ring, 50.0, 0.0, 0.0).select("i_idx", "j_idx", "code", "pixels")


@check("mollweide_inverse", "fx_points", sql=f"""
    SELECT point_id, ROUND(DEGREES(PI() * (x - 1000000) / (2 * SQRT(2) * {RADIUS} * COS(t))), 6) AS lon, ROUND(DEGREES(ASIN((2 * t + SIN(2 * t)) / PI())), 6) AS lat
    FROM (SELECT point_id, x, ASIN((y * 5 - 2500000) / ({RADIUS} * SQRT(2))) AS t FROM fx_points) s""")
def mollweide_inverse(i: Inputs) -> DataFrame:
    lon, lat = mollweide_to_lonlat(F.col("x") - 1000000.0, F.col("y") * 5.0 - 2500000.0)
    return i.fx_points.select("point_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


def _newton_sql(steps: int) -> str:
    """Newton's iteration written out, one nested query per step."""
    body = "SELECT point_id, lon, lat, RADIANS(lat) AS t, PI() * SIN(RADIANS(lat)) AS goal FROM s"
    for _ in range(steps):
        body = f"SELECT point_id, lon, lat, t - (2 * t + SIN(2 * t) - goal) / (2 + 2 * COS(2 * t)) AS t, goal FROM ({body}) q"
    return f"""WITH s AS (SELECT point_id, x / 2000000 * 360 - 180 AS lon, y / 1000000 * 160 - 80 AS lat FROM fx_points)
        SELECT point_id, ROUND(2 * SQRT(2) / PI() * {RADIUS} * RADIANS(lon) * COS(t), 3) AS x, ROUND(SQRT(2) * {RADIUS} * SIN(t), 3) AS y FROM ({body}) q"""


@check("mollweide_forward", "fx_points", sql=_newton_sql(12))
def mollweide_forward(i: Inputs) -> DataFrame:
    x, y = lonlat_to_mollweide(F.col("x") / 2000000.0 * 360.0 - 180.0, F.col("y") / 1000000.0 * 160.0 - 80.0)
    return i.fx_points.select("point_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@check("country_cells", "fx_edges", "fx_footprints", "fx_points", sql=f"""
    WITH e AS (SELECT FLOOR(MIN(minx) / {CELL}) * {CELL} AS x0, FLOOR(MIN(miny) / {CELL}) * {CELL} AS y0 FROM fx_footprints f
      WHERE EXISTS (SELECT 1 FROM fx_edges e WHERE LEAST(e.x1, e.x2) <= f.maxx AND GREATEST(e.x1, e.x2) >= f.minx
      AND LEAST(e.y1, e.y2) <= f.maxy AND GREATEST(e.y1, e.y2) >= f.miny AND LEAST({', '.join(SIDES)}) <= 0 AND GREATEST({', '.join(SIDES)}) >= 0)),
    m AS (SELECT i, j, x0 + (i + 0.5) * {CELL} AS x, y0 + (j + 0.5) * {CELL} AS y FROM e, (SELECT UNNEST(RANGE(0, 200)) AS i) a, (SELECT UNNEST(RANGE(0, 200)) AS j) b),
    c AS ({inside_sql('m', 'fx_edges', 'p.i, p.j, p.x, p.y')})
    SELECT CONCAT('G_', CAST(c.j AS STRING), '_', CAST(c.i AS STRING)) AS grid_id, CAST(c.x AS DOUBLE) AS centroid_x, CAST(c.y AS DOUBLE) AS centroid_y, MIN(f.tile_id) AS tile_id,
           ROUND(DEGREES(ASIN((2 * ASIN(c.y / ({RADIUS} * SQRT(2))) + SIN(2 * ASIN(c.y / ({RADIUS} * SQRT(2))))) / PI())), 6) AS lat
    FROM c LEFT JOIN fx_footprints f ON c.x > f.minx AND c.x < f.maxx AND c.y > f.miny AND c.y < f.maxy GROUP BY 1, 2, 3, 5""")
def country_cells(i: Inputs) -> DataFrame:
    cells = country.country_cells(i.fx_edges, i.fx_footprints, CELL)
    return cells.select("grid_id", "centroid_x", "centroid_y", "tile_id", F.round("lat", 6).alias("lat"))


@check("global_order_id", "fx_points", sql="SELECT point_id, x, y, ROW_NUMBER() OVER (ORDER BY x, y, point_id) AS order_id FROM fx_points")
def global_order_id(i: Inputs) -> DataFrame:
    return ranking.global_order_id(i.fx_points.select("point_id", "x", "y"), ["x", "y", "point_id"])


@check("keep_first_row", "fx_pixels", sql="""SELECT tile, px, code, smod FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tile, px ORDER BY py, code, smod) AS r FROM fx_pixels) t WHERE r = 1""")
def keep_first_row(i: Inputs) -> DataFrame:
    rows = i.fx_pixels.select("tile", "px", "py", "code", "smod")
    return grid.keep_first(rows, ["tile", "px"], ["py", "code", "smod"]).drop("py")


MANIFEST = """
    wanted AS (SELECT CONCAT('R', CAST(c_custkey AS STRING)) AS tile_id, d.dataset FROM customer CROSS JOIN (VALUES ('built_c'), ('smod'), ('height')) AS d(dataset))
"""


def wanted_tiles(i: Inputs) -> DataFrame:
    return i.table("customer").select(F.concat(F.lit("R"), F.col("c_custkey").cast("string")).alias("tile_id"))


@check("tile_manifest", "fx_tile_files", sql=f"""WITH {MANIFEST.strip()} SELECT w.tile_id, w.dataset, CASE WHEN f.tile_id IS NULL THEN 'missing' ELSE 'exists' END AS status,
    CASE WHEN f.tile_id IS NULL THEN CONCAT('https://tiles.example/', w.dataset, '_', w.tile_id, '.zip') END AS url
    FROM wanted w LEFT JOIN fx_tile_files f ON f.tile_id = w.tile_id AND f.dataset = w.dataset""")
def tile_manifest(i: Inputs) -> DataFrame:
    templates = {d: "https://tiles.example/" + d + "_{tile_id}.zip" for d in ("built_c", "smod", "height")}
    return grid.tile_manifest(wanted_tiles(i), i.fx_tile_files, templates)


@check("missing_tiles", "fx_tile_files", sql=f"WITH {MANIFEST.strip()} SELECT tile_id, dataset FROM wanted EXCEPT SELECT tile_id, dataset FROM fx_tile_files")
def missing_tiles(i: Inputs) -> DataFrame:
    return grid.missing_tiles(wanted_tiles(i), i.fx_tile_files, ["built_c", "smod", "height"])


@check("key_difference", sql="SELECT c_custkey AS key FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def key_difference(i: Inputs) -> DataFrame:
    a = i.table("customer").select(F.col("c_custkey").alias("key"))
    return change.key_difference(a, i.table("supplier").select(F.col("s_suppkey").alias("key")), ["key"])


@check("patch_grid", "fx_pixels", sql="""SELECT tile, CAST(FLOOR(py / 120) AS BIGINT) AS patch_i, CAST(FLOOR(px / 120) AS BIGINT) AS patch_j, COUNT(*) AS n
    FROM fx_pixels WHERE FLOOR(py / 120) < 8 AND FLOOR(px / 120) < 8 GROUP BY 1, 2, 3""")
def patch_grid(i: Inputs) -> DataFrame:
    cut = grid.patches(i.fx_pixels, 120, 1000, 1000)
    return cut.groupBy("tile", "patch_i", "patch_j").agg(F.count(F.lit(1)).alias("n"))


# Each part is a 6 x 5 band of coarse pixels whose values follow from the key.
@check("bilinear_upsample", sql="""
    WITH s AS (SELECT p_partkey AS tile, x, y, CAST((p_partkey * 13 + x * 29 + y * 17) % 101 AS DOUBLE) AS v FROM part, (SELECT UNNEST(RANGE(6)) AS x) a, (SELECT UNNEST(RANGE(5)) AS y) b),
    t AS (SELECT p_partkey AS tile, px, py, px * 5.0 / 11 AS sx, py * 4.0 / 9 AS sy FROM part, (SELECT UNNEST(RANGE(12)) AS px) a, (SELECT UNNEST(RANGE(10)) AS py) b)
    SELECT t.tile, t.px, t.py, ROUND(SUM(s.v * (1 - ABS(t.sx - s.x)) * (1 - ABS(t.sy - s.y))), 5) AS v
    FROM t JOIN s ON s.tile = t.tile AND ABS(t.sx - s.x) < 1 AND ABS(t.sy - s.y) < 1 GROUP BY 1, 2, 3""")
def bilinear_upsample(i: Inputs) -> DataFrame:
    spots = F.sequence(F.lit(0), F.lit(29))
    source = i.table("part").select(F.col("p_partkey").alias("tile"), F.explode(spots).alias("k")).select(
        "tile", (F.col("k") % 6).alias("px"), F.floor(F.col("k") / 6).alias("py")
    )
    source = source.withColumn("v", ((F.col("tile") * 13 + F.col("px") * 29 + F.col("py") * 17) % 101).cast("double"))
    return grid.upsample_bilinear(source, 6, 5, 2, ["tile"]).withColumn("v", F.round("v", 5))


def held_out_points(i: Inputs) -> DataFrame:
    return i.fx_points.filter(F.col("site") == "1-URGENT")


def train_points(i: Inputs) -> DataFrame:
    return i.fx_points.filter(F.col("site") != "1-URGENT")


@check("buffer_exclusion", "fx_points", sql="""SELECT point_id FROM fx_points a WHERE site <> '1-URGENT' AND NOT EXISTS
    (SELECT 1 FROM fx_points b WHERE b.site = '1-URGENT' AND b.x BETWEEN a.x - 9000 AND a.x + 9000 AND SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 9000)""")
def buffer_exclusion(i: Inputs) -> DataFrame:
    return neighbours.outside_buffer(train_points(i), held_out_points(i), 9000.0).select("point_id")


@check("nearest_train_distance", "fx_points", sql="""SELECT a.point_id, ROUND(MIN(SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 4) AS distance
    FROM fx_points a, fx_points b WHERE a.site = '1-URGENT' AND b.site <> '1-URGENT' GROUP BY 1""")
def nearest_train_distance(i: Inputs) -> DataFrame:
    queries = held_out_points(i).select(F.col("point_id").alias("query_id"), "x", "y")
    targets = train_points(i).select(F.col("point_id").alias("target_id"), "x", "y")
    return neighbours.nearest(queries, targets, 1).select(F.col("query_id").alias("point_id"), F.round("distance", 4).alias("distance"))


@check("split_separation", "fx_points", sql="""
    WITH d AS (SELECT a.point_id, MIN(SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d FROM fx_points a, fx_points b
               WHERE a.site = '1-URGENT' AND b.site <> '1-URGENT' GROUP BY 1)
    SELECT COUNT(*) AS n_test, ROUND(AVG(d), 3) AS mean_distance, ROUND(MIN(d), 3) AS min_distance FROM d""")
def split_separation(i: Inputs) -> DataFrame:
    out = neighbours.separation(train_points(i), held_out_points(i))
    return out.select("n_test", F.round("mean_distance", 3).alias("mean_distance"), F.round("min_distance", 3).alias("min_distance"))


# Ten nearest neighbours of every point; on these points all ten lie within the 200 km box.
KNN = """
    p AS (SELECT point_id, x, y, CAST(value AS DOUBLE) / 100000 - 2.5 AS residual FROM fx_points),
    d AS (SELECT a.point_id AS q, b.point_id AS t, ABS(b.residual - a.residual) AS gap, SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d
          FROM p a JOIN p b ON a.point_id <> b.point_id AND b.x BETWEEN a.x - 200000 AND a.x + 200000 AND b.y BETWEEN a.y - 200000 AND a.y + 200000),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY d, t) AS place FROM d),
    near AS (SELECT * FROM k WHERE place <= 10)
"""


def residual_points(i: Inputs) -> DataFrame:
    return i.fx_points.select("point_id", "x", "y", (F.col("value") / 100000.0 - 2.5).alias("residual"))


@check("nearest_ten", "fx_points", sql=f"WITH {KNN.strip()} SELECT q AS query_id, t AS target_id, ROUND(d, 4) AS distance, CAST(place AS INT) AS place FROM near")
def nearest_ten(i: Inputs) -> DataFrame:
    points = i.fx_points
    return neighbours.nearest(
        points.select(F.col("point_id").alias("query_id"), "x", "y"),
        points.select(F.col("point_id").alias("target_id"), "x", "y"), 10, skip_self=True,
    ).withColumn("distance", F.round("distance", 4))


@check("spatial_penalty", "fx_points", sql=f"""WITH {KNN.strip()},
    part AS (SELECT q, ABS(gap - d / (MAX(d) OVER (PARTITION BY q) + 1e-8)) AS v FROM near),
    pen AS (SELECT AVG(v) AS v FROM part GROUP BY q),
    s AS (SELECT (SELECT COUNT(*) FROM p) AS n, (SELECT AVG(residual * residual) FROM p) AS mse, (SELECT SUM(v) FROM pen) / (SELECT COUNT(*) FROM p) AS penalty)
    SELECT n, ROUND(mse, 6) AS mse, ROUND(penalty, 6) AS penalty, ROUND(0.8 * mse + 0.2 * penalty, 6) AS loss FROM s""")
def spatial_penalty(i: Inputs) -> DataFrame:
    out = neighbours.spatial_penalty(residual_points(i))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("mse", "penalty", "loss")])
