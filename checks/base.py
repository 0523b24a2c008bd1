"""Fixture relations and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Relations derived from the whole tables by integer arithmetic; the text runs unchanged in both engines.
FIXTURES: dict[str, str] = {
    "fx_counts": """
        SELECT CAST(l_partkey AS BIGINT) AS cell, CONCAT('R', CAST(l_partkey % 3 AS STRING)) AS tile_id,
               CASE WHEN l_partkey % 4 = 3 THEN NULL ELSE CAST(l_partkey % 4 AS INT) END AS urban,
               CAST(7000 + (l_partkey % 50) * 25 AS BIGINT) AS lon_e2,
               CAST(800 + FLOOR(l_partkey / 50) * 25 AS BIGINT) AS lat_e2,
               CAST(CASE WHEN k < 5 THEN 11 + k ELSE 16 + k END AS INT) AS built,
               CAST(COUNT(*) AS BIGINT) AS cnt
        FROM (SELECT l_partkey, CASE WHEN l_partkey % 7 = 0 THEN (l_orderkey + l_linenumber) % 5
                                     ELSE (l_orderkey + l_linenumber) % 10 END AS k FROM lineitem) t
        GROUP BY 1, 2, 3, 4, 5, 6""",
    "fx_props": """
        SELECT lob, urban, built, bin, CAST(w AS DOUBLE) / SUM(w) OVER (PARTITION BY lob, urban, built) AS prop
        FROM (SELECT l.lob, u.urban, b.built, s.bin, CAST(1 + (l.li * 7 + u.urban * 3 + b.built + s.bi * s.bi) % 5 AS BIGINT) AS w
              FROM (VALUES ('RES', 0), ('COM', 1), ('IND', 2)) AS l(lob, li)
              CROSS JOIN (VALUES (0), (1), (2)) AS u(urban)
              CROSS JOIN (VALUES (11), (12), (13), (14), (15), (21), (22), (23), (24), (25)) AS b(built)
              CROSS JOIN (VALUES ('1', 1), ('2', 2), ('3', 3), ('4_5', 4), ('6_8', 5), ('9_20', 6), ('20', 7)) AS s(bin, bi)
              WHERE (l.lob = 'RES' AND b.built < 20) OR (l.lob <> 'RES' AND b.built > 20)) t""",
    "fx_tsi": """
        SELECT l.lob, s.bin, CAST((l.li + 1) * s.bi * 100000 AS BIGINT) AS tsi
        FROM (VALUES ('RES', 0), ('COM', 1), ('IND', 2)) AS l(lob, li)
        CROSS JOIN (VALUES ('1', 1), ('2', 2), ('3', 3), ('4_5', 4), ('6_8', 5), ('9_20', 6), ('20', 7)) AS s(bin, bi)""",
    # One text row per line item, in the notations multiplier files use: comma decimals, per cent, percentages, junk.
    "fx_raw_props": """
        SELECT rid, grp, CASE WHEN form = 0 THEN CONCAT('0,', a) WHEN form = 1 THEN CONCAT(' 0.', a, ' ')
                              WHEN form = 2 THEN CONCAT(a, '%') WHEN form = 3 THEN a WHEN form = 4 THEN 'n/a' ELSE '' END AS p1,
               CASE WHEN form = 0 THEN CONCAT('0,', b) WHEN form = 1 THEN CONCAT('0.', b)
                    WHEN form = 2 THEN CONCAT(b, ' %') WHEN form = 3 THEN b ELSE '0.5' END AS p2
        FROM (SELECT l_orderkey * 10 + l_linenumber AS rid, l_returnflag AS grp, CAST(l_suppkey % 6 AS INT) AS form,
                     CAST(10 + l_partkey % 80 AS STRING) AS a,
                     CAST(CASE WHEN l_suppkey % 10 = 0 THEN 10 + l_orderkey % 80 ELSE 90 - l_partkey % 80 END AS STRING) AS b
              FROM lineitem) t""",
    "fx_pixels": """
        SELECT CAST(FLOOR(l_orderkey / 4000) AS BIGINT) AS tile, CAST(l_orderkey % 1000 AS BIGINT) AS px, CAST(l_partkey % 1000 AS BIGINT) AS py,
               CAST(FLOOR((l_orderkey % 1000) / 50) AS BIGINT) AS ci, CAST(FLOOR((l_partkey % 1000) / 50) AS BIGINT) AS cj,
               CAST(CASE WHEN l_quantity >= 49 THEN 255 WHEN k = 10 THEN 0 WHEN k < 5 THEN 11 + k ELSE 16 + k END AS INT) AS code,
               CAST(CASE WHEN l_quantity >= 49 THEN 255 WHEN l_linenumber = 1 THEN 30 WHEN l_linenumber = 2 THEN 21
                         WHEN l_linenumber = 3 THEN 13 ELSE 10 + l_linenumber % 3 END AS INT) AS smod
        FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, (l_orderkey + l_linenumber) % 11 AS k FROM lineitem) t""",
    "fx_points": """
        SELECT o_orderkey AS point_id, CAST((o_orderkey * 7919 % 200000) * 10 AS DOUBLE) AS x,
               CAST((o_custkey * 104729 % 100000) * 10 AS DOUBLE) AS y, o_orderpriority AS site, o_totalprice AS value FROM orders""",
    "fx_edges": """
        SELECT a.poly, a.vx AS x1, a.vy AS y1, b.vx AS x2, b.vy AS y2
        FROM (SELECT 'P1' AS poly, i, CAST(vx AS DOUBLE) AS vx, CAST(vy AS DOUBLE) AS vy
              FROM (VALUES (0, 0, 0), (1, 1500000, 0), (2, 1500000, 900000), (3, 750000, 300000), (4, 0, 900000)) AS v(i, vx, vy)) a
        JOIN (SELECT i, CAST(vx AS DOUBLE) AS vx, CAST(vy AS DOUBLE) AS vy
              FROM (VALUES (0, 0, 0), (1, 1500000, 0), (2, 1500000, 900000), (3, 750000, 300000), (4, 0, 900000)) AS v(i, vx, vy)) b
          ON b.i = (a.i + 1) % 5""",
    # One diamond per supplier; diamonds overlap, and their number grows with the table.
    "fx_diamonds": """
        SELECT CONCAT('S', CAST(s_suppkey AS STRING)) AS poly,
               CAST((s_suppkey * 7919 % 200000) * 10 AS DOUBLE) AS cx, CAST((s_suppkey * 104729 % 100000) * 10 AS DOUBLE) AS cy,
               CAST(20000 + (s_suppkey % 7) * 5000 AS DOUBLE) AS r FROM supplier""",
    "fx_diamond_edges": """
        SELECT poly, cx - r AS x1, cy AS y1, cx AS x2, cy + r AS y2 FROM fx_diamonds
        UNION ALL SELECT poly, cx, cy + r, cx + r, cy FROM fx_diamonds
        UNION ALL SELECT poly, cx + r, cy, cx, cy - r FROM fx_diamonds
        UNION ALL SELECT poly, cx, cy - r, cx - r, cy FROM fx_diamonds""",
    # One rectangle per customer on an uneven lattice; rectangles overlap.
    "fx_footprints": """
        SELECT CONCAT('T', CAST(c_custkey AS STRING)) AS tile_id,
               CAST((c_custkey * 7907 % 2000) * 1000 - 500 AS DOUBLE) AS minx, CAST((c_custkey * 6841 % 1000) * 1000 - 500 AS DOUBLE) AS miny,
               CAST((c_custkey * 7907 % 2000) * 1000 + 40000 + c_nationkey * 500 AS DOUBLE) AS maxx,
               CAST((c_custkey * 6841 % 1000) * 1000 + 30000 + c_nationkey * 300 AS DOUBLE) AS maxy FROM customer""",
    "fx_preds": """
        SELECT o_orderkey AS id, o_orderpriority AS site, CAST(o_custkey % 5 AS INT) AS fold, o_totalprice AS y_true,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice * CAST(90 + o_orderkey % 21 AS DOUBLE) / 100 END AS y_pred FROM orders""",
    "fx_patches": """
        SELECT CAST(l_suppkey AS BIGINT) AS patch, CAST(l_linenumber % 2 AS INT) AS epoch, l_orderkey AS pix,
               CAST(800 + l_partkey % 700 AS DOUBLE) AS blue, CAST(900 + l_orderkey % 900 AS DOUBLE) AS green,
               CAST(700 + l_quantity * 18 + (l_linenumber % 2) * 150 AS DOUBLE) AS red,
               CAST(2500 + (l_partkey * 31 + l_orderkey * 17) % 2000 AS DOUBLE) AS nir,
               CAST((l_partkey * 13 + l_orderkey * 7 + l_linenumber * 29) % 100 AS DOUBLE) / 100 AS probability FROM lineitem""",
    "fx_chip_px": """
        SELECT CAST(FLOOR(l_orderkey / 64) AS BIGINT) AS chip, CAST(l_linenumber % 4 AS INT) AS band, l_orderkey AS pix,
               CASE WHEN (l_orderkey + l_partkey) % 9 = 0 OR l_suppkey % 25 = l_orderkey % 25 THEN NULL
                    ELSE CAST(l_quantity * 10 + l_linenumber AS DOUBLE) END AS v,
               CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(l_partkey % 300 AS DOUBLE) END AS biomass FROM lineitem""",
    # A polygon that grows with the table: an upper and a lower chain of a vertex per supplier, closed into a ring.
    "fx_ring": """
        SELECT 'P' AS poly, CAST(vx AS DOUBLE) AS x1, CAST(vy AS DOUBLE) AS y1, CAST(wx AS DOUBLE) AS x2, CAST(wy AS DOUBLE) AS y2
        FROM (SELECT vx, vy, COALESCE(LEAD(vx) OVER (ORDER BY ord), FIRST_VALUE(vx) OVER (ORDER BY ord)) AS wx,
                     COALESCE(LEAD(vy) OVER (ORDER BY ord), FIRST_VALUE(vy) OVER (ORDER BY ord)) AS wy
              FROM (SELECT s_suppkey AS ord, s_suppkey * 2000 / n AS vx, 1000 + s_suppkey * 7919 % 97 AS vy
                    FROM (SELECT s_suppkey, COUNT(*) OVER () AS n FROM supplier) a
                    UNION ALL SELECT 2 * n + 1 - s_suppkey, s_suppkey * 2000 / n, s_suppkey * 104729 % 89
                    FROM (SELECT s_suppkey, COUNT(*) OVER () AS n FROM supplier) b) v) e""",
    "fx_country_px": """
        SELECT CAST(FLOOR(px / 300) AS BIGINT) AS tile_id, px, py, px + 0.25e0 AS x, py + 0.25e0 AS y,
               CAST(CASE WHEN (px * 31 + py) % 13 = 0 THEN 255 ELSE 11 + (px * 7 + py * 3) % 5 END AS INT) AS code
        FROM (SELECT DISTINCT CAST(l_orderkey * 7919 % 2100 AS BIGINT) AS px, CAST(l_partkey * 104729 % 1200 AS BIGINT) AS py FROM lineitem) d""",
    "fx_scenes": """
        SELECT event_id AS scene_id, CAST(user_id AS BIGINT) AS tile, CAST(2018 + (event_id % 2) * 6 AS INT) AS year, ts,
               CAST((event_id * 37 % 1000) AS DOUBLE) / 100 AS cloud_pct, event_type AS product FROM events""",
    # Tiles wanted (one per customer) and raster files present (from the orders that exist).
    "fx_tile_files": """
        SELECT DISTINCT CONCAT('R', CAST(o_custkey AS STRING)) AS tile_id,
               CASE WHEN o_orderpriority < '3' THEN 'built_c' ELSE 'smod' END AS dataset FROM orders""",
    "fx_samples": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag AS site, l_quantity AS b1, l_extendedprice / 1000 AS b2,
               l_discount * 100 AS b3, l_quantity * 2 + l_tax * 100 AS b4, CAST(1 AS DOUBLE) AS b5,
               CAST(l_partkey % 1100 AS DOUBLE) AS target FROM lineitem""",
}

DEPENDS = {"fx_diamond_edges": ["fx_diamonds"]}


class Inputs:
    """Tables of one scale factor and the fixtures over them, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(PurePosixPath(self.folder) / f"{name}.parquet"))

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names tables and fixtures; views are rebuilt for this scale factor."""
        for name in TABLES:
            if name in text:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in FIXTURES:
            raise AttributeError(name)
        for needed in DEPENDS.get(name, []):
            getattr(self, needed).createOrReplaceTempView(needed)
        return self.sql(FIXTURES[name])


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_fixtures(uses: tuple[str, ...], sql: str) -> str:
    """Prefix the SQL with its fixtures as common table expressions."""
    names: list[str] = []
    for name in uses:
        for needed in [*DEPENDS.get(name, []), name]:
            if needed not in names:
                names.append(needed)
    body = sql.strip()
    heads = [f"{n} AS ({FIXTURES[n].strip()})" for n in names]
    if not heads:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[len("WITH RECURSIVE "):]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body


def check(name: str, *uses: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where given, its SQL twin."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_fixtures(uses, sql)
        return query

    return add
