"""Sources and sinks: what is written to the shared folder is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage import contracts
from acreage.operators import expected, exposure, metrics
from acreage.plans import country
from acreage.session import shared_dir
from acreage.sources import delimited, polygons, sinks, tables
from checks import exposure_checks
from checks.base import Inputs, check


def folder(i: Inputs, name: str) -> str:
    """A new folder below the one all executors share."""
    return f"{shared_dir(i.spark)}/{name}-{uuid.uuid4().hex}"


GROUPED = "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2"


def grouped(df: DataFrame) -> DataFrame:
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


def items(i: Inputs) -> DataFrame:
    return i.table("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")


@check("delimited_multiplier_file", sql="SELECT l_returnflag AS \"LOB\", CAST(l_suppkey AS STRING) AS built, REPLACE(CAST(CAST(l_quantity AS BIGINT) AS STRING), '.', ',') AS p1, COUNT(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def delimited_multiplier_file(i: Inputs) -> DataFrame:
    path = folder(i, "multipliers")
    raw = i.table("lineitem").select(
        F.col("l_returnflag").alias("LOB"), F.col("l_suppkey").alias("built"),
        F.concat(F.lit("0,"), F.col("l_quantity").cast("bigint").cast("string")).alias("p1"),
    )
    raw.write.option("header", True).option("sep", ";").csv(path)
    back = delimited.read_multipliers(i.spark, path)
    return back.groupBy("LOB", "built", F.regexp_replace("p1", "^0,", "").alias("p1")).agg(F.count(F.lit(1)).alias("n"))


@check("typed_csv_table", sql=GROUPED)
def typed_csv_table(i: Inputs) -> DataFrame:
    path = folder(i, "csv")
    sinks.write_csv(items(i), path)
    schema = "l_orderkey bigint, l_returnflag string, l_linestatus string, l_quantity double"
    return grouped(delimited.read_table_csv(i.spark, path, schema))


@check("catalog_table_round_trip", sql=GROUPED)
def catalog_table_round_trip(i: Inputs) -> DataFrame:
    name = f"line_items_{uuid.uuid4().hex}"
    sinks.write_table(items(i), name, path=folder(i, "table"))
    return grouped(contracts.require_columns(tables.read_source(i.spark, f"table:{name}"), ["l_quantity"]))


@check("per_tile_output", "fx_pixels", sql="SELECT tile, code, COUNT(*) AS n FROM fx_pixels GROUP BY 1, 2")
def per_tile_output(i: Inputs) -> DataFrame:
    path = folder(i, "tiles")
    sinks.write_by_tile(i.fx_pixels.select("tile", "px", "py", "code"), path, "tile")
    back = i.spark.read.parquet(path)
    return back.groupBy(F.col("tile").cast("bigint").alias("tile"), "code").agg(F.count(F.lit(1)).alias("n"))


@check("csv_export_without_void", sql="SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1")
def csv_export_without_void(i: Inputs) -> DataFrame:
    path, source = folder(i, "export"), folder(i, "source") + ".parquet"
    items(i).write.parquet(source)
    if not sinks.export_csv(i.spark, source, path):
        raise RuntimeError("nothing was exported")
    with_void = i.spark.read.csv(path, header=True).withColumn("gap", F.lit(None))
    return contracts.drop_untyped(with_void).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@check("typed_nulls", sql="SELECT o_orderstatus, CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS STRING) AS note, COUNT(*) AS n FROM orders GROUP BY 1")
def typed_nulls(i: Inputs) -> DataFrame:
    rows = i.table("orders").select("o_orderstatus", F.lit(None).alias("order_id"), F.lit(None).alias("note"))
    typed = contracts.cast_untyped(rows, {"order_id": "bigint"})
    return typed.groupBy("o_orderstatus", "order_id", "note").agg(F.count(F.lit(1)).alias("n"))


@check("lob_session_view", *exposure_checks.FX, sql="WITH " + exposure_checks.LONG.strip() + """ SELECT CAST(cell AS STRING) AS "ID", ROUND(SUM(value_share), 5) AS "SUM" FROM imputed WHERE lob = 'RES' GROUP BY 1""")
def lob_session_view(i: Inputs) -> DataFrame:
    rows = country.enriched(exposure_checks.grid_counts(i), i.fx_props, i.fx_tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    view = sinks.create_lob_view(exposure.lob_view(rows, "RES", "grid_id", "lon", "lat"), "exposure_shares", "RES")
    return i.spark.table(view).select("ID", F.round("SUM", 5).alias("SUM"))


@check("lob_catalog_view", *exposure_checks.FX, sql="WITH " + exposure_checks.LONG.strip() + """ SELECT CAST(cell AS STRING) AS "ID", ROUND(SUM(value_share), 5) AS "SUM" FROM imputed WHERE lob = 'COM' GROUP BY 1""")
def lob_catalog_view(i: Inputs) -> DataFrame:
    """A persistent view of one line of business over a written table; a table in its place gives it another name."""
    rows = country.enriched(exposure_checks.grid_counts(i), i.fx_props, i.fx_tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    base = f"profiles_{uuid.uuid4().hex}"
    sinks.write_table(exposure.lob_view(rows, "COM", "grid_id", "lon", "lat").select("ID", "SUM"), base, path=folder(i, "profiles"))
    view = sinks.create_catalog_view(i.spark, base, f"SELECT ID, SUM FROM {base}")
    assert view == f"{base}_view"
    return i.spark.table(view).select("ID", F.round("SUM", 5).alias("SUM"))


@check("latest_snapshot", sql="SELECT CONCAT('data/class_counts_all_', strftime(MAX(DATE_TRUNC('second', ts)), '%Y%m%d_%H%M%S'), '.csv') AS name FROM events")
def latest_snapshot(i: Inputs) -> DataFrame:
    names = i.table("events").select(
        F.concat(F.lit("data/class_counts_all_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".csv")).alias("name")
    )
    others = i.table("orders").select(F.concat(F.lit("data/other_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("name"))
    return tables.latest_snapshot(names.unionByName(others)).select("name")


@check("outdated_outputs", sql="""
    WITH n AS (SELECT DISTINCT CONCAT(CASE o_orderpriority WHEN '1-URGENT' THEN 'exposure_ABC_' WHEN '2-HIGH' THEN 'exposure_abc_tsi_' WHEN '3-MEDIUM' THEN 'exposure_abd_' ELSE 'exposure_abc_x' END,
                 strftime(o_orderdate, '%y%m%d'), CASE WHEN o_orderpriority = '2-HIGH' THEN '_res' ELSE '' END) AS name, o_orderpriority AS p, strftime(o_orderdate, '%y%m%d') AS stamp FROM orders)
    SELECT name, stamp FROM n WHERE p IN ('1-URGENT', '2-HIGH') AND stamp <> '980101'""")
def outdated_outputs(i: Inputs) -> DataFrame:
    p = F.col("o_orderpriority")
    base = F.when(p == "1-URGENT", "exposure_ABC_").when(p == "2-HIGH", "exposure_abc_tsi_").when(p == "3-MEDIUM", "exposure_abd_").otherwise("exposure_abc_x")
    ending = F.when(p == "2-HIGH", "_res").otherwise("")
    names = i.table("orders").select(F.concat(base, F.date_format("o_orderdate", "yyMMdd"), ending).alias("name")).distinct()
    return tables.outdated(names, ["exposure_abc_", "exposure_abc_tsi_"], "980101")


# Every supplier's diamond as a line of GeoJSON text, parsed back to edges.
@check("geojson_edges", "fx_diamonds", "fx_diamond_edges", sql="SELECT poly, x1, y1, x2, y2 FROM fx_diamond_edges")
def geojson_edges(i: Inputs) -> DataFrame:
    path = folder(i, "geojson")
    corners = [("cx - r", "cy"), ("cx", "cy + r"), ("cx + r", "cy"), ("cx", "cy - r"), ("cx - r", "cy")]
    pairs = F.concat_ws(",", *[F.concat(F.lit("["), F.expr(x).cast("string"), F.lit(","), F.expr(y).cast("string"), F.lit("]")) for x, y in corners])
    multi = F.col("poly").endswith("7")
    depth = F.when(multi, F.lit("[[[")).otherwise(F.lit("[["))
    line = F.concat(
        F.lit('{"type":"Feature","properties":{"ISO3":"'), F.col("poly"), F.lit('"},"geometry":{"type":"'),
        F.when(multi, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), depth, pairs,
        F.when(multi, F.lit("]]]")).otherwise(F.lit("]]")), F.lit("}}"),
    )
    i.fx_diamonds.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return polygons.feature_edges(polygons.read_geojson(i.spark, path, one_per_line=True), F.col("properties")["ISO3"])


@check("split_bundle", "fx_points", sql="SELECT 'run_2' AS run, CASE WHEN site = '1-URGENT' THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n FROM fx_points GROUP BY 2")
def split_bundle(i: Inputs) -> DataFrame:
    path = folder(i, "bundle")
    samples = i.fx_points.select("point_id", F.array("x", "y").alias("features"), F.when(F.col("site") == "1-URGENT", "test").otherwise("train").alias("split"))
    for run in ("run_1", "run_2"):
        sinks.write_split_bundle(samples, path, run)
    return sinks.read_split_bundle(i.spark, path).groupBy("run", "split").agg(F.count("features").alias("n"))


@check("array_samples", sql="SELECT vec_id, CAST(LEN(embedding) AS INT) AS length, ROUND(CAST(embedding[1] AS DOUBLE), 5) AS first FROM embeddings")
def array_samples(i: Inputs) -> DataFrame:
    path = folder(i, "chips") + ".parquet"
    i.table("embeddings").write.parquet(path)
    back = tables.read_source(i.spark, path)
    return back.select("vec_id", F.size("embedding").alias("length"), F.round(F.col("embedding")[0].cast("double"), 5).alias("first"))


@check("observed_run_facts", "fx_pixels", sql="SELECT COUNT(*) AS n, CAST(SUM(code) AS BIGINT) AS codes, CAST(SUM(CASE WHEN code = 255 THEN 1 ELSE 0 END) AS BIGINT) AS nodata FROM fx_pixels")
def observed_run_facts(i: Inputs) -> DataFrame:
    facts = sinks.write_observed(i.fx_pixels, folder(i, "observed"), {"n": "count(1)", "codes": "sum(code)", "nodata": "count_if(code = 255)"})
    return i.spark.createDataFrame([(facts["n"], facts["codes"], facts["nodata"])], "n bigint, codes bigint, nodata bigint")


@check("expected_reports", "fx_counts", "fx_props", sql="WITH " + exposure_checks.DENSE.strip() + """
    SELECT 'by_cell' AS report, COUNT(DISTINCT cell) AS n FROM dense UNION ALL SELECT 'combinations', COUNT(*) FROM dense
    UNION ALL SELECT 'ordered', COUNT(*) + COUNT(DISTINCT (cell, built)) FROM dense""")
def expected_reports(i: Inputs) -> DataFrame:
    path = folder(i, "expected")
    rows = exposure_checks.dense_rows(i)
    bins = exposure_checks.BINS
    reports = {
        "by_cell": expected.expected_by_cell(rows, bins),
        "combinations": rows,
        "ordered": expected.ordered(expected.with_subtotals(rows, bins)),
    }
    sinks.write_reports(reports, path)
    out = None
    for name in reports:
        n = i.spark.read.csv(f"{path}/{name}", header=True).agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@check("resolved_columns", sql="SELECT o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1")
def resolved_columns(i: Inputs) -> DataFrame:
    rows = i.table("orders")
    name = contracts.resolve_column(rows.columns, ["status"])
    return metrics.value_counts(rows.select(F.col(name).alias("status")), "status")


@check("preview_rows", sql="SELECT 5 AS n")
def preview_rows(i: Inputs) -> DataFrame:
    return sinks.preview(i.table("lineitem"), 5).agg(F.count(F.lit(1)).cast("int").alias("n"))
