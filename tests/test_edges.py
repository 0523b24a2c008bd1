"""Hand-made edge cases, brute-force comparisons and plan shapes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from acreage import contracts
from acreage.functions import classes as cls
from acreage.functions.numbers import parse_number, safe_divide, unlog_target
from acreage.functions.projection import lonlat_to_mollweide, mollweide_to_lonlat
from acreage.operators import chips, exposure, grid, metrics, multipliers, neighbours, polygons, ranking, splits, zonal
from acreage.plans import country
from acreage.session import cut_lineage
from acreage.sources import delimited, sinks, tables, tiles
from acreage.sources import polygons as geo
from tests.conftest import plan_of, rows


def test_numbers(spark):
    text = ["0,49", "60%", " 0.25 ", "n/a", "", None, "nan", "1e-2", "5 %", "1d"]
    df = spark.createDataFrame([(t,) for t in text], "t string").select(parse_number(F.col("t")).alias("v"))
    assert [r.v for r in df.collect()] == [0.49, 0.6, 0.25, None, None, None, None, 0.01, 0.05, None]


def test_safe_divide_handles_zero_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, float("nan")), (float("inf"), 2.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 0.0, 0.5, 0.0]


def test_inverse_log_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (1.0,)], "v double").select(unlog_target(F.col("v")))
    found = [r[0] for r in df.collect()]
    assert found[:2] == [None, 0.0] and found[2] == pytest.approx(math.e - 1)


def test_projection_round_trip_and_poles(spark):
    points = [(lon, lat) for lon in (-170.0, 0.0, 33.3) for lat in (-90.0, -75.0, 0.0, 41.5, 89.0, 90.0)]
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = lonlat_to_mollweide(F.col("lon"), F.col("lat"))
    lon, lat = mollweide_to_lonlat(F.col("x"), F.col("y"))
    for r in df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect():
        assert r.lat2 == pytest.approx(r.lat, abs=1e-5)
        if abs(r.lat) < 90:
            assert r.lon2 == pytest.approx(r.lon, abs=1e-5)


def test_off_globe_is_null(spark):
    lon, lat = mollweide_to_lonlat(F.lit(0.0), F.lit(1e8))
    assert spark.range(1).select(lon, lat).first()[1] is None


def test_contracts(spark):
    df = spark.range(1).withColumn("gap", F.lit(None))
    with pytest.raises(contracts.ContractError):
        contracts.require_columns(df, ["nope"])
    assert contracts.untyped_columns(df) == ["gap"]
    assert contracts.drop_untyped(df).columns == ["id"]
    assert contracts.cast_untyped(df).schema["gap"].dataType.simpleString() == "string"
    assert contracts.resolve_column(["my_lon_x", "LON"], ["lon"]) == "LON"
    assert contracts.resolve_column(["my_lon_x"], ["lon"]) == "my_lon_x"


def test_bin_headers():
    found = {h: multipliers.canonical_bin(h) for h in ["01", "4-5", "4_5 ", "6-9", "7-8", "10-20", "12-30", "20+", ">20", "2-5", "LOB", "3-4"]}
    assert found == {
        "01": "1", "4-5": "4_5", "4_5 ": "4_5", "6-9": "6_8", "7-8": "6_8", "10-20": "9_20", "12-30": "9_20",
        "20+": "20", ">20": "20", "2-5": "4_5", "LOB": None, "3-4": None,
    }


HEADER = "LOB;urban;built;1;2;3;4-5;6-8;9-20;20+;SUM"


def test_multiplier_file(spark, tmp_path):
    path = tmp_path / "props.csv"
    path.write_bytes(b"\xef\xbb\xbf" + (HEADER + "\nRES;0;11;0,60;0,33;0,07;0;0;0;0;1,00\nCOM;x;21;0,2;0,2;0;0;0;0;0;0,4\n").encode())
    raw = delimited.read_multipliers(spark, str(path))
    assert raw.columns[0] == "LOB"
    clean = multipliers.clean_proportions(raw, "abc", fix_rows=True)
    got = rows(clean.select("ISO3", "LOB", "urban", "storey", "1", "2", "3"), "LOB")
    assert got == [("ABC", "COM", 0, 21, 0.5, 0.5, 0.0), ("ABC", "RES", 0, 11, 0.6, 0.33, 0.07)]
    long = multipliers.to_long(clean)
    assert long.count() == 14


def test_multiplier_file_in_latin1_with_percentages(spark, tmp_path):
    path = tmp_path / "props.csv"
    text = "LOB,urban,storey,1,2,note é\nRES,0,11,60,40,a\nRES,1,11,70,30,b\n"
    path.write_bytes(text.encode("latin-1"))
    raw = delimited.read_multipliers(spark, str(path))
    assert raw.columns[-1] == "note é"
    got = rows(multipliers.clean_proportions(raw, "abc").select("urban", "1", "2", "20"), "urban")
    assert got == [(0, 0.6, 0.4, 0.0), (1, 0.7, 0.3, 0.0)]


def test_incompatible_template_raises_one_error(spark):
    raw = spark.createDataFrame([("a", "1")], "NOS string, P_1 string")
    with pytest.raises(contracts.ContractError, match="LOB"):
        multipliers.clean_proportions(raw, "abc")


def test_separator():
    assert delimited.pick_separator("a;b;c,d") == ";"
    assert delimited.pick_separator("a\tb\tc") == "\t"
    assert delimited.pick_separator("a;b,c") == ","


def test_insured_values_to_long(spark):
    tsi = spark.createDataFrame([("RES", 1, 2, 3, 4, 5, 6, 7)], "LOB string, `1` int, `2` int, `3` int, `4_5` int, `6_8` int, `9_20` int, `20` int")
    assert rows(multipliers.values_to_long(tsi), "tsi")[-1] == ("RES", "20", 7.0)


def multiplier_tables(spark):
    bins = cls.BINS
    props = [(lob, u, c, b, 1.0 if b == "1" else 0.0) for lob in cls.LOBS for u in (0, 1) for c in cls.LOB_CLASSES[lob] for b in bins]
    tsi = [(lob, b, 10.0 * (i + 1)) for lob in cls.LOBS for i, b in enumerate(bins)]
    return (
        spark.createDataFrame(props, "lob string, urban int, built int, bin string, prop double"),
        spark.createDataFrame(tsi, "lob string, bin string, tsi double"),
    )


COUNTS = "grid_id string, urban int, lat double, lon double, built int, count bigint"


def test_imputation_and_missing_settlement(spark):
    props, tsi = multiplier_tables(spark)
    data = [
        ("a", 0, 1.0, 1.0, 11, 5), ("a", 0, 1.0, 1.0, 21, 2),  # donor for every line
        ("b", 0, 2.0, 1.0, 11, 3),                              # no COM: takes the mean of group 0
        ("c", 1, 3.0, 1.0, 11, 4),                              # no COM and no donor in group 1: stays 0
        ("d", None, 4.0, 1.0, 11, 9),                           # unknown group: no storeys, never imputed
        ("e", 0, 5.0, 1.0, 11, 0),                              # empty cell is dropped
    ]
    counts = spark.createDataFrame(data, COUNTS)
    profiles = country.enriched(counts, props, tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    got = {(r.grid_id, r.lob): (r.b_1, r.s_1) for r in profiles.collect()}
    assert got[("a", "RES")] == (5.0, 1.0)
    assert got[("a", "IND")] == (2.0, 1.0)
    assert got[("b", "COM")] == (0.0, 1.0)
    assert got[("c", "COM")] == (0.0, 0.0)
    assert got[("d", "RES")] == (0.0, 0.0)
    assert ("e", "RES") not in got
    wide = exposure.wide_exposure(profiles, exposure.CELL_KEYS, exposure.CELL_POSITION)
    d = wide.filter("grid_id = 'd'").first()
    assert d["urban"] is None and d["nr11_res"] == 9 and d["nr21_ind"] == 0 and d["RES_Buildings_SUM"] == 0.0
    assert wide.count() == 4


def test_summary_is_dense_and_zero_safe(spark):
    props, tsi = multiplier_tables(spark)
    counts = spark.createDataFrame([("a", 0, 1.0, 1.0, 11, 5)], COUNTS)
    out = {(r.lob, r.area, r.bin): r for r in country.country_summary(counts, props, tsi).collect()}
    assert len(out) == 3 * 4 * 8
    assert out[("RES", "OVERALL", "SUM")].buildings_pct == 100.0
    assert out[("COM", "URBAN", "SUM")].buildings_pct == 0.0
    assert out[("RES", "RURAL", "1")].insured == 50.0


def test_exposure_plan_moves_cells_once(spark, inputs):
    from checks.exposure_checks import grid_counts

    cells = grid_counts(inputs)
    # Multipliers are tables, as they are in use; the plan of the fixture that makes them is not looked at.
    props, tsi = cut_lineage(inputs.fx_props), cut_lineage(inputs.fx_tsi)
    profiles = exposure.storey_profiles(exposure.pivot_counts(cells, exposure.CELL_KEYS), props, tsi)
    plan = plan_of(exposure.wide_exposure(profiles, exposure.CELL_KEYS))
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning(grid_id") == 1


def test_export(spark, inputs, tmp_path):
    from checks.exposure_checks import grid_counts

    country.export(grid_counts(inputs), inputs.fx_props, inputs.fx_tsi, str(tmp_path / "out"))
    cells = spark.read.csv(str(tmp_path / "out" / "exposure"), header=True)
    view = spark.read.csv(str(tmp_path / "out" / "view_com"), header=True)
    assert cells.count() == view.count() > 0
    assert view.columns == ["ID", "POINT_X", "POINT_Y", "ORDER_ID_XY", "1", "2", "3", "5", "7", "10", "40", "SUM"]
    assert spark.read.csv(str(tmp_path / "out" / "summary"), header=True).count() == 96
    table = country.exposure_table(grid_counts(inputs), inputs.fx_props, inputs.fx_tsi)
    ids = [r[0] for r in table.orderBy("lon", "lat", "grid_id").select("ID_ORDER_XY").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_zonal_edges(spark):
    data = [(1, 255), (1, 255), (2, 12), (2, 11), (3, 11), (3, 99), (3, 99)]
    pixels = spark.createDataFrame(data, "cell int, code int")
    top = {r.cell: (r.dominant_class, r.dominant_count) for r in zonal.dominant_class(pixels, ["cell"]).collect()}
    assert top == {1: (None, 0), 2: (11, 1), 3: (99, 2)}
    stats = {r.cell: (r["mean"], r.pixel_count, r.coverage) for r in zonal.zonal_stats(pixels, ["cell"]).collect()}
    assert stats[1] == (None, 0, 0.0) and stats[2] == (11.5, 2, 100.0)
    long = zonal.class_counts_long(pixels, ["cell"])
    assert long.count() == 30
    assert long.filter("cell = 1 and share is not null").count() == 0
    groups = zonal.settlement_groups(spark.createDataFrame([(1, 30), (1, 21), (2, 255)], "cell int, smod int"), ["cell"])
    assert {r.cell: r.urban for r in groups.collect()} == {1: 1, 2: None}


def test_counts_add_up_to_valid_pixels(spark, inputs):
    wide = zonal.class_counts_wide(inputs.fx_pixels, ["tile", "ci", "cj"], codes=[0, *cls.BUILT_CLASSES])
    total = sum((F.col(f"class_{c}") for c in [0, *cls.BUILT_CLASSES]), F.lit(0))
    assert wide.filter(total != F.col("valid_pixels")).count() == 0


def brute_inside(px, py, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


RING = [(0.0, 0.0), (10.0, 0.0), (10.0, 8.0), (5.0, 3.0), (0.0, 8.0), (0.0, 0.0)]


def ring_edges(spark, ring=RING, poly="p"):
    df = spark.createDataFrame([(poly, [{"x": x, "y": y} for x, y in ring])], "poly string, ring array<struct<x:double,y:double>>")
    return polygons.ring_edges(df)


def test_polygon_membership_on_borders_and_inside(spark):
    points = [(i, x / 2.0, y / 2.0) for i, (x, y) in enumerate((a, b) for a in range(-2, 24) for b in range(-2, 20))]
    df = spark.createDataFrame(points, "id int, x double, y double")
    for band in (0.7, 3.0, 100.0):
        got = {r.id for r in polygons.points_in_polygons(df, ring_edges(spark), band).collect()}
        assert got == {i for i, x, y in points if brute_inside(x, y, RING)}
        columned = {r.id for r in polygons.points_in_polygons(df, ring_edges(spark), band, column=1.3).collect()}
        assert columned == got


def test_membership_shuffles_no_crossings(spark, monkeypatch):
    points = [(i, x / 2.0, y / 2.0) for i, (x, y) in enumerate((a, b) for a in range(-2, 24) for b in range(-2, 20))]
    df = spark.createDataFrame(points, "id int, x double, y double")
    wanted = {i for i, x, y in points if brute_inside(x, y, RING)}
    two = ring_edges(spark).unionByName(ring_edges(spark, poly="q"))
    found = polygons.points_in_any(df, two, 3.0)
    assert "LeftSemi" in plan_of(found)  # stops at the first polygon
    assert sorted(r.id for r in found.collect()) == sorted(wanted)
    for few in (0, 2, 3, 64):  # all, some or no cells have too many edges for one row
        monkeypatch.setattr(polygons, "FEW_EDGES", few)
        got = polygons.points_in_polygons(df, two, 3.0, column=4.0).collect()
        assert sorted((r.id, r.poly) for r in got) == sorted((i, p) for i in wanted for p in "pq")
        assert {r.id for r in polygons.points_in_any(df, two, 3.0).collect()} == wanted


def test_few_edges_are_tested_in_the_join(spark, monkeypatch):
    """The join with parts of up to ``FLAT_EDGES`` edges calls no lambda, and all sizes of parts agree."""
    draw = random.Random(3)
    points = [(i, draw.uniform(-1, 11), draw.choice([0.0, 3.0, 8.0, draw.uniform(-1, 9)])) for i in range(400)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    wanted = sorted(i for i, x, y in points if brute_inside(x, y, RING))
    plan = polygons.points_in_polygons(df, ring_edges(spark), 3.0, column=4.0)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "_slope" in line]
    assert joins and all("lambda" not in line for line in joins) and "Sort [_band" in plan
    for flat in (0, 1, 2, 3, 9):
        monkeypatch.setattr(polygons, "FLAT_EDGES", flat)
        assert sorted(r.id for r in polygons.points_in_polygons(df, ring_edges(spark), 3.0, column=4.0).collect()) == wanted
        assert sorted(r.id for r in polygons.points_in_any(df, ring_edges(spark), 8.5).collect()) == wanted


def test_upsampling_is_dealt_over_tasks(spark):
    px = spark.range(1, numPartitions=1).select(F.explode(F.sequence(F.lit(0), F.lit(11))).alias("k")).select(
        (F.col("k") % 4).alias("px"), F.floor(F.col("k") / 4).alias("py"), F.col("k").cast("double").alias("v")
    )
    out = grid.upsample_bilinear(px, 4, 3, 2)
    assert "REPARTITION_BY_NUM" in plan_of(out)
    got = {(r.px, r.py): r.v for r in out.collect()}
    assert len(got) == 48 and all(abs(v - (x * 3 / 7 + 4 * y * 2 / 5)) < 1e-9 for (x, y), v in got.items())


def test_fill_equals_point_test(spark):
    cell = 0.37
    got = {(r.i_idx, r.j_idx) for r in polygons.fill_cells(ring_edges(spark), -1.0, -1.0, cell).collect()}
    want = {
        (i, j) for i in range(60) for j in range(60)
        if brute_inside(-1.0 + (i + 0.5) * cell, -1.0 + (j + 0.5) * cell, RING)
    }
    assert got == want


def test_boundary_cells_cover_partial_cells(spark):
    got = {(r.i_idx, r.j_idx) for r in polygons.boundary_cells(ring_edges(spark), 0.0, 0.0, 1.0).collect()}
    for i in range(10):
        for j in range(9):
            corners = {brute_inside(x + dx, y + dy, RING) for x, y in [(i, j)] for dx in (0.01, 0.99) for dy in (0.01, 0.99)}
            if len(corners) == 2:
                assert (i, j) in got


def test_geojson_collection(spark, tmp_path):
    import gzip
    import json

    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"ISO3": "ABC"}, "geometry": {"type": "Polygon", "coordinates": [ring, ring]}},
        {"type": "Feature", "properties": {"ISO3": "XYZ"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
    ]
    path = tmp_path / "admin.geojson.gz"
    with gzip.open(path, "wt") as out:
        json.dump({"type": "FeatureCollection", "features": features}, out, indent=1)
    import os
    plain = tmp_path / "admin.json.gz"
    os.link(path, plain)
    assert geo.read_admin(spark, str(plain), "ISO3", "XYZ").count() == 6
    with pytest.raises(contracts.ContractError):
        geo.read_admin(spark, str(plain), "ISO3", "QQQ")


def test_nearest_equals_brute_force_under_crowding(spark):
    random.seed(3)
    crowd = [(random.gauss(0, 0.01), random.gauss(0, 0.01)) for _ in range(150)] + [(5.0, 5.0)] * 40
    spread = [(random.uniform(-100, 100), random.uniform(-100, 100)) for _ in range(60)]
    pts = [(k, x, y) for k, (x, y) in enumerate(crowd + spread)]
    q = spark.createDataFrame(pts, "query_id int, x double, y double")
    t = spark.createDataFrame(pts, "target_id int, x double, y double")
    got = {}
    for r in neighbours.nearest(q, t, 3, skip_self=True).collect():
        got.setdefault(r.query_id, {})[r.place] = (r.target_id, r.distance)
    for k, x, y in pts:
        best = sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), j) for j, a, b in pts if j != k)[:3]
        assert [round(got[k][p][1], 9) for p in (1, 2, 3)] == [round(d, 9) for d, _ in best]


def test_buffer_equals_brute_force(spark):
    random.seed(5)
    a = [(k, random.uniform(0, 20), random.uniform(0, 20)) for k in range(150)]
    b = [(k, random.uniform(0, 20), random.uniform(0, 20)) for k in range(20)] + [(99, 3.0, 3.0)] * 50
    left = spark.createDataFrame(a, "id int, x double, y double")
    right = spark.createDataFrame(b, "id int, x double, y double")
    got = {r.id for r in neighbours.outside_buffer(left, right, 1.5).collect()}
    assert got == {k for k, x, y in a if all(math.hypot(x - p, y - q) >= 1.5 for _, p, q in b)}


def test_ranks_quantiles_and_hash_picks(spark):
    random.seed(7)
    data = [(k, "hot" if k % 3 else f"g{k % 5}", float(random.randint(0, 9))) for k in range(400)]
    df = spark.createDataFrame(data, "id int, g string, v double")
    import pandas as pd

    pdf = pd.DataFrame(data, columns=["id", "g", "v"])
    pdf["r"] = pdf.groupby("g").v.rank()
    want = {(r.g, r.v): r.r for r in pdf.itertuples()}
    got = {(r.g, r.v): r.avg_rank for r in ranking.average_ranks(df, "v", ["g"]).collect()}
    assert got == want
    quart = {r.g: (r.a, r.b) for r in ranking.exact_quantiles(df, "v", {"a": 0.25, "b": 0.8}, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert quart[g] == pytest.approx((part.v.quantile(0.25), part.v.quantile(0.8)))
    picked = ranking.first_k_by_hash(df, "id", 7, ["g"]).filter("picked = 1")
    sizes = {r.g: r.n for r in picked.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {g: min(7, len(part)) for g, part in pdf.groupby("g")}
    assert ranking.first_k_by_hash(df, "id", 0).filter("picked = 1").count() == 0
    assert ranking.first_k_by_hash(df, "id", 1000).filter("picked = 1").count() == 400


def test_order_is_not_made_in_one_partition(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    out = ranking.global_order_id(df, ["x", "id"])
    assert [r.order_id for r in out.orderBy("x", "id").collect()] == list(range(1, 1001))
    ranged = [line for line in plan_of(out).splitlines() if "Window" in line and "x#" in line]
    assert all("_part" in line for line in ranged)


def test_folds_are_disjoint_and_separate(spark, inputs):
    folds = splits.spatial_folds(inputs.fx_points, "point_id", folds=3, buffer=20000.0)
    counts = folds.groupBy("point_id", "fold").agg(F.count(F.lit(1)).alias("n"))
    assert counts.filter("n > 1").count() == 0
    placed = folds.join(inputs.fx_points.select("point_id", "x", "y"), "point_id").collect()
    by = {}
    for r in placed:
        by.setdefault((r.site, r.fold), {}).setdefault(r.split, []).append((r.x, r.y))
    for parts in by.values():
        assert len(parts["test"]) >= 5 and len(parts["val"]) >= 5 and len(parts["train"]) >= 10
        for x, y in parts["train"][:50]:
            assert min(math.hypot(x - a, y - b) for a, b in parts["test"]) >= 20000.0


def test_small_sites_train_in_every_fold(spark):
    pts = [(k, "big" if k < 60 else "small", float(k % 13) * 10, float(k % 7) * 10) for k in range(70)]
    df = spark.createDataFrame(pts, "point_id int, site string, x double, y double")
    folds = splits.spatial_folds(df, "point_id", folds=2)
    small = folds.filter("site = 'small'")
    assert small.count() == 20 and small.filter("split <> 'train'").count() == 0
    assert folds.filter("site = 'big'").select("split").distinct().count() == 3


def test_hard_examples_draw_exactly_twice_the_rows(spark):
    errors = spark.createDataFrame([(k, float(k % 11)) for k in range(333)], "id int, error double")
    drawn = splits.hard_example_draws(splits.hard_example_weights(errors), "id")
    got = drawn.agg(F.sum("draws"), F.count(F.lit(1))).first()
    assert tuple(got) == (666, 333)
    equal = splits.hard_example_weights(spark.createDataFrame([(k, 2.0) for k in range(4)], "id int, error double"))
    assert {round(r.weight, 9) for r in equal.collect()} == {0.25}


def test_pair_lattice_equals_brute_force(spark):
    random.seed(11)
    pts = [(k, "s", float(random.randint(0, 7)), float(random.randint(0, 7)), float(random.randint(0, 3))) for k in range(90)]
    # Corners fix the lattice and classes, so that positions fall on it exactly.
    pts += [(100, "s", 0.0, 0.0, 0.0), (101, "s", 8.0, 8.0, 4.0)]
    df = spark.createDataFrame(pts, "point_id int, site string, x double, y double, value double")
    got = {(r.d2, r.dv): r.pairs for r in neighbours.pair_lattice(df, 8, 4).collect()}
    want = {}
    cells = [(min(7, int(x)), min(7, int(y)), min(3, int(v))) for _, _, x, y, v in pts]
    for a in range(len(cells)):
        for b in range(len(cells)):
            if a != b:
                key = ((cells[a][0] - cells[b][0]) ** 2 + (cells[a][1] - cells[b][1]) ** 2, abs(cells[a][2] - cells[b][2]))
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_chip_counts_of_known_sites():
    stride = chips.chip_stride(24, 0.1)
    assert stride == 21
    found = [chips.chip_positions(h, 24, stride) * chips.chip_positions(w, 24, stride) for h, w in ((665, 658), (252, 266), (103, 66), (20, 30))]
    assert found == [961, 132, 12, 0]


def test_chips_of_a_small_image_vanish(spark):
    pixels = spark.range(100).select((F.col("id") % 10).alias("px"), F.floor(F.col("id") / 10).alias("py"))
    assert chips.cut_chips(pixels, 10, 10, 24, 21).count() == 0


def test_jitter_is_repeatable_and_bounded(spark):
    df = spark.range(200).select((F.col("id") % 10).alias("chip"), (F.col("id") % 4).alias("band"), F.lit(100.0).alias("v"))
    a, b = (rows(chips.spectral_jitter(df, "chip", 4), "chip", "band", "v") for _ in range(2))
    assert a == b and all(89.9 <= v <= 110.1 for _, _, v in a)


def test_tiles_keep_all_pixels_and_prune(spark):
    df = spark.createDataFrame([(7, 5, 4, bytearray(range(20))), (8, 5, 4, None)], "tile_id int, width int, height int, data binary")
    strips = tiles.split_strips(df, 3)
    got = rows(tiles.decode_pixels(strips, nodata=None), "code")
    assert got == [(7, k % 5, k // 5, k) for k in range(20)]
    assert tiles.strips_in_window(strips, 3, 3).filter("tile_id = 7").count() == 1


def test_snapshot_names_and_tables(spark, tmp_path):
    for name in ("class_counts_all_20250101_120000.csv", "class_counts_all_20250301_010000.csv", "class_counts_all_zzz.csv"):
        (tmp_path / name).write_text("a,b\n1,%s\n" % name[-8:-4])
    assert tables.read_latest(spark, str(tmp_path)).first()["b"] in ("0000", 0)
    assert [tables.is_table_name(n) for n in ("table:x", "delta:a.b", "a.b.c", "x", "/p/x.csv", "x.csv")] == [True, True, True, True, False, False]
    with pytest.raises(contracts.ContractError):
        tables.read_source(spark, "table:does_not_exist")


def test_retention_drops_old_tables_and_keeps_today(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keep")
    for name in ("exposure_abc_250101", "exposure_abc_250102"):
        spark.range(1).write.mode("overwrite").saveAsTable(f"keep.{name}")
    dropped = tables.drop_outdated(spark, "keep", ["exposure_abc_"], "250102")
    assert dropped == ["exposure_abc_250101"]
    assert [t.name for t in spark.catalog.listTables("keep") if not t.isTemporary] == ["exposure_abc_250102"]


def test_csv_export_of_missing_and_empty_sources(spark, tmp_path):
    assert sinks.export_csv(spark, "table:missing_one", str(tmp_path / "x")) is False
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    assert sinks.export_csv(spark, str(tmp_path / "none.parquet"), str(tmp_path / "x")) is False


def test_fold_rows_reproduce_the_published_summary(spark):
    folds = [(0.1030, 0.9293, 0.0815, 0.9591), (0.1174, 0.9285, 0.0877, 0.9455), (0.1583, 0.8687, 0.1182, 0.9315),
             (0.1291, 0.8824, 0.1009, 0.9167), (0.1460, 0.8883, 0.1032, 0.9408)]
    out = metrics.fold_summary(spark.createDataFrame(folds, "rmse double, r2 double, mae double, spearman double"), ["rmse", "r2", "mae", "spearman"]).first()
    assert (round(out.mean_rmse, 4), round(out.std_rmse, 4)) == (0.1308, 0.0197)
    assert (round(out.mean_r2, 4), round(out.std_r2, 4)) == (0.8994, 0.0249)
    assert (round(out.mean_mae, 4), round(out.std_mae, 4)) == (0.0983, 0.0128)
    assert (round(out.mean_spearman, 4), round(out.std_spearman, 4)) == (0.9387, 0.0142)


def test_spatial_joins_have_no_nested_loops(spark, inputs):
    points = inputs.fx_points.select("point_id", "x", "y")
    prints = grid.assign_footprint(points, inputs.fx_footprints, 50000.0, "x", "y")
    inside = polygons.points_in_any(points, inputs.fx_diamond_edges, 20000.0, column=50000.0)
    clear = neighbours.outside_buffer(points, points.filter("x < 100000"), 5000.0)
    for df in (prints, inside, clear):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cuts_go_to_the_shared_folder(spark):
    from acreage.session import cut_lineage, shared_dir

    kept = cut_lineage(spark.range(10))
    assert kept.count() == 10
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_dir(spark) in f for f in kept.inputFiles())


def test_sites_without_workable_blocks_fall_back_to_a_plain_draw(spark):
    # All rows of the site share one position, so every block split leaves one side empty.
    pts = [(k, "pile", 1.0, 1.0) for k in range(40)]
    df = spark.createDataFrame(pts, "point_id int, site string, x double, y double")
    folds = splits.spatial_folds(df, "point_id", folds=2)
    sizes = {(r.fold, r.split): r.n for r in folds.groupBy("fold", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {(f, s): n for f in (0, 1) for s, n in (("test", 8), ("val", 8), ("train", 24))}
