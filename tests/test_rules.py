"""Rules that hold at every size: no caps, no lost NULL groups, slices, seeds, areas, encodings."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from acreage.functions.numbers import MODULUS, order_hash, uniform_from
from acreage.operators import change, chips, expected, exposure, features, grid, neighbours, ranking, splits, zonal
from acreage.session import broadcast_counted
from acreage.sources import delimited, tiles
from tests.conftest import plan_of


def test_order_hash_is_no_order(spark):
    keys = spark.range(4000)
    h = [r[0] for r in keys.select(order_hash(F.col("id"), 3)).collect()]
    assert all(0 <= x < MODULUS for x in h) and len(set(h)) == 4000
    rises = sum(a < b for a, b in zip(h, h[1:], strict=False))
    assert 1850 < rises < 2150
    first = sorted(range(4000), key=h.__getitem__)[:400]
    assert 1700 < sum(first) / 400 < 2300
    other = [r[0] for r in keys.select(order_hash(F.col("id"), 4)).collect()]
    assert len(set(first) & set(sorted(range(4000), key=other.__getitem__)[:400])) < 80


def test_draws_of_different_seeds_are_independent(spark):
    rows = spark.range(20000).select(*[uniform_from(F.col("id"), s).alias(f"u{s}") for s in range(4)])
    for a in range(4):
        for b in range(a + 1, 4):
            assert abs(rows.stat.corr(f"u{a}", f"u{b}")) < 0.03
            mean = rows.filter(F.col(f"u{a}") < 0.5).agg(F.avg(f"u{b}")).first()[0]
            assert abs(mean - 0.5) < 0.02


@pytest.mark.parametrize("slice_rows", [7, 100, 10**6])
def test_running_total_in_slices(spark, slice_rows):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "a", "a", "b", None]), float(i) if i % 7 else None, i, draw.randrange(9)) for i in range(600)]
    rows += [("a", 5.0, 1000 + i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, x double, k long, w long")
    got = ranking.running_total(df, ["x", "k"], "w", ["g"], slice_rows=slice_rows)
    order = Window.partitionBy("g").orderBy("x", "k").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("w").over(order), F.lit(0)).alias("before"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_without_group_stay(spark):
    rows = [(None if i % 2 else "s", i, float(i % 11), float(i % 7), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "site string, id long, x double, y double, v double")
    assert sum(r["n_pairs"] for r in ranking.spearman(df, "x", "y", ["site"]).collect()) == 40
    assert ranking.exact_quantiles(df, "v", {"m": 0.5}, ["site"]).count() == 2
    assert splits.sample_per_site(df, "id", 5).count() == 10
    assert splits.spatial_blocks(df).count() == 40
    folded = splits.spatial_folds(df, "id", folds=2)
    assert {r[0] for r in folded.select("site").distinct().collect()} == {None, "s"}
    assert change.percentile_stretch(df, ["site"], ["v"]).count() == 40
    pairs = neighbours.pair_lattice(df, 8, 4, value="v")
    assert pairs.select("site").distinct().count() == 2
    bands = df.select("site", (F.col("id") % 3).alias("band"), "id", "v")
    assert chips.impute_bands(bands, ["site"]).count() == 40


def test_crowded_buckets_and_repeated_points(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0)] * 3 + [(2, 50.0, 5.0)] * 2 + [(3, None, 1.0)], "id int, centroid_x double, centroid_y double")
    many = [(f"t{i:04d}", 0.0 - i / 1e4, 0.0, 10.0, 10.0) for i in range(1200)]
    shape = "tile_id string, minx double, miny double, maxx double, maxy double"
    crowded = grid.assign_footprint(points, spark.createDataFrame(many, shape), 100.0)
    sparse = grid.assign_footprint(points, spark.createDataFrame(many[:2], shape), 100.0)
    want = [(1, "t0000")] * 3 + [(2, None)] * 2 + [(3, None)]
    for out in (crowded, sparse):
        assert sorted(((r["id"], r["tile_id"]) for r in out.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_encoding_is_decided_by_the_whole_file(spark, tmp_path, encoding):
    path = tmp_path / "m.csv"
    path.write_bytes("\n".join(["LOB;a;b"] + ["X;1;2"] * 10_000 + ["RÉS;3;4"]).encode(encoding))
    values = {r["LOB"] for r in delimited.read_multipliers(spark, str(path)).collect()}
    assert values == {"X", "RÉS"}


def test_every_labelled_area_is_summarised(spark):
    bins = exposure.BINS
    columns = ", ".join([f"b_{b} double, v_{b} double" for b in bins])
    rows = [("RES", u, *[float(u + 1)] * (2 * len(bins))) for u in (0, 1, 2)]
    profiles = spark.createDataFrame(rows, f"lob string, urban int, {columns}")
    labels = {0: "COUNTRYSIDE", 1: "IT'S TOWN", 2: "CITY"}
    out = {(r["area"], r["bin"]): r["buildings"] for r in exposure.area_summary(profiles, labels).collect()}
    assert {a for a, _ in out} == {"OVERALL", "RURAL", *labels.values()}
    assert out["COUNTRYSIDE", "SUM"] == len(bins) and out["OVERALL", "SUM"] == 6 * len(bins)


def test_no_row_and_no_band_is_left_out(spark):
    rows = [(float(i % 5) if i % 2 else None, float("nan") if i % 3 else 1.0, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    scored = features.transfer_benchmark(df, df, ["a", "b"], "y", dict(list(features.tree_regressors(trees=2, depth=2).items())[:1]))
    assert scored.count() == 60
    wide = spark.createDataFrame([tuple(float(i + 1) for i in range(45)) + (5.0,)], ", ".join(f"c{i} double" for i in range(45)) + ", t double")
    out = features.pixel_features(wide, [], [f"c{i}" for i in range(45)], "t", {})
    assert "Band_45" in out.columns
    vectors = spark.createDataFrame([([float(draw * i % 17) for i in range(30)],) for draw in range(40)], "v array<double>")
    assert features.principal_components(vectors, "v", 25).columns[-1] == "PCA_25"


def test_broadcasts_are_bound_in_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    facts = spark.range(1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = {(rows, size): "BroadcastHashJoin" in plan_of(facts.join(broadcast_counted(df, rows, size), "id")) for rows in (50, 200) for size in (10_000, 10**7)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert hinted == {(50, 10_000): False, (50, 10**7): False, (200, 10_000): False, (200, 10**7): True}


def test_jitter(spark):
    rows = [(c, b, float(p + b)) for c in range(300) for b in range(12) for p in range(4)]
    df = spark.createDataFrame(rows, "chip long, band int, v double")
    changed = (
        chips.spectral_jitter(df.withColumn("old", F.col("v")), "chip", 12).filter(F.abs(F.col("v") - F.col("old")) > 1e-9)
        .select("chip", "band").distinct().groupBy("chip").agg(F.sort_array(F.collect_list("band")).alias("bands")).collect()
    )
    share = len(changed) / 300
    sizes = [len(r["bands"]) for r in changed]
    assert 0.25 < share < 0.6 and max(sizes) <= 3 and len(set(sizes)) > 1
    gaps = [b - a for r in changed for a, b in zip(r["bands"], r["bands"][1:], strict=False)]
    assert len(set(gaps)) > 4 and math.isfinite(sum(gaps))


def test_far_sets_meet_through_few_pairs(spark):
    draw = random.Random(2)
    queries = spark.createDataFrame([(i, draw.random(), draw.random()) for i in range(12_000)], "query_id long, x double, y double")
    targets = spark.createDataFrame([(i, 1000 + draw.random(), draw.random()) for i in range(12_000)], "target_id long, x double, y double")
    got = neighbours.nearest(queries, targets, 1).collect()
    assert len(got) == 12_000
    edge = sorted(((r["target_id"], r["x"], r["y"]) for r in targets.collect()), key=lambda t: t[1])[:600]
    place = {r["query_id"]: (r["x"], r["y"]) for r in queries.collect()}
    for r in got[::400]:
        x, y = place[r["query_id"]]
        assert r["distance"] == pytest.approx(min(math.hypot(x - a, y - b) for _, a, b in edge), rel=1e-9)


@pytest.mark.parametrize("seed", range(6))
def test_scales_by_counting_equal_scales_by_median(spark, seed):
    from acreage.operators import multipliers

    draw = random.Random(seed)
    choices = [None, 0.0, 0.5, 1.0, 1.2, 1.5, 1.6, 2.0, 60.0][: draw.randrange(3, 10)]
    rows = [tuple(draw.choice(choices) for _ in range(4)) for _ in range(draw.randrange(1, 9))]
    df = spark.createDataFrame([(*r, None) for r in rows], "a double, b double, c double, d double, e double")
    want = {r["bin"]: r["scale"] for r in multipliers.column_scales(df, list("abcde")).collect()}
    assert {r["bin"]: r["scale"] for r in multipliers.bin_scales(df, list("abcde")).collect()} == want


@pytest.mark.parametrize("large", ["false", "true"])
def test_tile_bytes_with_large_arrow_types(spark, large):
    from acreage.sources import tiles

    strips = spark.createDataFrame([(t, 0, 3, bytearray([t, 2, 3, 4, 5, 6])) for t in range(4)], "tile_id long, row0 long, width long, data binary")
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", large)
    try:
        got = sorted(tuple(r) for r in tiles.decode_pixels(strips).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    assert got == sorted((t, i % 3, i // 3, [t, 2, 3, 4, 5, 6][i]) for t in range(4) for i in range(6))


def _nearest_by_hand(queries, targets, k):
    return {q: [t for _, t in sorted((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), t) for t, a, b in targets)[:k]] for q, x, y in queries}


def test_far_sets_keep_few_pairs(spark):
    """Sets much farther apart than wide are settled by few pairs of cells: the sides of a query box decide, not bounds on distances."""
    queries = [(i, float(i * 7919 % 100), float(i * 104729 % 97)) for i in range(2000)]
    targets = [(i, 50000.0 + i * 7919 % 101, float(i * 104729 % 103)) for i in range(2000)]
    q, t = spark.createDataFrame(queries, "query_id int, x double, y double"), spark.createDataFrame(targets, "target_id int, x double, y double")
    got = {}
    for r in neighbours.nearest(q, t, 2).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append(r.target_id)
    assert got == _nearest_by_hand(queries, targets, 2)
    box = lambda df, side, key: df.select(F.col("x").alias("_x"), F.col("y").alias("_y")).groupBy(
        F.floor(F.col("_x") / 4).alias(f"_{side}x"), F.floor(F.col("_y") / 4).alias(f"_{side}y")
    ).agg(F.min("_x").alias(f"_{side}x0"), F.max("_x").alias(f"_{side}x1"), F.min("_y").alias(f"_{side}y0"), F.max("_y").alias(f"_{side}y1"), F.count(F.lit(1)).alias("_n"))
    query_boxes = box(q, "q", "query_id").drop("_n")
    kept = neighbours._kept_pairs(query_boxes.crossJoin(box(t, "s", "target_id")), 2)
    assert kept.count() < 20 * query_boxes.count()


def test_rounds_copy_a_target_to_few_cells(spark, monkeypatch):
    """A round copies a target only to the cells within its reach, less than three on average and not nine."""
    rnd = random.Random(3)
    rows = [(i, rnd.random() * 1000, rnd.random() * 1000) for i in range(3000)]
    spots = spark.createDataFrame(rows, "_t int, _tx double, _ty double")
    asked = spots.withColumnsRenamed({"_t": "_q", "_tx": "_x", "_ty": "_y"})
    plans = []
    monkeypatch.setattr(neighbours, "cut_lineage", lambda df: plans.append(df) or df)
    settled = neighbours._near_round(asked, spots, 1, 10.0, True, [], []).filter("_found = 1")
    assert settled.count() > 1000
    side, reach = neighbours.ROUND_CELL * 10.0, 10.0
    copies = sum(
        (math.floor((x + reach) / side) - math.floor((x - reach) / side) + 1) * (math.floor((y + reach) / side) - math.floor((y - reach) / side) + 1)
        for _, x, y in rows
    )
    assert copies < 3 * len(rows)


def test_penalty_needs_no_join_for_the_residuals(spark, monkeypatch):
    """Residuals ride along with the neighbours, so that rows of pairs are not shuffled by target."""
    asked = []
    whole = neighbours.nearest
    monkeypatch.setattr(neighbours, "nearest", lambda *a, **kw: asked.append(kw) or whole(*a, **kw))
    rows = [(i, float(i % 7), float(i // 7), None if i == 3 else float(i % 5)) for i in range(40)]
    points = spark.createDataFrame(rows, "point_id int, x double, y double, residual double")
    got = neighbours.spatial_penalty(points, 4).first()
    assert asked[0]["target_columns"] and asked[0]["query_columns"]
    at = {i: (x, y, v) for i, x, y, v in rows}
    total = 0.0
    for i, x, y, v in rows:
        near = sorted((math.hypot(x - a, y - b), j) for j, (a, b, _) in at.items() if j != i)[:4]
        parts = [abs(abs(at[j][2] - v) - d / (near[-1][0] + 1e-8)) for d, j in near if v is not None and at[j][2] is not None]
        total += sum(parts) / len(parts) if parts else 0.0
    assert abs(got.penalty - total / 40) < 1e-9


def _tasks(df):
    return [n for n in df.rdd.glom().map(len).collect() if n]


def test_dense_cells_are_dealt_by_their_number(spark, monkeypatch):
    """Cells that grow into many rows in one task are dealt over tasks in proportion to the counts, not to their bytes."""
    monkeypatch.setattr(expected, "TASK_COUNTS", 100)
    counts = spark.range(6000).select(
        (F.col("id") % 2000).alias("cell"), (F.col("id") % 3).cast("int").alias("smod"), F.lit(11).alias("built"), F.lit(1).alias("count")
    )
    dense = expected.dense_counts(counts, [0, 1, 2], [11, 12])
    found = _tasks(dense)
    assert len(found) > 40 and sum(found) == 12000 and max(found) < 600
    assert dense.agg(F.sum("count")).first()[0] == 6000


def test_strips_are_dealt_over_all_cores(spark):
    """Well compressed strips come in one task, and the cells of all of them are not counted there."""
    tile = spark.range(400).coalesce(1).select(
        F.col("id").alias("tile_id"), F.lit(4).alias("width"), F.lit(2).alias("height"), F.unhex(F.lit("0B0C0D0E0B0C0D0E")).alias("data")
    )
    out = zonal.class_counts_from_tiles(tiles.split_strips(tile, 1), 2)
    assert "repartition" in plan_of(out).lower()
    got = out.filter("built = 11").agg(F.count(F.lit(1)), F.sum("count"), F.sum("valid_pixels")).first()
    assert tuple(got) == (800, 800, 3200)


def test_variants_are_made_of_counted_pixels(inputs):
    """Pixels are counted before there are six of each, so a row per variant is never shuffled."""
    from checks.chip_checks import geometric_variants

    plan = plan_of(geometric_variants(inputs))
    assert plan.index("Generate") < plan.index("Exchange")  # plans print the last step first
