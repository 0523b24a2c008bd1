"""Exposure: storey distribution, values, shares, imputation, summaries, views, expected counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions import classes as cls
from acreage.operators import expected, exposure
from acreage.plans import country
from checks.base import Inputs, check

KEYS = ["cell", "urban"]
BINS = exposure.BINS


def counts(i: Inputs) -> DataFrame:
    return i.fx_counts.select("cell", "urban", "built", F.col("cnt").alias("count"))


def grid_counts(i: Inputs) -> DataFrame:
    """The same counts under the names of the wide exposure table."""
    return i.fx_counts.select(
        F.col("cell").cast("string").alias("grid_id"),
        "urban",
        (F.col("lat_e2") / 100.0).alias("lat"),
        (F.col("lon_e2") / 100.0).alias("lon"),
        "built",
        F.col("cnt").alias("count"),
    )


def cells(i: Inputs) -> DataFrame:
    return exposure.pivot_counts(counts(i), KEYS)


def profiles(i: Inputs) -> DataFrame:
    return exposure.storey_profiles(cells(i), i.fx_props, i.fx_tsi)


def r(name: str, digits: int = 4):
    """Rounded a hair above, on both sides, so that exact halves do not depend on summation order."""
    return F.round(F.col(name) + 1e-9, digits).alias(name)


# Long storey distribution of every cell, as SQL.
LONG = """
long AS (
  SELECT c.cell, c.urban, d.lob, d.bin,
         SUM(CASE WHEN (d.lob = 'RES') = (c.built < 20) THEN c.cnt * COALESCE(p.prop, 0) ELSE 0 END) AS buildings, MAX(d.tsi) AS tsi
  FROM fx_counts c CROSS JOIN fx_tsi d
  LEFT JOIN fx_props p ON p.urban = c.urban AND p.built = c.built AND p.lob = d.lob AND p.bin = d.bin
  GROUP BY 1, 2, 3, 4),
valued AS (SELECT cell, urban, lob, bin, buildings, buildings * tsi AS insured FROM long),
shared AS (
  SELECT *, COALESCE(buildings / NULLIF(SUM(buildings) OVER (PARTITION BY cell, lob), 0), 0) AS building_share,
         COALESCE(insured / NULLIF(SUM(insured) OVER (PARTITION BY cell, lob), 0), 0) AS value_share
  FROM valued),
flagged AS (SELECT *, MAX(value_share) OVER (PARTITION BY cell, lob) = 0 AS empty FROM shared),
donors AS (SELECT urban, lob, bin, AVG(value_share) AS mean FROM flagged WHERE NOT empty AND urban IS NOT NULL GROUP BY 1, 2, 3),
imputed AS (
  SELECT f.cell, f.urban, f.lob, f.bin, f.buildings, f.insured, f.building_share,
         CASE WHEN f.empty THEN COALESCE(d.mean, 0) ELSE f.value_share END AS value_share
  FROM flagged f LEFT JOIN donors d ON d.urban = f.urban AND d.lob = f.lob AND d.bin = f.bin)
"""
FX = ("fx_counts", "fx_props", "fx_tsi")


@check(
    "exposure_summary", *FX,
    sql="WITH " + LONG.strip() + """,
areas AS (SELECT lob, bin, CASE urban WHEN 1 THEN 'URBAN' WHEN 2 THEN 'SUBURBAN' ELSE 'RURAL' END AS area, buildings, insured FROM valued),
both_areas AS (SELECT * FROM areas UNION ALL SELECT lob, bin, 'OVERALL', buildings, insured FROM areas),
sums AS (SELECT lob, area, bin, SUM(buildings) AS b, SUM(insured) AS v FROM both_areas GROUP BY 1, 2, 3),
with_sum AS (SELECT * FROM sums UNION ALL SELECT lob, area, 'SUM', SUM(b), SUM(v) FROM sums GROUP BY 1, 2)
SELECT s.lob, s.area, s.bin, ROUND(s.b + 1e-9, 3) AS buildings, ROUND(s.v + 1e-9, 0) AS insured,
       ROUND(COALESCE(s.b * 100 / NULLIF(t.b, 0), 0) + 1e-9, 5) AS buildings_pct, ROUND(COALESCE(s.v * 100 / NULLIF(t.v, 0), 0) + 1e-9, 5) AS insured_pct
FROM with_sum s JOIN with_sum t ON t.lob = s.lob AND t.area = s.area AND t.bin = 'SUM'""",
)
def exposure_summary(i: Inputs) -> DataFrame:
    out = country.country_summary(counts(i), i.fx_props, i.fx_tsi, KEYS)
    return out.select(
        "lob", "area", "bin", r("buildings", 3), r("insured", 0), r("buildings_pct", 5), r("insured_pct", 5)
    )


@check(
    "lob_classes", "fx_counts",
    sql="""SELECT CASE WHEN built BETWEEN 11 AND 15 THEN 'RES' WHEN built BETWEEN 21 AND 25 THEN 'COM' ELSE 'UNKNOWN' END AS lob,
                  built, CAST(SUM(cnt) AS BIGINT) AS n FROM fx_counts GROUP BY 1, 2""",
)
def lob_classes(i: Inputs) -> DataFrame:
    return exposure.classify_lob(counts(i)).groupBy("lob", "built").agg(F.sum("count").alias("n"))


PIVOT = ", ".join(
    f"CAST(SUM(CASE WHEN built = {c} THEN cnt ELSE 0 END) AS BIGINT) AS nr{c}_{'res' if c < 20 else 'com'}"
    for c in cls.BUILT_CLASSES
)


@check("pivot_counts", "fx_counts", sql=f"SELECT cell, urban, {PIVOT} FROM fx_counts GROUP BY 1, 2")
def pivot_counts(i: Inputs) -> DataFrame:
    return cells(i)


@check(
    "drop_empty_cells", "fx_counts",
    sql="""SELECT cell, CAST(SUM(CASE WHEN built > 20 THEN cnt ELSE 0 END) AS BIGINT) AS com FROM fx_counts
           GROUP BY 1 HAVING SUM(CASE WHEN built > 20 THEN cnt ELSE 0 END) > 0""",
)
def drop_empty_cells(i: Inputs) -> DataFrame:
    com = exposure.pivot_counts(counts(i), ["cell"]).drop(*[f"nr{c}_res" for c in cls.RESIDENTIAL])
    kept = exposure.drop_empty_cells(com)
    total = sum((F.col(f"nr{c}_com") for c in cls.NON_RESIDENTIAL), F.lit(0))
    return kept.select("cell", total.cast("bigint").alias("com"))


@check(
    "multiplier_join", *FX,
    sql="""SELECT c.cell, c.urban, c.built, t.lob, t.bin, c.cnt, ROUND(COALESCE(p.prop, 0) + 1e-9, 6) AS prop
           FROM fx_counts c JOIN fx_tsi t ON (t.lob = 'RES') = (c.built < 20)
           LEFT JOIN fx_props p ON p.urban = c.urban AND p.built = c.built AND p.lob = t.lob AND p.bin = t.bin""",
)
def multiplier_join(i: Inputs) -> DataFrame:
    out = exposure.multiplier_join(counts(i), i.fx_props)
    return out.select("cell", "urban", "built", "lob", "bin", F.col("count").alias("cnt"), r("prop", 6))


@check(
    "insured_value_lookup", "fx_counts", "fx_tsi",
    sql="""SELECT t.lob, t.bin, ROUND(SUM(c.cnt * CAST(t.tsi AS DOUBLE)), 0) AS insured
           FROM fx_counts c JOIN fx_tsi t ON t.lob = CASE WHEN c.built < 20 THEN 'RES' ELSE 'COM' END GROUP BY 1, 2""",
)
def insured_value_lookup(i: Inputs) -> DataFrame:
    rows = exposure.classify_lob(counts(i)).withColumn("bin", F.explode(F.array(*[F.lit(b) for b in BINS])))
    joined = exposure.value_join(rows, i.fx_tsi)
    return joined.groupBy("lob", "bin").agg(F.round(F.sum(F.col("count") * F.col("tsi")), 0).alias("insured"))


def long_of(df: DataFrame) -> DataFrame:
    return exposure.profile_long(df, KEYS)


@check(
    "storey_distribution", *FX,
    sql="WITH " + LONG.strip() + " SELECT cell, urban, lob, bin, ROUND(buildings + 1e-9, 4) AS buildings FROM valued",
)
def storey_distribution(i: Inputs) -> DataFrame:
    return long_of(profiles(i)).select(*KEYS, "lob", "bin", r("buildings"))


@check(
    "insured_values", *FX,
    sql="WITH " + LONG.strip() + " SELECT cell, urban, lob, bin, ROUND(insured + 1e-9, 0) AS insured FROM valued",
)
def insured_values(i: Inputs) -> DataFrame:
    return long_of(profiles(i)).select(*KEYS, "lob", "bin", r("insured", 0))


@check(
    "row_shares", *FX,
    sql="WITH " + LONG.strip() + """ SELECT cell, urban, lob, bin, ROUND(building_share + 1e-9, 6) AS building_share,
        ROUND(value_share + 1e-9, 6) AS value_share FROM shared""",
)
def row_shares(i: Inputs) -> DataFrame:
    return long_of(profiles(i)).select(*KEYS, "lob", "bin", r("building_share", 6), r("value_share", 6))


@check(
    "impute_group_means", *FX,
    sql="WITH " + LONG.strip() + " SELECT cell, urban, lob, bin, ROUND(value_share + 1e-9, 6) AS value_share FROM imputed",
)
def impute_group_means(i: Inputs) -> DataFrame:
    return long_of(exposure.impute_shares(profiles(i))).select(*KEYS, "lob", "bin", r("value_share", 6))


def _wide_sql() -> str:
    sums, names = [], []
    for half in (exposure.BLOCKS[:2], exposure.BLOCKS[2:]):
        for lob in cls.LOBS:
            for total, pattern, prefix in half:
                col = {"b_": "buildings", "p_": "building_share", "v_": "insured", "s_": "value_share"}[prefix]
                digits = 0 if prefix == "v_" else 5
                for b in BINS:
                    sums.append(
                        f"ROUND(MAX(CASE WHEN lob = '{lob}' AND bin = '{b}' THEN {col} END) + 1e-9, {digits}) AS \"{pattern.format(lob=lob, bin=b)}\""
                    )
                sums.append(f"ROUND(SUM(CASE WHEN lob = '{lob}' THEN {col} END) + 1e-9, {digits}) AS \"{total.format(lob=lob)}\"")
    for c in exposure.count_columns():
        names.append(f"n.{c.replace('_ind', '_com')} AS {c}")
    return (
        "WITH " + LONG.strip() + f""",
n AS (SELECT CAST(cell AS STRING) AS grid_id, MAX(lat_e2) / 100.0 AS lat, MAX(lon_e2) / 100.0 AS lon, cell, {PIVOT} FROM fx_counts GROUP BY cell),
w AS (SELECT cell, MAX(urban) AS urban, {', '.join(sums)} FROM imputed GROUP BY 1)
SELECT n.grid_id, CAST(n.lat AS DOUBLE) AS lat, CAST(n.lon AS DOUBLE) AS lon, {', '.join(names)}, w.* EXCLUDE (cell) FROM n JOIN w ON w.cell = n.cell"""
    )


@check("wide_exposure", *FX, sql=_wide_sql())
def wide_exposure(i: Inputs) -> DataFrame:
    rows = country.enriched(grid_counts(i), i.fx_props, i.fx_tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    wide = exposure.wide_exposure(rows, exposure.CELL_KEYS, exposure.CELL_POSITION)
    out = []
    for c in wide.columns:
        if "TSI" in c and "perc" not in c.lower():
            out.append(r(c, 0))
        elif c.startswith("storey") or "Storey" in c or "SUM" in c:
            out.append(r(c, 5))
        else:
            out.append(F.col(c))
    return wide.select(*out)


@check(
    "block_check_sums", *FX,
    sql="WITH " + LONG.strip() + """ SELECT lob, ROUND(SUM(buildings), 2) AS buildings, ROUND(SUM(insured), -3) AS insured,
        CAST(COUNT(DISTINCT cell) AS BIGINT) AS cells FROM valued GROUP BY 1""",
)
def block_check_sums(i: Inputs) -> DataFrame:
    rows = country.enriched(grid_counts(i), i.fx_props, i.fx_tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    wide = exposure.wide_exposure(rows, exposure.CELL_KEYS, exposure.CELL_POSITION)
    per_lob = F.array(
        *[
            F.struct(F.lit(lob).alias("lob"), F.col(f"{lob}_Buildings_SUM").alias("b"), F.col(f"{lob}_TSI_SUM").alias("v"))
            for lob in cls.LOBS
        ]
    )
    return wide.select(F.inline(per_lob)).groupBy("lob").agg(
        F.round(F.sum("b"), 2).alias("buildings"), F.round(F.sum("v"), -3).alias("insured"), F.count(F.lit(1)).alias("cells")
    )


@check(
    "area_labels", "fx_counts",
    sql="""SELECT CASE urban WHEN 1 THEN 'URBAN' WHEN 2 THEN 'SUBURBAN' ELSE 'RURAL' END AS area,
           CAST(SUM(cnt) AS BIGINT) AS n FROM fx_counts GROUP BY 1""",
)
def area_labels(i: Inputs) -> DataFrame:
    return counts(i).groupBy(cls.area_of(F.col("urban")).alias("area")).agg(F.sum("count").alias("n"))


@check(
    "lonlat_text_id", "fx_counts",
    sql="""SELECT DISTINCT cell, CONCAT(CAST(CAST(FLOOR(lon_e2 / 100) AS BIGINT) AS STRING), CAST(lon_e2 % 100 AS STRING), '_',
           CAST(CAST(FLOOR(lat_e2 / 100) AS BIGINT) AS STRING), CAST(lat_e2 % 100 AS STRING)) AS lonlat_id FROM fx_counts""",
)
def lonlat_text_id(i: Inputs) -> DataFrame:
    def text(c: str):
        return F.concat(F.floor(F.col(c) / 100).cast("string"), F.lit("."), (F.col(c) % 100).cast("string"))

    rows = i.fx_counts.select("cell", "lon_e2", "lat_e2").distinct()
    return rows.select("cell", exposure.lonlat_id(text("lon_e2"), text("lat_e2")).alias("lonlat_id"))


def _view_sql(lob: str) -> str:
    cols = ", ".join(
        f"ROUND(MAX(CASE WHEN bin = '{b}' THEN value_share END) + 1e-9, 6) AS \"{cls.VIEW_BIN_NAMES[b]}\"" for b in BINS
    )
    return (
        "WITH " + LONG.strip() + f""" SELECT CAST(cell AS STRING) AS "ID", CAST(7000 + (cell % 50) * 25 AS DOUBLE) / 100 AS "POINT_X",
        CAST(800 + FLOOR(cell / 50) * 25 AS DOUBLE) / 100 AS "POINT_Y", CAST(NULL AS BIGINT) AS "ORDER_ID_XY", {cols},
        ROUND(SUM(value_share) + 1e-9, 5) AS "SUM" FROM imputed WHERE lob = '{lob}' GROUP BY cell"""
    )


@check("lob_point_view", *FX, sql=_view_sql("COM"))
def lob_point_view(i: Inputs) -> DataFrame:
    rows = country.enriched(grid_counts(i), i.fx_props, i.fx_tsi, exposure.CELL_KEYS, exposure.CELL_POSITION)
    view = exposure.lob_view(rows, "COM", "grid_id", "lon", "lat")
    bins = list(cls.VIEW_BIN_NAMES.values())
    return view.select(
        "ID", "POINT_X", "POINT_Y", "ORDER_ID_XY", *[F.round(F.col(f"`{b}`") + 1e-9, 6).alias(b) for b in bins], r("SUM", 5)
    )


# Expected counts: the settlement class of a cell's count is its urban group, 0 where unknown.
def smod_counts(i: Inputs) -> DataFrame:
    return i.fx_counts.select("cell", F.coalesce("urban", F.lit(0)).alias("smod"), "built", F.col("cnt").alias("count"))


def smod_props(i: Inputs) -> DataFrame:
    return i.fx_props.filter(F.col("lob") != "IND").select(F.col("urban").alias("smod"), "built", "bin", "prop")


DENSE = """
combos AS (SELECT DISTINCT urban AS smod, built FROM fx_props WHERE lob <> 'IND'),
obs AS (SELECT cell, COALESCE(urban, 0) AS smod, built, CAST(SUM(cnt) AS BIGINT) AS count FROM fx_counts GROUP BY 1, 2, 3),
dense AS (
  SELECT c.cell, k.smod, k.built, COALESCE(o.count, 0) AS count
  FROM (SELECT DISTINCT cell FROM fx_counts) c CROSS JOIN combos k
  LEFT JOIN obs o ON o.cell = c.cell AND o.smod = k.smod AND o.built = k.built)
"""


@check(
    "observed_counts", "fx_counts",
    sql="SELECT cell, COALESCE(urban, 0) AS smod, built, CAST(SUM(cnt) AS BIGINT) AS count FROM fx_counts GROUP BY 1, 2, 3",
)
def observed_counts(i: Inputs) -> DataFrame:
    return expected.observed_counts(smod_counts(i))


@check("dense_combinations", "fx_counts", "fx_props", sql="WITH " + DENSE.strip() + " SELECT cell, smod, built, count FROM dense")
def dense_combinations(i: Inputs) -> DataFrame:
    return expected.dense_counts(smod_counts(i), [0, 1, 2], cls.BUILT_CLASSES)


def dense_rows(i: Inputs) -> DataFrame:
    dense = expected.dense_counts(smod_counts(i), [0, 1, 2], cls.BUILT_CLASSES)
    return expected.expected_rows(dense, smod_props(i), BINS)


Q = ", ".join(f"ROUND(SUM(CASE WHEN p.bin = '{b}' THEN d.count * p.prop ELSE 0 END), 4) AS \"{b}\"" for b in BINS)
QE = Q.replace(' AS "', ' AS "expected_')


@check(
    "matrix_product_expected", "fx_counts", "fx_props",
    sql="WITH " + DENSE.strip() + f""" SELECT d.cell, {Q} FROM dense d
        JOIN fx_props p ON p.lob <> 'IND' AND p.urban = d.smod AND p.built = d.built GROUP BY 1""",
)
def matrix_product_expected(i: Inputs) -> DataFrame:
    out = expected.expected_by_cell(dense_rows(i), BINS)
    return out.select("cell", *[F.round(f"`{b}`", 4).alias(b) for b in BINS])


@check(
    "subtotal_rows", "fx_counts", "fx_props",
    sql="WITH " + DENSE.strip() + f""",
        per_row AS (SELECT d.cell, d.smod, d.built, d.count FROM dense d),
        detail AS (SELECT d.cell, CAST(d.smod AS STRING) AS smod, d.smod AS smod_sort, d.built, MAX(d.count) AS count, {QE}
                   FROM per_row d JOIN fx_props p ON p.lob <> 'IND' AND p.urban = d.smod AND p.built = d.built GROUP BY 1, 2, 3, 4),
        sums AS (SELECT d.cell, 'ALL' AS smod, -1 AS smod_sort, d.built, CAST(SUM(d.count) / 7 AS BIGINT) AS count, {QE}
                 FROM per_row d JOIN fx_props p ON p.lob <> 'IND' AND p.urban = d.smod AND p.built = d.built GROUP BY 1, 4)
        SELECT * FROM detail UNION ALL SELECT * FROM sums""",
)
def subtotal_rows(i: Inputs) -> DataFrame:
    out = expected.with_subtotals(dense_rows(i), BINS)
    return out.select(
        "cell", "smod", "smod_sort", "built", "count", *[F.round(f"expected_{b}", 4).alias(f"expected_{b}") for b in BINS]
    )


@check(
    "ordered_expected_rows", "fx_counts", "fx_props",
    sql="WITH " + DENSE.strip() + """,
        both_levels AS (SELECT cell, CAST(smod AS STRING) AS smod, smod AS smod_sort, built, count FROM dense
                 UNION ALL SELECT cell, 'ALL', -1, built, CAST(SUM(count) AS BIGINT) FROM dense GROUP BY cell, built)
        SELECT cell, smod, built, count FROM both_levels ORDER BY cell, smod_sort, built""",
)
def ordered_expected_rows(i: Inputs) -> DataFrame:
    return expected.ordered(expected.with_subtotals(dense_rows(i), BINS)).select("cell", "smod", "built", "count")


@check("unpivot_counts", "fx_counts", sql="""
    WITH c AS (SELECT DISTINCT cell FROM fx_counts), k AS (SELECT DISTINCT built FROM fx_counts)
    SELECT c.cell, k.built, CAST(COALESCE(SUM(f.cnt), 0) AS BIGINT) AS count FROM c CROSS JOIN k
    LEFT JOIN fx_counts f ON f.cell = c.cell AND f.built = k.built GROUP BY 1, 2""")
def unpivot_counts(i: Inputs) -> DataFrame:
    wide = exposure.pivot_counts(counts(i), ["cell"])
    wide = wide.withColumnsRenamed({c: "nr_" + c[2:4] for c in wide.columns if c.startswith("nr")})
    return expected.melt(wide, ["cell"], "nr_", "built", "count")
