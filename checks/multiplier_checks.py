"""Multiplier cleaning on text columns derived from the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.numbers import parse_number
from acreage.operators import metrics, multipliers
from checks.base import Inputs, check

P = ["p1", "p2"]


def parsed(i: Inputs) -> DataFrame:
    return multipliers.parse_bins(i.fx_raw_props, P)


def num(c: str) -> str:
    """The number notation rules as SQL."""
    t = f"REPLACE(REPLACE(REPLACE(TRIM({c}), ' ', ''), '%', ''), ',', '.')"
    return f"(TRY_CAST({t} AS DOUBLE) / CASE WHEN {c} LIKE '%\\%%' ESCAPE '\\' THEN 100.0 ELSE 1.0 END)"


PARSED = f"parsed AS (SELECT rid, grp, {num('p1')} AS p1, {num('p2')} AS p2 FROM fx_raw_props)"
FILE = """
stats AS (SELECT 'p1' AS bin, MEDIAN(p1) AS median, MIN(p1) AS low, MAX(p1) AS high FROM parsed
          UNION ALL SELECT 'p2', MEDIAN(p2), MIN(p2), MAX(p2) FROM parsed),
scales AS (SELECT *, CASE WHEN median IS NULL THEN 'decimal' WHEN median > 1.5 OR high > 10 THEN 'percentage'
                          WHEN high <= 1.1 AND low >= 0 THEN 'decimal' WHEN median > 1 THEN 'percentage' ELSE 'decimal' END AS scale FROM stats),
vote AS (SELECT CASE WHEN SUM(CASE WHEN scale = 'percentage' THEN 1 ELSE 0 END) * 2 > COUNT(*) THEN 'percentage' ELSE 'decimal' END AS scale FROM scales)
"""


@check("parse_numbers", "fx_raw_props", sql=f"WITH {PARSED} SELECT rid, ROUND(p1, 6) AS p1, ROUND(p2, 6) AS p2 FROM parsed")
def parse_numbers(i: Inputs) -> DataFrame:
    return i.fx_raw_props.select("rid", *[F.round(parse_number(F.col(c)), 6).alias(c) for c in P])


@check("column_scales", "fx_raw_props", sql=f"WITH {PARSED}, {FILE.strip()} SELECT bin, ROUND(median, 6) AS median, ROUND(low, 6) AS low, ROUND(high, 6) AS high, scale FROM scales")
def column_scales(i: Inputs) -> DataFrame:
    out = multipliers.column_scales(parsed(i), P)
    return out.select("bin", *[F.round(c, 6).alias(c) for c in ("median", "low", "high")], "scale")


@check("bin_scales", "fx_raw_props", sql=f"WITH {PARSED}, {FILE.strip()} SELECT bin, scale FROM scales")
def bin_scales(i: Inputs) -> DataFrame:
    return multipliers.bin_scales(parsed(i), P)


@check("file_scale_vote", "fx_raw_props", sql=f"WITH {PARSED}, {FILE.strip()} SELECT scale FROM vote")
def file_scale_vote(i: Inputs) -> DataFrame:
    return multipliers.file_scale(multipliers.bin_scales(parsed(i), P))


ROWSUM = "(COALESCE(p1, 0) + COALESCE(p2, 0))"


@check("row_scales", "fx_raw_props", sql=f"""WITH {PARSED} SELECT rid, CASE WHEN p1 IS NULL AND p2 IS NULL THEN 'unknown'
    WHEN {ROWSUM} BETWEEN 0.8 AND 1.2 THEN 'decimal' WHEN {ROWSUM} BETWEEN 80 AND 120 THEN 'percentage'
    WHEN (COALESCE(p1, p2) + COALESCE(p2, p1)) / 2 > 1 THEN 'percentage' ELSE 'decimal' END AS scale FROM parsed""")
def row_scales(i: Inputs) -> DataFrame:
    return parsed(i).select("rid", multipliers.row_scale(P).alias("scale"))


CONVERTED = """converted AS (SELECT rid, grp, COALESCE(p1, 0) / CASE WHEN v.scale = 'percentage' THEN 100 ELSE 1 END AS p1,
    COALESCE(p2, 0) / CASE WHEN v.scale = 'percentage' THEN 100 ELSE 1 END AS p2 FROM parsed, vote v)"""


def converted(i: Inputs) -> DataFrame:
    rows = parsed(i)
    return multipliers.to_decimal(rows, P, multipliers.bin_scales(rows, P))


@check("scale_conversion", "fx_raw_props", sql=f"WITH {PARSED}, {FILE.strip()}, {CONVERTED} SELECT rid, ROUND(p1, 6) AS p1, ROUND(p2, 6) AS p2 FROM converted")
def scale_conversion(i: Inputs) -> DataFrame:
    return converted(i).select("rid", *[F.round(c, 6).alias(c) for c in P])


@check("bad_row_sums", "fx_raw_props", sql=f"WITH {PARSED} SELECT rid, ROUND({ROWSUM}, 6) AS row_sum FROM parsed WHERE ABS({ROWSUM} - 1) > 0.0205")
def bad_row_sums(i: Inputs) -> DataFrame:
    return multipliers.bad_sums(parsed(i), P, 0.0205).select("rid", F.round("row_sum", 6).alias("row_sum"))


@check("row_sum_profile", "fx_raw_props", sql=f"""WITH {PARSED} SELECT COUNT(*) AS n_rows,
    CAST(SUM(CASE WHEN ABS({ROWSUM} - 1) > 0.0205 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad, ROUND(MIN({ROWSUM}), 6) AS min_sum,
    ROUND(MAX({ROWSUM}), 6) AS max_sum, ROUND(AVG({ROWSUM}), 6) AS mean_sum, ROUND(MEDIAN({ROWSUM}), 6) AS median_sum FROM parsed""")
def row_sum_profile(i: Inputs) -> DataFrame:
    out = multipliers.sum_profile(parsed(i), P, 0.0205)
    return out.select("n_rows", "n_bad", *[F.round(c, 6).alias(c) for c in ("min_sum", "max_sum", "mean_sum", "median_sum")])


@check("renormalised_rows", "fx_raw_props", sql=f"""WITH {PARSED}, s AS (SELECT *, CASE WHEN ABS({ROWSUM} - 1) > 0.0205 AND {ROWSUM} > 0.001 THEN {ROWSUM} ELSE 1 END AS f FROM parsed)
    SELECT rid, ROUND(p1 / f, 6) AS p1, ROUND(p2 / f, 6) AS p2 FROM s""")
def renormalised_rows(i: Inputs) -> DataFrame:
    return multipliers.renormalise(parsed(i), P, 0.0205).select("rid", *[F.round(c, 6).alias(c) for c in P])


@check("metadata_normalisation", sql="""SELECT 'XYZ' AS iso3, l_returnflag AS lob, l_linenumber AS urban, CAST(l_suppkey AS INT) AS storey,
    CAST(l_quantity AS BIGINT) AS one, CAST(0 AS BIGINT) AS last_bin, COUNT(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6""")
def metadata_normalisation(i: Inputs) -> DataFrame:
    raw = i.table("lineitem").select(
        F.col("l_returnflag").alias("lob"),
        F.col("l_linenumber").cast("string").alias("urban"),
        F.col("l_suppkey").cast("string").alias("built"),
        F.col("l_quantity").cast("bigint").cast("string").alias("01"),
        F.lit("7").alias("4-5"),
        F.lit("1").alias("TOTAL"),
    )
    clean = multipliers.enforce_types(multipliers.normalise_metadata(raw, "xyz"))
    return clean.groupBy(
        F.col("ISO3").alias("iso3"), F.col("LOB").alias("lob"), "urban", "storey",
        F.col("1").cast("bigint").alias("one"), F.col("20").cast("bigint").alias("last_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("type_enforcement", "fx_raw_props", sql=f"""SELECT rid, CAST(TRUNC({num('p1')}) AS INT) AS storey, COALESCE(CAST(TRUNC({num('p2')}) AS INT), 0) AS urban FROM fx_raw_props""")
def type_enforcement(i: Inputs) -> DataFrame:
    rows = i.fx_raw_props.select("rid", F.col("p1").alias("storey"), F.col("p2").alias("urban"))
    return multipliers.enforce_types(rows)


@check("row_sum_audit", sql="""SELECT l_returnflag AS lob, CAST(l_suppkey AS INT) AS storey,
    ROUND(SUM(CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) / 100 + l_linenumber / 100.0), 4) AS total, COUNT(*) AS n FROM lineitem GROUP BY 1, 2""")
def row_sum_audit(i: Inputs) -> DataFrame:
    raw = i.table("lineitem").select(
        F.col("l_returnflag").alias("LOB"),
        F.lit("1").alias("urban"),
        F.col("l_suppkey").cast("string").alias("built"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("%")).alias("1"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" %")).alias("9-20"),
    )
    clean = multipliers.clean_proportions(raw, "xyz")
    audit = multipliers.row_sum_audit(clean)
    return audit.groupBy(F.col("LOB").alias("lob"), "storey").agg(
        F.round(F.sum("row_sum"), 4).alias("total"), F.count(F.lit(1)).alias("n")
    )


@check("majority_value", sql="SELECT l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_linenumber LIMIT 1")
def majority_value(i: Inputs) -> DataFrame:
    return metrics.majority(i.table("lineitem"), "l_linenumber")


@check("value_counts", "fx_tile_files", sql="SELECT dataset, COUNT(*) AS n FROM fx_tile_files GROUP BY 1")
def value_counts(i: Inputs) -> DataFrame:
    return metrics.value_counts(i.fx_tile_files, "dataset")


@check("wide_props_to_long", sql="""SELECT l_returnflag AS lob, 1 AS urban, CAST(l_suppkey AS INT) AS built, t.bin,
    ROUND(SUM(CASE t.bin WHEN '1' THEN l_quantity / 100 WHEN '9_20' THEN l_linenumber / 100.0 ELSE 0 END), 4) AS prop
    FROM lineitem CROSS JOIN (VALUES ('1'), ('2'), ('3'), ('4_5'), ('6_8'), ('9_20'), ('20')) AS t(bin) GROUP BY 1, 2, 3, 4""")
def wide_props_to_long(i: Inputs) -> DataFrame:
    raw = i.table("lineitem").select(
        F.col("l_returnflag").alias("LOB"),
        F.lit("1").alias("urban"),
        F.col("l_suppkey").cast("string").alias("built"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("%")).alias("1"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" %")).alias("10-20"),
    )
    long = multipliers.to_long(multipliers.clean_proportions(raw, "xyz"))
    return long.groupBy("lob", "urban", "built", "bin").agg(F.round(F.sum("prop"), 4).alias("prop"))
