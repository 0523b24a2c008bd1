"""Cleaning of storey-proportion files: scales, row sums, contracts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.contracts import ContractError, require_columns
from acreage.functions.classes import BINS
from acreage.functions.numbers import parse_number
from acreage.operators.ranking import exact_quantiles

# Accepted spellings of the storey bins.
BIN_SPELLINGS = {
    "1": ["1", "01"],
    "2": ["2", "02"],
    "3": ["3", "03"],
    "4_5": ["4-5", "4_5"],
    "6_8": ["6-8", "6_8", "6-9", "6_9"],
    "9_20": ["9-20", "9_20", "10-20", "10_20"],
    "20": ["20", "20+", ">20"],
}


def canonical_bin(header: str) -> str | None:
    """Storey bin a column header stands for, or None."""
    name = header.strip().replace(" ", "")
    for bin_name, spellings in BIN_SPELLINGS.items():
        if name in spellings:
            return bin_name
    span = re.fullmatch(r"\d+[-_](\d+)", name)
    if not span:
        return None
    upper = int(span.group(1))
    if upper == 5:
        return "4_5"
    if upper in (8, 9):
        return "6_8"
    return "9_20" if upper >= 10 else None


def rename_bins(df: DataFrame) -> DataFrame:
    """Rename recognised bin headers; two headers for the same bin are a contract error."""
    names = {c: canonical_bin(c) for c in df.columns if canonical_bin(c)}
    if not names:
        raise ContractError(f"no storey-bin column among {df.columns}")
    if len(set(names.values())) < len(names):
        raise ContractError(f"several columns stand for the same storey bin: {names}")
    return df.withColumnsRenamed(names)


def normalise_metadata(df: DataFrame, iso3: str) -> DataFrame:
    """Drop a trailing sum column, settle key names, add the country and any missing bin."""
    df = df.withColumnsRenamed({c: c.strip() for c in df.columns})
    if df.columns[-1].upper() in ("SUM", "TOTAL"):
        df = df.drop(df.columns[-1])
    if "storey" not in df.columns and "built" in df.columns:
        df = df.withColumnRenamed("built", "storey")
    if "lob" in df.columns and "LOB" not in df.columns:
        df = df.withColumnRenamed("lob", "LOB")
    require_columns(df, ["LOB", "urban", "storey"], "proportions")
    df = rename_bins(df)
    if "ISO3" not in df.columns:
        df = df.withColumn("ISO3", F.lit(iso3.upper()))
    missing = {b: F.lit("0") for b in BINS if b not in df.columns}
    return df.withColumns(missing).select("ISO3", "LOB", "urban", "storey", *BINS)


def parse_bins(df: DataFrame, bins: Sequence[str]) -> DataFrame:
    return df.withColumns({b: parse_number(F.col(f"`{b}`")) for b in bins})


def scale_rule(median: Column, high: Column, low: Column) -> Column:
    """'percentage' or 'decimal' from a column's median, maximum and minimum; empty counts as decimal."""
    rule = (
        F.when((median > 1.5) | (high > 10), "percentage")
        .when((high <= 1.1) & (low >= 0), "decimal")
        .when(median > 1.0, "percentage")
        .otherwise("decimal")
    )
    return F.when(median.isNull(), "decimal").otherwise(rule)


def column_scales(df: DataFrame, bins: Sequence[str]) -> DataFrame:
    """Long (bin, median, low, high, scale) of the parsed bin columns.

    The columns are turned to (bin, value) rows and go through the exact
    quantiles, which hold for a file of any length.
    """
    rows = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"`{b}`").alias("value")) for b in bins])
    profile = exact_quantiles(
        df.select(F.inline(rows)), "value", {"low": 0.0, "median": 0.5, "high": 1.0}, ["bin"]
    )
    # Bins without any number have no profile and count as decimal.
    listed = df.sparkSession.createDataFrame([(b,) for b in bins], "bin string")
    long = listed.join(profile, "bin", "left").select("bin", "median", "low", "high")
    return long.withColumn("scale", scale_rule(F.col("median"), F.col("high"), F.col("low")))


def bin_scales(df: DataFrame, bins: Sequence[str]) -> DataFrame:
    """(bin, scale) by the rule of ``column_scales``, decided in one aggregation without sorting anything.

    The rule only asks whether a median exceeds a bound: the count of values up
    to the bound tells, and where the two middle values lie on either side of it,
    the largest value up to the bound and the smallest one above are the two.
    """
    measures, decided = [], []
    for i, b in enumerate(bins):
        v = F.col(f"`{b}`")
        measures += [F.count(v).alias(f"_n{i}"), F.min(v).alias(f"_low{i}"), F.max(v).alias(f"_high{i}")]
        above = {}
        for t, bound in (("a", 1.5), ("b", 1.0)):
            measures += [
                F.count_if(v <= bound).alias(f"_c{t}{i}"), F.max(F.when(v <= bound, v)).alias(f"_l{t}{i}"),
                F.min(F.when(v > bound, v)).alias(f"_u{t}{i}"),
            ]
            half = 2 * F.col(f"_c{t}{i}")
            middle = (F.col(f"_l{t}{i}") + F.col(f"_u{t}{i}")) / 2.0 > bound
            above[t] = F.when(half == F.col(f"_n{i}"), middle).otherwise(half < F.col(f"_n{i}"))
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        scale = (
            F.when(F.col(f"_n{i}") == 0, "decimal")
            .when(above["a"] | (high > 10), "percentage")
            .when((high <= 1.1) & (low >= 0), "decimal")
            .when(above["b"], "percentage")
            .otherwise("decimal")
        )
        decided.append(F.struct(F.lit(b).alias("bin"), scale.alias("scale")))
    return df.agg(*measures).select(F.inline(F.array(*decided)))


def file_scale(scales: DataFrame) -> DataFrame:
    """Majority vote of the column scales; a tie counts as decimal."""
    return scales.agg(
        F.when(F.count_if(F.col("scale") == "percentage") * 2 > F.count(F.lit(1)), "percentage")
        .otherwise("decimal")
        .alias("scale")
    )


def row_total(bins: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for b in bins:
        total = total + F.coalesce(F.col(f"`{b}`"), F.lit(0.0))
    return total


def row_scale(bins: Sequence[str]) -> Column:
    """Scale of one row from its sum, else from its median; a row without any number is 'unknown'."""
    values = F.array_sort(F.array_compact(F.array(*[F.col(f"`{b}`") for b in bins])))
    n = F.size(values)
    middle = (
        F.try_element_at(values, F.floor((n + 1) / 2).cast("int"))
        + F.try_element_at(values, F.floor((n + 2) / 2).cast("int"))
    ) / 2.0
    total = row_total(bins)
    return (
        F.when(n == 0, "unknown")
        .when(total.between(0.8, 1.2), "decimal")
        .when(total.between(80, 120), "percentage")
        .when(middle > 1.0, "percentage")
        .otherwise("decimal")
    )


def to_decimal(df: DataFrame, bins: Sequence[str], scales: DataFrame, per_column: bool = False) -> DataFrame:
    """Divide percentages by 100 and turn NULL into 0, by file-level vote or column by column."""
    if per_column:
        def scale_of(b: str) -> Column:
            return scales.filter(F.col("bin") == b).select("scale").scalar()
    else:
        vote = file_scale(scales)

        def scale_of(b: str) -> Column:
            return vote.select("scale").scalar()

    def decimal(b: str) -> Column:
        value = F.coalesce(F.col(f"`{b}`"), F.lit(0.0))
        return F.when(scale_of(b) == "percentage", value / 100.0).otherwise(value)

    return df.withColumns({b: decimal(b) for b in bins})


def enforce_types(df: DataFrame) -> DataFrame:
    """storey as a nullable integer, urban as an integer with 0 for anything unreadable."""
    return df.withColumns(
        {
            "storey": parse_number(F.col("storey").cast("string")).cast("int"),
            "urban": F.coalesce(parse_number(F.col("urban").cast("string")).cast("int"), F.lit(0)),
        }
    )


def bad_sums(df: DataFrame, bins: Sequence[str], tolerance: float = 0.02) -> DataFrame:
    """Rows whose proportions do not add up to 1 within the tolerance, with their sum."""
    return df.withColumn("row_sum", row_total(bins)).filter(F.abs(F.col("row_sum") - 1.0) > tolerance)


def sum_profile(df: DataFrame, bins: Sequence[str], tolerance: float = 0.02) -> DataFrame:
    """Minimum, maximum, mean and median of the row sums and the number outside the tolerance."""
    sums = df.select(row_total(bins).alias("s"))
    middle = exact_quantiles(sums, "s", {"m": 0.5}).select("m").scalar()
    profile = sums.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(F.col("s") - 1.0) > tolerance).alias("n_bad"),
        F.min("s").alias("min_sum"),
        F.max("s").alias("max_sum"),
        F.avg("s").alias("mean_sum"),
    )
    return profile.withColumn("median_sum", middle)


def renormalise(df: DataFrame, bins: Sequence[str], tolerance: float = 0.02, floor: float = 0.001) -> DataFrame:
    """Rescale bad rows to add up to 1; rows that sum to nearly nothing stay as they are."""
    total = row_total(bins)
    fix = (F.abs(total - 1.0) > tolerance) & (total > floor)
    with_sum = df.withColumn("_sum", F.when(fix, total).otherwise(F.lit(1.0)))
    return with_sum.withColumns({b: F.col(f"`{b}`") / F.col("_sum") for b in bins}).drop("_sum")


def clean_proportions(
    raw: DataFrame, iso3: str, tolerance: float = 0.02, fix_rows: bool = False, per_column: bool = False
) -> DataFrame:
    """All steps from a file of text columns to (ISO3, LOB, urban, storey, bins as doubles).

    Only bins the file has take part in the scale detection; added ones are 0 in either scale.
    """
    parsed = parse_bins(normalise_metadata(raw, iso3), BINS)
    present = [b for b in BINS if b in {canonical_bin(c) for c in raw.columns}]
    decimal = to_decimal(parsed, present, column_scales(parsed, present), per_column)
    typed = enforce_types(decimal)
    return renormalise(typed, BINS, tolerance) if fix_rows else typed


def to_long(clean: DataFrame) -> DataFrame:
    """(lob, urban, built, bin, prop) from cleaned wide proportions."""
    pairs = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"`{b}`").alias("prop")) for b in BINS])
    return clean.select(
        F.col("LOB").alias("lob"), "urban", F.col("storey").alias("built"), F.inline(pairs)
    )


def values_to_long(tsi: DataFrame) -> DataFrame:
    """(lob, bin, tsi) from the wide insured-value file."""
    named = rename_bins(tsi)
    pairs = F.array(
        *[F.struct(F.lit(b).alias("bin"), F.col(f"`{b}`").cast("double").alias("tsi")) for b in BINS]
    )
    return named.select(F.col("LOB").alias("lob"), F.inline(pairs))


def row_sum_audit(clean: DataFrame) -> DataFrame:
    """One audit row per proportion row: its keys and its sum."""
    return clean.select("ISO3", "LOB", "urban", "storey", row_total(BINS).alias("row_sum"))
