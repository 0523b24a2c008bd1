"""Class codes of the built-up and settlement rasters, and what they mean."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raster codes, storey bins and labels that outputs are keyed by.
NODATA = 255
RESIDENTIAL = [11, 12, 13, 14, 15]
NON_RESIDENTIAL = [21, 22, 23, 24, 25]
BUILT_CLASSES = RESIDENTIAL + NON_RESIDENTIAL
SETTLEMENT_CLASSES = [0, 10, 11, 12, 13, 21, 22, 23, 30]
LOBS = ["RES", "COM", "IND"]
LOB_CLASSES = {"RES": RESIDENTIAL, "COM": NON_RESIDENTIAL, "IND": NON_RESIDENTIAL}
BINS = ["1", "2", "3", "4_5", "6_8", "9_20", "20"]
AREAS = ["OVERALL", "URBAN", "RURAL", "SUBURBAN"]
AREA_BY_GROUP = {0: "RURAL", 1: "URBAN", 2: "SUBURBAN"}
VIEW_BIN_NAMES = {"1": "1", "2": "2", "3": "3", "4_5": "5", "6_8": "7", "9_20": "10", "20": "40"}
BUILT_LABELS = {
    0: "Non-built",
    11: "Residential ≤3m",
    12: "Residential 3-6m",
    13: "Residential 6-15m",
    14: "Residential 15-30m",
    15: "Residential >30m",
    21: "Non-residential ≤3m",
    22: "Non-residential 3-6m",
    23: "Non-residential 6-15m",
    24: "Non-residential 15-30m",
    25: "Non-residential >30m",
    255: "NoData",
}
SETTLEMENT_LABELS = {
    0: "Non-built",
    10: "Water",
    11: "Very Low Density Rural",
    12: "Low Density Rural",
    13: "Rural Cluster",
    21: "Suburban",
    22: "Semi-Dense Urban",
    23: "Dense Urban",
    30: "Urban Centre",
    255: "NoData",
}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])


def lob_of(code: Column) -> Column:
    """RES for residential heights, COM for non-residential, else UNKNOWN."""
    return F.when(code.between(11, 15), "RES").when(code.between(21, 25), "COM").otherwise("UNKNOWN")


def settlement_group(code: Column) -> Column:
    """0 rural, 1 suburban and semi-dense, 2 dense and centre; NULL for other codes."""
    return (
        F.when(code.isin(30, 23), 2)
        .when(code.isin(22, 21), 1)
        .when(code.isin(13, 12, 11, 10, 0), 0)
        .cast("int")
    )


def label_of(code: Column, labels: dict[int, str], default: str = "Other") -> Column:
    return F.coalesce(F.try_element_at(literal_map(labels), code.cast("int")), F.lit(default))


def area_of(group: Column, labels: dict[int, str] | None = None, default: str = "RURAL") -> Column:
    return F.coalesce(F.try_element_at(literal_map(labels or AREA_BY_GROUP), group.cast("int")), F.lit(default))


def areas_of(labels: dict[int, str] | None = None, default: str = "RURAL") -> list[str]:
    """All areas that ``area_of`` can give, after the overall one."""
    return AREAS if labels is None else list(dict.fromkeys([AREAS[0], *labels.values(), default]))


def column_safe(label: Column) -> Column:
    """Turn a label into a column-name fragment: blanks to '_', comparison signs to words."""
    spaced = F.replace(label, F.lit(" "), F.lit("_"))
    worded = F.replace(F.replace(spaced, F.lit("<"), F.lit("lt")), F.lit(">"), F.lit("gt"))
    return F.translate(F.replace(worded, F.lit("="), F.lit("eq")), ",()", "")


def column_safe_name(label: str) -> str:
    for old, new in ((" ", "_"), ("<", "lt"), (">", "gt"), ("=", "eq"), (",", ""), ("(", ""), (")", "")):
        label = label.replace(old, new)
    return label
