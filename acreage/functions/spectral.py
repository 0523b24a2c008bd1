"""Vegetation, water and radar indices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from acreage.functions.numbers import clip, nan_to_zero, safe_divide

EPSILON = 1e-8


def normalized_difference(a: Column, b: Column, epsilon: float = EPSILON) -> Column:
    return F.try_divide(a - b, a + b + F.lit(epsilon))


def ndvi(nir: Column, red: Column) -> Column:
    return normalized_difference(nir, red)


def ndvi_clipped(nir: Column, red: Column) -> Column:
    """NDVI in [-1, 1]; a zero denominator counts as 1e-10."""
    total = nir + red
    return clip((nir - red) / F.when(total == 0, F.lit(1e-10)).otherwise(total), -1.0, 1.0)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return F.try_divide(2.5 * (nir - red), nir + 6.0 * red - 7.5 * blue + 1.0 + F.lit(EPSILON))


def savi(nir: Column, red: Column) -> Column:
    return F.try_divide(nir - red, nir + red + 0.5 + F.lit(EPSILON)) * 1.5


def gndvi(nir: Column, green: Column) -> Column:
    return normalized_difference(nir, green)


def ndwi(green: Column, nir: Column) -> Column:
    return normalized_difference(green, nir)


def cross_pol_ratio(vh: Column, vv: Column) -> Column:
    return safe_divide(vh, vv)


def derived_indices(blue: Column, green: Column, red: Column, nir: Column) -> dict[str, Column]:
    """The five per-pixel indices appended to a chip's bands, undefined values as zero."""
    raw = {
        "ndvi": ndvi(nir, red),
        "evi": evi(nir, red, blue),
        "savi": savi(nir, red),
        "gndvi": gndvi(nir, green),
        "ndwi": ndwi(green, nir),
    }
    return {name: nan_to_zero(value) for name, value in raw.items()}


def season_indices(
    optical: Mapping[str, Mapping[str, Column]], radar: Mapping[str, Mapping[str, Column]] | None = None
) -> dict[str, Column]:
    """Index columns per season from a layout {season: {band: column}}; absent bands are skipped."""
    out: dict[str, Column] = {}
    for season, bands in optical.items():
        nir = bands.get("nir")
        for name, other in (("NDVI", bands.get("red")), ("GNDVI", bands.get("green"))):
            if nir is not None and other is not None:
                out[f"{name}_S2_{season}"] = safe_divide(nir - other, nir + other)
    for season, bands in (radar or {}).items():
        if "vv" in bands and "vh" in bands:
            out[f"CPR_S1_{season}"] = cross_pol_ratio(bands["vh"], bands["vv"])
    return out
