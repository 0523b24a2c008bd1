"""Spherical Mollweide projection in plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6378137.0


def mollweide_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Closed-form inverse; points off the globe give NULL."""
    s = y / F.lit(RADIUS_M * math.sqrt(2.0))
    theta = F.when(F.abs(s) <= 1.0, F.asin(s))
    lat = F.degrees(F.asin((2.0 * theta + F.sin(2.0 * theta)) / math.pi))
    width = F.lit(2.0 * math.sqrt(2.0) * RADIUS_M) * F.cos(theta)
    lon = F.degrees(F.try_divide(F.lit(math.pi) * x, width))
    return F.when(F.abs(lon) <= 180.0, lon), F.when(F.abs(lon) <= 180.0, lat)


def lonlat_to_mollweide(lon: Column, lat: Column, steps: int = 12) -> tuple[Column, Column]:
    """Newton solution of 2t + sin 2t = pi sin(lat); the poles are set directly."""
    phi = F.radians(lat)
    target = F.lit(math.pi) * F.sin(phi)
    solved = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        phi,
        lambda t, _: t - F.try_divide(2.0 * t + F.sin(2.0 * t) - target, 2.0 + 2.0 * F.cos(2.0 * t)),
    )
    theta = F.when(F.abs(lat) >= 90.0, F.signum(lat) * (math.pi / 2.0)).otherwise(solved)
    x = F.lit(2.0 * math.sqrt(2.0) / math.pi * RADIUS_M) * F.radians(lon) * F.cos(theta)
    y = F.lit(math.sqrt(2.0) * RADIUS_M) * F.sin(theta)
    return x, y
