"""Joins on group keys in which NULL is a group like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the left side's keys stay. Without keys every pair of rows meets,
    for which the right side must be a single row."""
    renamed = right.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & left[k].eqNullSafe(renamed[f"_key_{i}"])
    return left.join(renamed, match, how).drop(*[f"_key_{i}" for i in range(len(keys))])
