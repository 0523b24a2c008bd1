"""All registered queries, as callables of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import (  # noqa: F401  (importing a module registers its queries)
    change_checks,
    chip_checks,
    exposure_checks,
    grid_checks,
    metric_checks,
    multiplier_checks,
    source_checks,
    split_checks,
    zonal_checks,
)
from checks.base import ORACLES, QUERIES, Inputs, Query


def _bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(Inputs(spark, folder))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for name, query in QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
