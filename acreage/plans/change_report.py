"""Forest change between two epochs by two masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.operators import change


def index_losses(pixels: DataFrame, patch: Sequence[str], threshold: float = change.NDVI_FOREST) -> DataFrame:
    """Loss per patch from the vegetation index; masks are computed inside the aggregation's scan."""
    masked = pixels.select(*patch, "epoch", change.forest_mask(F.col("nir"), F.col("red"), threshold).alias("mask"))
    return change.forest_loss(masked, patch)


def probability_losses(pixels: DataFrame, patch: Sequence[str], column: str = "probability") -> DataFrame:
    """Loss per patch from a forest-probability column of an external model."""
    masked = pixels.select(
        *patch, "epoch", change.threshold_mask(F.col(column), change.PROBABILITY_FOREST).alias("mask")
    )
    return change.forest_loss(masked, patch)


def change_report(pixels: DataFrame, patch: Sequence[str], column: str = "probability") -> DataFrame:
    """Summary rows of both methods and of their disagreement, from one aggregation of the pixels.

    The patches' losses, a row for each, feed all three rows.
    """
    index = change.forest_mask(F.col("nir"), F.col("red"), change.NDVI_FOREST)
    model = change.threshold_mask(F.col(column), change.PROBABILITY_FOREST)
    losses = change.forest_losses(pixels.select(*patch, "epoch", index.alias("index"), model.alias("model")), patch, ["index", "model"])
    gap = F.abs(F.col("index_loss_pct") - F.col("model_loss_pct"))
    sums = losses.agg(
        *[
            x
            for m in ("index", "model")
            for x in (
                F.sum(f"{m}_loss_m2").cast("bigint").alias(f"{m}_total"), F.avg(f"{m}_loss_pct").alias(f"{m}_mean"),
                F.max(f"{m}_loss_pct").alias(f"{m}_max"), F.count_if(F.col(f"{m}_loss_pct") > 10.0).alias(f"{m}_above"),
            )
        ],
        F.avg(gap).alias("gap_mean"), F.max(gap).alias("gap_max"), F.count_if(gap > 20.0).alias("gap_above"),
    )

    def row(name: str, method: str, total: Column) -> Column:
        return F.struct(
            total.alias("total_m2"), F.col(f"{name}_mean").alias("mean_pct"), F.col(f"{name}_max").alias("max_pct"),
            F.col(f"{name}_above").alias("patches_above"), F.lit(method).alias("method"),
        )

    return sums.select(F.inline(F.array(
        row("index", "index", F.col("index_total")), row("model", "model", F.col("model_total")),
        row("gap", "difference", F.lit(None).cast("bigint")),
    )))
