"""From chip pixels to samples, folds and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.operators import chips, metrics


def usable_chips(pixels: DataFrame, bands: DataFrame, chip: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    """(targets of usable chips, imputed band pixels of those chips)."""
    targets = chips.chip_targets(pixels, chip, target).filter(F.col("usable") == 1)
    kept = bands.join(targets.select(*chip), list(chip), "left_semi")
    imputed = chips.impute_bands(kept, chip)
    present = imputed.select(*chip).distinct()
    return targets.join(present, list(chip), "left_semi"), imputed


def cross_validation_report(preds: DataFrame, fold: str = "fold") -> DataFrame:
    """Metrics with rank correlation per fold, summarised as mean and deviation over the folds."""
    by_fold = metrics.with_spearman(metrics.regression_metrics(preds, [fold]), preds, [fold])
    return metrics.fold_summary(by_fold, ["rmse", "r2", "mae", "spearman"])
