"""Small helpers of the operators in this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreage.session import cut_lineage

__all__ = ["cut_lineage", "small_batches", "table"]

#: Session setting, its default, and what it is lowered to: bytes of rows that a Python worker gets at once.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16m"


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs`` as they are; the session's Arrow batches are kept small unless it has a setting of its own.

    Texts differ much in length, and a task's memory follows its batches.
    """
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return docs


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
