"""Writers: tables, CSV, per-tile folders, views, split bundles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from acreage.contracts import ContractError, drop_untyped
from acreage.sources.tables import read_source


def write_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet", partition: str | None = None) -> None:
    """Overwrite a catalog table together with its schema."""
    writer = drop_untyped(df).write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headed CSV, as many files as the frame has partitions.

    ``single_file`` funnels the rows through one task and is for small reports.
    """
    clean = drop_untyped(df)
    (clean.coalesce(1) if single_file else clean).write.mode("overwrite").option("header", True).csv(path)


def export_csv(spark: SparkSession, source: str, path: str, single_file: bool = False) -> bool:
    """Export a table; False, and nothing written, if it is missing or empty."""
    try:
        df = read_source(spark, source)
    except ContractError:
        return False
    if df.isEmpty():
        return False
    write_csv(df, path, single_file)
    return True


def write_by_tile(df: DataFrame, path: str, tile: str = "tile_id", fmt: str = "parquet") -> None:
    """One folder per tile, which later reads prune by name.

    A rebalance on the tile lets adaptive execution split a tile that holds much
    of the data over several writers and join small ones into one.
    """
    df.hint("rebalance", tile).write.mode("overwrite").partitionBy(tile).format(fmt).save(path)


def create_lob_view(df: DataFrame, base: str, lob: str) -> str:
    """Create or replace a session view '{base}_{lob}', with '_view' added if a table has that name."""
    spark = df.sparkSession
    name = f"{base}_{lob.lower()}"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "TEMPORARY":
        name += "_view"
    drop_untyped(df).createOrReplaceTempView(name)
    return name


def create_catalog_view(spark: SparkSession, view: str, query: str) -> str:
    """Persistent view over catalog tables; a table of the same name makes it '{view}_view'."""
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        view += "_view"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return view


def write_observed(df: DataFrame, path: str, facts: Mapping[str, str], name: str = "run") -> dict:
    """Write Parquet and return run facts (SQL aggregates) counted on the way, without a second pass."""
    watch = Observation(name)
    observed = df.observe(watch, *[F.expr(e).alias(n) for n, e in facts.items()])
    observed.write.mode("overwrite").parquet(path)
    return watch.get


def write_split_bundle(samples: DataFrame, path: str, run: str, split: str = "split") -> str:
    """Samples partitioned by run and split, and a 'latest' pointer to the run. Returns the data path."""
    data = f"{path}/samples"
    out = samples.withColumn("run", F.lit(run)).write.partitionBy("run", split)
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(data)
    pointer = samples.sparkSession.createDataFrame([(run,)], "run string")
    pointer.coalesce(1).write.mode("overwrite").json(f"{path}/latest")
    return data


def read_split_bundle(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Samples of one run, by default the one the pointer names, else the newest run name."""
    samples = spark.read.option("basePath", f"{path}/samples").parquet(f"{path}/samples")
    samples = samples.withColumn("run", F.col("run").cast("string"))
    if run is None:
        pointed = spark.read.schema("run string").json(f"{path}/latest").first()
        run = pointed["run"] if pointed else samples.agg(F.max("run")).first()[0]
    return samples.filter(F.col("run") == run)


def write_reports(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Several result tables of one run as CSV folders named after them."""
    for name, frame in frames.items():
        write_csv(frame, f"{folder}/{name}")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows for a look at the result; the limit is the feature."""
    return df.limit(rows)
