"""Catalog tables or paths by one name, dated snapshots and their retention."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.contracts import ContractError

PREFIXES = ("table:", "delta:")


def is_table_name(source: str) -> bool:
    """True for 'table:x', 'delta:x', dotted names and bare names; False for paths and CSV files."""
    text = source.strip()
    if text.lower().startswith(PREFIXES):
        return True
    if "/" in text:
        return False
    return not text.lower().endswith((".csv", ".parquet", ".json"))


def read_source(spark: SparkSession, source: str, schema: str | None = None) -> DataFrame:
    """A catalog table, or a CSV, JSON or Parquet path by its ending."""
    text = source.strip()
    if is_table_name(text):
        name = text.split(":", 1)[1] if text.lower().startswith(PREFIXES) else text
        if not spark.catalog.tableExists(name):
            raise ContractError(f"table {name} does not exist")
        return spark.read.table(name)
    reader = spark.read.schema(schema) if schema else spark.read
    if text.lower().endswith((".csv", ".csv.gz")):
        return reader.csv(text, header=True, inferSchema=schema is None)
    if text.lower().endswith((".json", ".json.gz")):
        return reader.json(text)
    return reader.parquet(text)


def name_stamp(name: Column, prefix: str) -> Column:
    """Timestamp in names like '{prefix}_YYYYMMDD_HHMMSS.csv'; NULL for other names."""
    stamp = F.regexp_extract(name, rf"(?:^|/){prefix}_(\d{{8}}_\d{{6}})\.csv$", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmmss"))


def latest_snapshot(files: DataFrame, name: str = "name", prefix: str = "class_counts_all") -> DataFrame:
    """One row: the file with the latest timestamp in its name, ties by the larger name."""
    stamped = files.withColumn("stamp", name_stamp(F.col(name), prefix)).filter(F.col("stamp").isNotNull())
    return stamped.agg(F.max_by(name, F.struct("stamp", name)).alias(name), F.max("stamp").alias("stamp"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File names and modification times under a folder, without reading their content."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return found.select(F.col("path").alias("name"), "modificationTime", "length")


def read_latest(spark: SparkSession, folder: str, prefix: str = "class_counts_all", schema: str | None = None) -> DataFrame:
    """The newest dated CSV of a folder; an error if none has the pattern."""
    newest = latest_snapshot(list_files(spark, folder, f"{prefix}_*.csv"), "name", prefix).first()
    if newest is None or newest["name"] is None:
        raise ContractError(f"no {prefix}_YYYYMMDD_HHMMSS.csv in {folder}")
    return read_source(spark, newest["name"], schema)


def outdated(names: DataFrame, prefixes: Iterable[str], today: str, name: str = "name") -> DataFrame:
    """Dated outputs that are not today's: '{prefix}YYMMDD' with an optional line-of-business ending.

    Covers the table names and the view names that are written,
    '{prefix}YYMMDD' and '{prefix}YYMMDD_{lob}'.
    """
    lowered = F.lower(F.col(name))
    stamp = F.lit("")
    for p in prefixes:
        found = F.regexp_extract(lowered, rf"^{p.lower()}([0-9]{{6}})(?:_[a-z]{{3}})?$", 1)
        stamp = F.when(found != "", found).otherwise(stamp)
    dated = names.withColumn("stamp", stamp)
    return dated.filter((F.col("stamp") != "") & (F.col("stamp") != today))


def drop_outdated(spark: SparkSession, database: str, prefixes: Iterable[str], today: str) -> list[str]:
    """Drop outdated tables and views of a database; returns their names, a short list from the catalog."""
    tables = spark.sql(f"SHOW TABLES IN {database}").select(F.col("tableName").alias("name"))
    dropped = [r["name"] for r in outdated(tables, prefixes, today).collect()]
    for name in dropped:
        kind = spark.catalog.getTable(f"{database}.{name}").tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {database}.`{name}`")
    return dropped
