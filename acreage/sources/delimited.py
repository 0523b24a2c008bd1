"""Delimited text: multiplier files with unknown separator, and typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.contracts import ContractError

SAMPLE_CHARS = 4096


def pick_separator(sample: str) -> str:
    """';' or tab if strictly more frequent than the other candidates, else ','."""
    comma, semicolon, tab = (sample.count(c) for c in (",", ";", "\t"))
    if semicolon > max(comma, tab):
        return ";"
    return "\t" if tab > max(comma, semicolon) else ","


def sniff(spark: SparkSession, path: str) -> tuple[str, str]:
    """Separator from the head of the file, encoding from all of it: text that is not UTF-8 anywhere counts as latin-1."""
    text = spark.read.text(path)
    lines = [r[0] for r in text.limit(64).collect()]
    head = "\n".join(lines)[:SAMPLE_CHARS]
    if not head:
        raise ContractError(f"{path} is empty")
    broken = not text.filter(~F.is_valid_utf8("value")).isEmpty()
    return pick_separator(head), "ISO-8859-1" if broken else "UTF-8"


def read_multipliers(spark: SparkSession, path: str) -> DataFrame:
    """Multiplier file as text columns; numbers are parsed later, when their notation is known."""
    separator, encoding = sniff(spark, path)
    return spark.read.csv(path, header=True, sep=separator, encoding=encoding, inferSchema=False)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV; give a schema at scale, since inferring types reads the file twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
