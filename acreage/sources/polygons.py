"""GeoJSON polygons as rings and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.contracts import ContractError
from acreage.operators.polygons import ring_edges

# Coordinates stay JSON text until the geometry type tells their depth.
FEATURE = "struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>"


def parse_features(features: DataFrame, feature: str = "feature") -> DataFrame:
    """(properties, type, rings) of feature structs; Polygon and MultiPolygon, all rings in one list."""
    geometry = F.col(f"{feature}.geometry")
    kind, text = geometry["type"], geometry["coordinates"]
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi)
    points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return features.select(F.col(f"{feature}.properties").alias("properties"), kind.alias("type"), points.alias("rings"))


def read_geojson(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Features of a GeoJSON file, gzipped or not: a collection, or one feature per line.

    A collection is a single JSON value and is parsed by one task per file; line
    files are split among tasks.
    """
    if one_per_line:
        lines = spark.read.text(path).filter(F.trim("value") != "")
        return parse_features(lines.select(F.from_json("value", FEATURE).alias("feature")))
    whole = spark.read.option("multiLine", True).schema(f"features array<{FEATURE}>").json(path)
    return parse_features(whole.select(F.explode("features").alias("feature")))


def feature_edges(features: DataFrame, poly: Column) -> DataFrame:
    """Edge list (poly, x1, y1, x2, y2) of parsed features, every ring of a feature under one id."""
    rings = features.select(poly.alias("poly"), F.explode("rings").alias("ring"))
    return ring_edges(rings)


def read_admin(spark: SparkSession, path: str, field: str, value: str, one_per_line: bool = False) -> DataFrame:
    """Edges of the polygons whose property ``field`` equals ``value``; an error if there is none."""
    features = read_geojson(spark, path, one_per_line)
    chosen = features.filter(F.col("properties")[field] == value)
    if chosen.isEmpty():
        raise ContractError(f"no polygon with {field} = {value} in {path}")
    return feature_edges(chosen, F.col("properties")[field])
