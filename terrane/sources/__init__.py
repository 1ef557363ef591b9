"""Sources: test tables by name, CSV with declared schemas, GeoJSON features, gzip-or-plain binary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def csv(spark: SparkSession, path: str, schema: str, header: bool = True, as_text: bool = False) -> DataFrame:
    """A CSV with a declared schema, never inferred. as_text turns null into the empty string, as rule tables want it."""
    df = spark.read.csv(path, schema=schema, header=header, multiLine=True, escape='"')
    return df.na.fill("") if as_text else df


_GEOMETRY = "struct<type: string, coordinates: string>"


def _features(raw: DataFrame, properties: str) -> DataFrame:
    """One row a feature of texts that hold a collection each: the properties, type and polygons (rings of [x, y])."""
    raw = raw.select(F.from_json("value", f"struct<features: array<struct<properties: struct<{properties}>, geometry: {_GEOMETRY}>>>").alias("d"))
    f = raw.select(F.explode("d.features").alias("f")).select("f.properties.*", "f.geometry.type", "f.geometry.coordinates")
    one = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    many = F.from_json("coordinates", "array<array<array<array<double>>>>")
    return f.withColumn("polygons", F.when(F.col("type") == "Polygon", one).when(F.col("type") == "MultiPolygon", many)).drop("coordinates")


def geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of FeatureCollection files (properties: a DDL list of fields). A file is one row, so it must fit a task."""
    return _features(spark.read.text(path, wholetext=True), properties)


def geojson_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """The same of files with one FeatureCollection a line, which split like any text."""
    return _features(spark.read.text(path), properties)


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """path and bytes of files; those that begin with the gzip magic are unpacked."""
    import gzip

    import pandas as pd

    @F.pandas_udf("binary")
    def plain(content: pd.Series) -> pd.Series:
        return content.map(lambda b: gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b)

    return spark.read.format("binaryFile").load(path).select("path", plain("content").alias("content"))
