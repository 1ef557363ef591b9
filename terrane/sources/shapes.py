"""Outline files: TopoJSON with shared arcs, shapefiles with their attribute tables."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ARCS = "array<array<array<double>>>"


def topojson(spark: SparkSession, path: str, name: str, properties: str) -> DataFrame:
    """path, feature (number), the properties (a DDL schema) and polygons (polygons of rings of points) of the object `name`.

    A ring is its arcs end to end without the points where they join; arc ~i is arc i reversed. Arcs of quantised files are
    summed and scaled. Rings of fewer than four points and features without rings are left out; rings keep their file's
    direction. Arcs meet the rings that use them by a join, so a file's arcs aren't repeated a feature."""

    @F.pandas_udf(_ARCS)
    def placed(arcs: pd.Series, scale: pd.Series, move: pd.Series) -> pd.Series:
        def one(arc, s, m):
            xy = np.stack([np.asarray(p, float)[:2] for p in arc])
            return (xy if s is None else np.cumsum(xy, axis=0) * np.asarray(s, float) + np.asarray(m, float)).tolist()

        return pd.Series([[one(arc, s, m) for arc in file] for file, s, m in zip(arcs, scale, move, strict=True)])

    geometry = f"struct<type: string, properties: struct<{properties}>, arcs: string>"
    schema = f"struct<arcs: {_ARCS}, transform: struct<scale: array<double>, translate: array<double>>, objects: map<string, struct<geometries: array<{geometry}>>>>"
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("d"))
    arcs = files.select("path", F.posexplode(placed("d.arcs", "d.transform.scale", "d.transform.translate")).alias("arc", "line"))
    features = files.select("path", F.posexplode(F.element_at("d.objects", name)["geometries"]).alias("feature", "g"))
    one, many = F.array(F.from_json("g.arcs", "array<array<int>>")), F.from_json("g.arcs", "array<array<array<int>>>")
    shapes = features.withColumn("_p", F.when(F.col("g.type") == "Polygon", one).when(F.col("g.type") == "MultiPolygon", many)).select("path", "feature", "g.properties.*", "_p")
    uses = shapes.select("path", "feature", F.posexplode("_p").alias("polygon", "_r")).select("path", "feature", "polygon", F.posexplode("_r").alias("ring", "_a"))
    uses = uses.select("path", "feature", "polygon", "ring", F.posexplode("_a").alias("at", "id")).withColumn("arc", F.when(F.col("id") < 0, -1 - F.col("id")).otherwise(F.col("id")))
    line = F.when(F.col("id") < 0, F.reverse("line")).otherwise(F.col("line"))
    met = uses.join(arcs, ["path", "arc"]).select("path", "feature", "polygon", "ring", "at", F.when(F.col("at") > 0, F.slice(line, 2, F.size(line))).otherwise(line).alias("line"))
    in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    rings = met.groupBy("path", "feature", "polygon", "ring").agg(F.flatten(F.transform(in_order("at", "line"), lambda s: s["line"])).alias("points")).where(F.size("points") >= 4)
    polygons = rings.groupBy("path", "feature", "polygon").agg(F.transform(in_order("ring", "points"), lambda s: s["points"]).alias("rings"))
    whole = polygons.groupBy("path", "feature").agg(F.transform(in_order("polygon", "rings"), lambda s: s["rings"]).alias("polygons"))
    return shapes.drop("_p").join(whole, ["path", "feature"])


def _records(shp: bytes) -> Iterator[tuple[int, list[list[list[float]]]]]:
    """Shape type and its parts, lines of points, of each record."""
    at, end = 100, min(len(shp), 2 * struct.unpack(">i", shp[24:28])[0])
    while at + 8 <= end:
        size = 2 * struct.unpack(">i", shp[at + 4 : at + 8])[0]
        body = shp[at + 8 : at + 8 + size]
        if len(body) < size:
            raise ValueError("truncated")
        at += 8 + size
        kind = struct.unpack("<i", body[:4])[0]
        if kind in (1, 11, 21):
            yield kind, [[list(struct.unpack("<2d", body[4:20]))]]
        elif kind in (3, 5, 13, 15, 23, 25):
            parts, points = struct.unpack("<2i", body[36:44])
            first = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
            xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
            yield kind, [xy[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]
        elif kind == 0:
            yield kind, []
        else:
            raise ValueError(f"shape type {kind} isn't read")


def _attributes(dbf: bytes, encoding: str) -> Iterator[dict[str, str] | None]:
    """Trimmed values by field name; None for a record marked as deleted."""
    rows, head, width = struct.unpack("<IHH", dbf[4:12])
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(encoding), dbf[at + 16]))
        at += 32
    for i in range(rows):
        row, place, out = dbf[head + i * width : head + (i + 1) * width], 1, {}
        for name, size in fields:
            out[name] = row[place : place + size].decode(encoding).strip(" \0")
            place += size
        yield None if row[:1] == b"*" else out


def shapefile(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """path (without suffix), record, kind (shape type), parts (lines of points) and attributes (a map of strings) of the
    records of the .shp files matched, each beside its .dbf file of the same name; deleted records are left out. Files are
    parsed whole; a .shp without a .dbf, or one with another number of records, is an error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, shp, dbf in zip(batch["stem"], batch["shp"], batch["dbf"], strict=True):
                if dbf is None:
                    raise ValueError(f"{path} has no .dbf file")
                pairs = zip(_records(bytes(shp)), _attributes(bytes(dbf), encoding), strict=True)
                rows = [(path, i, kind, parts, told) for i, ((kind, parts), told) in enumerate(pairs) if told is not None]
                for a in range(0, len(rows), 1000):
                    yield pd.DataFrame(rows[a : a + 1000], columns=["path", "record", "kind", "parts", "attributes"])

    def files(suffix: str) -> DataFrame:
        found = spark.read.format("binaryFile").load(os.path.splitext(path)[0] + suffix)
        return found.select(F.regexp_replace("path", r"\.[^.]*$", "").alias("stem"), F.col("content").alias(suffix[1:]))

    return files(".shp").join(files(".dbf"), "stem", "left").mapInPandas(parse, f"path string, record int, kind int, parts {_ARCS}, attributes map<string, string>")


def rings_of(parts: Column) -> Column:
    """Rings as `operators.geometry` wants them: points (x, y) without the repeated last one."""
    return F.transform(parts, lambda r: F.transform(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
