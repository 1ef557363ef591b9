"""Exact plane geometry on rings, arrays of points (x, y) without a repeated last point: area, containment, clipping,
densifying, simplifying. All but `simplify` are column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.operators import spatial

RING = "array<struct<x: double, y: double>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def edges(ring: Column, closed: bool = True) -> Column:
    """p and q of consecutive points; a closed ring has one from its last point to its first."""
    rest = F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0)))
    if closed:
        return F.zip_with(ring, F.concat(rest, F.slice(ring, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    return F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), rest, lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def area(ring: Column) -> Column:
    """Half the absolute cross sum; 0 for fewer than three points."""
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])) / 2


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: true where a ray to the right crosses an odd number of edges."""

    def crosses(e: Column) -> Column:
        at = F.try_divide((e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]), e["q"]["y"] - e["p"]["y"]) + e["p"]["x"]
        return ((e["p"]["y"] > y) != (e["q"]["y"] > y)) & F.coalesce(x < at, F.lit(False))

    return F.size(F.filter(edges(ring), crosses)) % 2 == 1


def points_in_rings(points: DataFrame, rings: DataFrame, ring: str, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points joined to the rings that hold them: by the cells of the rings' boxes, then exactly. Empty rings hold none."""
    of = lambda which, c: which(F.transform(ring, lambda p: p[c]))
    boxed = rings.where(F.size(ring) > 2).select("*", of(F.array_min, "x").alias("x1"), of(F.array_max, "x").alias("x2"), of(F.array_min, "y").alias("y1"), of(F.array_max, "y").alias("y2"))
    return spatial.points_in_boxes(points, boxed, x, y, size).where(contains(F.col(ring), F.col(x), F.col(y))).drop("x1", "x2", "y1", "y2")


def _half(ring: Column, inside: Callable[[Column], Column]) -> Column:
    """The part of the ring where `inside` of a point isn't negative."""

    def piece(e: Column) -> Column:
        p, q = e["p"], e["q"]
        dp, dq = inside(p), inside(q)
        t = F.try_divide(dp, dp - dq)
        cut = point(p["x"] + (q["x"] - p["x"]) * t, p["y"] + (q["y"] - p["y"]) * t)
        none = F.array().cast(RING)
        return F.when((dp >= 0) & (dq >= 0), F.array(q)).when(dp >= 0, F.array(cut)).when(dq >= 0, F.array(cut, q)).otherwise(none)

    return F.flatten(F.transform(edges(ring), piece))


def clip(df: DataFrame, ring: str, out: str, x1: str, x2: str, y1: str, y2: str) -> DataFrame:
    """The ring's part inside the box, one side after the other; an empty array where they don't meet. A concave ring that
    falls apart stays one ring with edges along the box, whose area is right."""
    sides = (lambda p: p["x"] - F.col(x1), lambda p: F.col(x2) - p["x"], lambda p: p["y"] - F.col(y1), lambda p: F.col(y2) - p["y"])
    df = df.withColumn(out, F.col(ring).cast(RING))
    for inside in sides:
        df = df.withColumn(out, _half(F.col(out), inside))
    return df


def densify(line: Column, step: float) -> Column:
    """The line with points between, no two farther apart than the step; its own points stay."""

    def parts(e: Column) -> Column:
        p, q = e["p"], e["q"]
        n = F.greatest(F.ceil(F.hypot(q["x"] - p["x"], q["y"] - p["y"]) / step), F.lit(1)).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: point(p["x"] + (q["x"] - p["x"]) * k / n, p["y"] + (q["y"] - p["y"]) * k / n))

    return F.concat(F.flatten(F.transform(edges(line, closed=False), parts)), F.slice(line, -1, 1))


def simplifier(tolerance: float) -> Callable[[Column], Column]:
    """A function of lines that keeps their ends and the points by which they stray farther than the tolerance."""

    def kept(xy: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(xy), bool)
        keep[[0, -1]] = True
        todo = [(0, len(xy) - 1)]
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            chord, away = xy[b] - xy[a], xy[a + 1 : b] - xy[a]
            length = np.hypot(*chord)
            far = np.abs(chord[0] * away[:, 1] - chord[1] * away[:, 0]) / length if length else np.hypot(away[:, 0], away[:, 1])
            worst = int(far.argmax())
            if far[worst] > tolerance:
                keep[a + 1 + worst] = True
                todo += [(a, a + 1 + worst), (a + 1 + worst, b)]
        return keep

    @F.pandas_udf("array<array<double>>")
    def work(lines: pd.Series) -> pd.Series:
        def one(line):
            if line is None or len(line) < 3:
                return line
            xy = np.stack([np.asarray(p, float) for p in line])
            return xy[kept(xy)].tolist()

        return lines.map(one)

    return lambda line: F.transform(work(F.transform(line, lambda p: F.array(p["x"], p["y"]))), lambda p: point(p[0], p[1]))


def segment_key(e: Column, places: int = 2) -> Column:
    """An edge's rounded ends, the smaller first, so that both directions have one key."""
    end = lambda p: F.format_string(f"%.{places}f,%.{places}f", F.round(p["x"], places) + F.lit(0.0), F.round(p["y"], places) + F.lit(0.0))
    return F.array_join(F.array_sort(F.array(end(e["p"]), end(e["q"]))), ",")
