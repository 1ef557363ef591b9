"""Queries on rings: containment, clipping, densifying, projections. The test tables hold no outlines, so shapes and places
are made from their numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import mercator, unmercator
from terrane.operators import geometry
from terrane.sources import table

SQL: dict[str, str] = {}

#: Corners of the shape of nation 0; that of nation k lies k * 3.5 to the right. It is concave.
CORNERS = ((0.25, 0.5), (6.5, 1.25), (5.0, 7.75), (3.25, 3.0), (1.0, 9.5))


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", F.array(*[geometry.point(F.lit(x) + F.col("n_nationkey") * 3.5, F.lit(y)) for x, y in CORNERS]).alias("ring"))


def _place() -> tuple[Column, Column]:
    return F.col("c_custkey") * 0.37 % 95.0, (F.col("c_acctbal") + 1000) / 1100


_SHAPES_SQL = "SELECT n_nationkey, i, x + n_nationkey * CAST(3.5 AS DOUBLE) AS x, y FROM nation CROSS JOIN (VALUES " + ", ".join(f"({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for i, (x, y) in enumerate(CORNERS)) + ") t(i, x, y)"
_EDGES_SQL = f"s AS ({_SHAPES_SQL}), e AS (SELECT p.n_nationkey, p.i, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM s p JOIN s q ON q.n_nationkey = p.n_nationkey AND q.i = (p.i + 1) % {len(CORNERS)})"


def polygon_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers, placed by number and balance, inside the shapes of nations."""
    x, y = _place()
    points = table(spark, d, "customer").select("c_custkey", x.alias("x"), y.alias("y"))
    return geometry.points_in_rings(points, _shapes(spark, d), "ring", 2.0).select("c_custkey", "n_nationkey")


SQL["polygon_join"] = f"""
WITH {_EDGES_SQL}, c AS (SELECT c_custkey, (c_custkey * CAST(0.37 AS DOUBLE)) % CAST(95 AS DOUBLE) AS x, (c_acctbal + 1000) / 1100 AS y FROM customer)
SELECT c_custkey, n_nationkey FROM c JOIN e ON (py > y) <> (qy > y) AND x < (qx - px) * (y - py) / nullif(qy - py, 0) + px GROUP BY ALL HAVING COUNT(*) % 2 = 1"""


def tile_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Shapes cut at the tiles of a grid: the tiles' shares add up to each shape's area."""
    s = _shapes(spark, d).withColumn("tx", F.explode(F.sequence(F.floor(F.col("n_nationkey") * 3.5).cast("int"), F.ceil(F.col("n_nationkey") * 3.5 + 7).cast("int")))).withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(9))))
    s = s.select("*", F.col("tx").cast("double").alias("x1"), (F.col("tx") + 1.0).alias("x2"), F.col("ty").cast("double").alias("y1"), (F.col("ty") + 1.0).alias("y2"))
    cut = geometry.clip(s, "ring", "cut", "x1", "x2", "y1", "y2").where(F.size("cut") > 0)
    return cut.groupBy("n_nationkey").agg(F.round(F.sum(geometry.area(F.col("cut"))), 6).alias("area"))


SQL["tile_overlay"] = f"WITH {_EDGES_SQL} SELECT n_nationkey, round(abs(SUM(px * qy - qx * py)) / 2, 6) AS area FROM e GROUP BY 1"


def densify_outline(spark: SparkSession, d: str) -> DataFrame:
    """Points of the shapes' open outlines, at most 0.75 apart."""
    points = _shapes(spark, d).select("n_nationkey", F.posexplode(geometry.densify(F.col("ring"), 0.75)).alias("pos", "p"))
    return points.select("n_nationkey", "pos", F.round("p.x", 9).alias("x"), F.round("p.y", 9).alias("y"))


SQL["densify_outline"] = f"""
WITH {_EDGES_SQL}, n AS (SELECT *, greatest(CAST(ceil(sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py)) / 0.75) AS INTEGER), 1) AS n FROM e WHERE i < {len(CORNERS) - 1}),
 p AS (SELECT n_nationkey, i, k, px + (qx - px) * k / n AS x, py + (qy - py) * k / n AS y FROM (SELECT *, unnest(range(0, n)) AS k FROM n) UNION ALL SELECT n_nationkey, i, 0, x, y FROM s WHERE i = {len(CORNERS) - 1})
SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY i, k) - 1 AS INTEGER) AS pos, round(x, 9) AS x, round(y, 9) AS y FROM p"""


def mercator_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Customers on the Web Mercator map and back."""
    lon, lat = F.col("c_custkey") * 0.37 % 180.0, (F.col("c_acctbal") + 1000) / 150
    m = table(spark, d, "customer").select("c_custkey", *[c.alias(n) for c, n in zip(mercator(lon, lat), ("mx", "my"), strict=True)])
    back = unmercator(F.col("mx"), F.col("my"))
    return m.select("c_custkey", F.round("mx", 8).alias("mx"), F.round("my", 8).alias("my"), F.round(back[0], 6).alias("lon"), F.round(back[1], 6).alias("lat"))


SQL["mercator_roundtrip"] = """
WITH c AS (SELECT c_custkey, (c_custkey * CAST(0.37 AS DOUBLE)) % CAST(180 AS DOUBLE) AS lon, (c_acctbal + 1000) / 150 AS lat FROM customer)
SELECT c_custkey, round((lon + 180) / 360, 8) AS mx, round((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2, 8) AS my, round(lon, 6) AS lon, round(lat, 6) AS lat FROM c"""
