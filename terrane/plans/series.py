"""Queries on spliced and scaled series and on nearest sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import series, spatial
from terrane.sources import table

SQL: dict[str, str] = {}


def splice_series(spark: SparkSession, d: str) -> DataFrame:
    """Order values of a nation from 1998, before that its order counts scaled to them; every fourth nation has no counts
    and is cast back with its region."""
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    sums = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("value"), F.count(F.lit(1)).alias("orders"))
    grid = n.select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"), F.explode(F.sequence(F.lit(1995), F.lit(2000))).alias("y"))
    counted = grid.join(sums, ["nation", "y"], "left").withColumn("orders", F.when(F.col("nation") % 4 != 0, F.col("orders")))
    spliced = series.splice(counted, "nation", "y", 1998, "value", "orders", "spliced")
    return series.cast_back(spliced, "nation", "region", "y", 1998, "spliced", "filled", "how").select("nation", "y", F.round("filled", 2).alias("filled"), "how")


SQL["splice_series"] = """
WITH s AS (SELECT c_nationkey AS nation, year(o_orderdate) AS y, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS value, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 g AS (SELECT n_nationkey AS nation, n_regionkey AS region, CAST(t.y AS INTEGER) AS y, value, CASE WHEN n_nationkey % 4 <> 0 THEN orders END AS orders FROM nation CROSS JOIN range(1995, 2001) t(y) LEFT JOIN s ON s.nation = n_nationkey AND s.y = t.y),
 p AS (SELECT *, CASE WHEN y >= 1998 THEN value ELSE orders * MAX(CASE WHEN y = 1998 THEN value / orders END) OVER (PARTITION BY nation) END AS v FROM g),
 w AS (SELECT *, COUNT(v) OVER (PARTITION BY nation) = COUNT(*) OVER (PARTITION BY nation) AS whole, MAX(CASE WHEN y = 1998 THEN v END) OVER (PARTITION BY nation) AS v0 FROM p),
 r AS (SELECT region, y, SUM(v) AS t FROM w WHERE whole GROUP BY ALL), a AS (SELECT y, SUM(t) AS t FROM r GROUP BY y),
 rg AS (SELECT region, y, t / (SELECT t FROM r z WHERE z.region = r.region AND z.y = 1998) AS f FROM r), ag AS (SELECT y, t / (SELECT t FROM a WHERE y = 1998) AS f FROM a)
SELECT nation, w.y AS y, round(CASE WHEN v IS NOT NULL THEN v WHEN w.y < 1998 THEN v0 * coalesce(rg.f, ag.f) END, 2) AS filled,
 CASE WHEN v IS NOT NULL THEN 'given' WHEN w.y < 1998 AND v0 * rg.f IS NOT NULL THEN 'group' WHEN w.y < 1998 AND v0 * ag.f IS NOT NULL THEN 'all' END AS how
FROM w LEFT JOIN rg ON rg.region = w.region AND rg.y = w.y LEFT JOIN ag ON ag.y = w.y"""


def stage2_scale(spark: SparkSession, d: str) -> DataFrame:
    """Ratio of a nation's yearly order count to its mean; years in which one segment has 0.28 of the orders or more are
    dominated, 1997 and 1999 carry the last scaled ratio."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    cells = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("y"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    years = cells.groupBy("nation", "y").agg(F.sum("n").alias("n"), (F.max("n") / F.sum("n")).alias("top"))
    mean = years.groupBy("nation").agg((F.sum("n") / F.count(F.lit(1))).alias("mean"))
    ratios = years.join(mean, "nation").withColumn("r", F.col("n") / F.col("mean"))
    return series.bounded_ratio(ratios, "nation", "y", "r", F.col("top") >= 0.28, F.col("y").isin(1997, 1999), "ratio", "why").select("nation", "y", "why", F.round("ratio", 9).alias("ratio"))


SQL["stage2_scale"] = """
WITH c AS (SELECT c_nationkey AS nation, year(o_orderdate) AS y, c_mktsegment, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 y AS (SELECT nation, y, SUM(n) AS n, MAX(n) / SUM(n) AS top FROM c GROUP BY ALL),
 r AS (SELECT *, n / (SUM(n) OVER (PARTITION BY nation) / COUNT(*) OVER (PARTITION BY nation)) AS r FROM y),
 w AS (SELECT *, CASE WHEN top >= 0.28 THEN 'dominant' WHEN y IN (1997, 1999) THEN 'carried' WHEN r NOT BETWEEN 0.6 AND 1.67 THEN 'outlier' ELSE 'scaled' END AS why FROM r)
SELECT CAST(nation AS INTEGER) AS nation, CAST(y AS INTEGER) AS y, why, round(CASE why WHEN 'scaled' THEN r WHEN 'carried' THEN coalesce(last_value(CASE WHEN why = 'scaled' THEN r END IGNORE NULLS)
  OVER (PARTITION BY nation ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) ELSE 1.0 END, 9) AS ratio FROM w"""


def nearest_neighbor(spark: SparkSession, d: str) -> DataFrame:
    """Of every vector the label whose mean is nearest in the first two dimensions."""
    at = table(spark, d, "embeddings").select(F.col("vec_id").alias("pid"), "label", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    means = at.groupBy(F.col("label").alias("sid")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return spatial.nearest_site(at, means, 0.05).select(F.col("pid").alias("vec_id"), F.col("sid").alias("label"), F.round("dist", 9).alias("dist"))


SQL["nearest_neighbor"] = """
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
 s AS (SELECT label, AVG(x) AS x, AVG(y) AS y FROM p GROUP BY label),
 j AS (SELECT vec_id, s.label, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d FROM p CROSS JOIN s)
SELECT vec_id, label, round(d, 9) AS dist FROM j QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, label) = 1"""
