"""Queries on control, precedence of series, cities, and checks of a finished set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import control
from terrane.sources import table

SQL: dict[str, str] = {}


def controllers(spark: SparkSession, d: str) -> DataFrame:
    """Orders as units with their customers as sovereigns, events from lines, on 1 March 1998."""
    o = table(spark, d, "orders")
    units = o.select(F.col("o_orderkey").alias("unit_id"), (F.col("o_custkey") % 40).alias("code"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") + 1000).alias("sovereign"), F.to_date("o_orderdate").alias("start"), F.when(F.col("o_orderkey") % 4 != 0, F.date_add(F.to_date("o_orderdate"), 900)).alias("stop"))
    events = o.where("o_orderkey % 50 = 0").select((F.col("o_custkey") % 40).alias("code"), F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), 700).alias("stop"), F.when(F.col("o_orderkey") % 100 == 0, "whole").otherwise("partial").alias("scope"), (F.col("o_custkey") + 5000).alias("controller"), F.col("o_orderkey").alias("line_no"))
    return control.controllers(units, events, F.lit("1998-03-01").cast("date"))


SQL["controllers"] = """
WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS t FROM orders), u AS (SELECT * FROM o WHERE t <= DATE '1998-03-01' AND (o_orderkey % 4 = 0 OR t + 900 >= DATE '1998-03-01')),
 e AS (SELECT o_custkey % 40 AS code, arg_max(o_custkey + 5000, o_orderkey) AS c FROM o WHERE o_orderkey % 100 = 0 AND t <= DATE '1998-03-01' AND t + 700 >= DATE '1998-03-01' GROUP BY 1)
SELECT o_orderkey AS unit_id, coalesce(c, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey + 1000 END, o_custkey % 40) AS controller, CASE WHEN c IS NOT NULL THEN 'event' WHEN o_orderkey % 3 <> 0 THEN 'sovereign' ELSE 'self' END AS how FROM u LEFT JOIN e ON code = o_custkey % 40"""


def income_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Incomes of nations by year from what was seen, a path of another source, and peers, each with its flag."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("key"), F.year("o_orderdate").alias("at")).agg(F.avg("o_totalprice").alias("v"))
    grid = table(spark, d, "nation").select(F.col("n_nationkey").alias("key")).join(F.broadcast(spark.range(1995, 2002).select(F.col("id").cast("int").alias("at"))))
    g = grid.join(o, ["key", "at"], "left")
    k, t = F.col("key"), F.col("at")
    seen = F.when((k % 5 < 3) & ((k + t) % 4 == 0), F.col("v"))
    path = F.when((k % 5 == 1) | (k % 5 == 2) | (k % 5 == 3), 1000.0 + k * 10 + (t - 1995) * 50)
    rows = g.select("key", "at", seen.alias("seen"), path.alias("path"))
    region = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_regionkey").alias("region"))
    return control.income_precedence(rows, region).select("key", "at", F.round("income", 4).alias("income"), "flag")


SQL["income_precedence"] = """
WITH v AS (SELECT c_nationkey AS key, year(o_orderdate) AS yr, avg(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 g AS (SELECT n_nationkey AS key, n_regionkey AS region, t.yr, CASE WHEN n_nationkey % 5 < 3 AND (n_nationkey + t.yr) % 4 = 0 THEN v END AS seen, CASE WHEN n_nationkey % 5 IN (1, 2, 3) THEN CAST(1000 + n_nationkey * 10 + (t.yr - 1995) * 50 AS DOUBLE) END AS path
  FROM nation CROSS JOIN range(1995, 2002) t(yr) LEFT JOIN v ON v.key = n_nationkey AND v.yr = t.yr),
 r AS (SELECT *, CASE WHEN seen IS NOT NULL AND path IS NOT NULL THEN ln(seen / path) END AS lg, ln(seen) AS ls FROM g),
 s AS (SELECT *, COUNT(lg) OVER k > 0 AS pair, COUNT(path) OVER k > 0 AS paths, COUNT(seen) OVER k > 0 AS sights FROM r WINDOW k AS (PARTITION BY key)),
 m AS (SELECT yr, median(exp(lg)) AS x FROM r GROUP BY yr),
 mf AS (SELECT a.yr, (SELECT max_by(b.x, b.yr) FROM m b WHERE b.yr <= a.yr AND b.x IS NOT NULL) AS pv, (SELECT max(b.yr) FROM m b WHERE b.yr <= a.yr AND b.x IS NOT NULL) AS pt, (SELECT min_by(b.x, b.yr) FROM m b WHERE b.yr >= a.yr AND b.x IS NOT NULL) AS nv, (SELECT min(b.yr) FROM m b WHERE b.yr >= a.yr AND b.x IS NOT NULL) AS nt FROM m a),
 mm AS (SELECT yr, CASE WHEN pt IS NULL THEN nv WHEN nt IS NULL OR pt = nt THEN pv ELSE pv + (nv - pv) * (yr - pt) / (nt - pt) END AS ratio FROM mf),
 f AS (SELECT s.*, last_value(CASE WHEN lg IS NOT NULL THEN yr END IGNORE NULLS) OVER b AS pt, last_value(lg IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN lg IS NOT NULL THEN yr END IGNORE NULLS) OVER n AS nt, first_value(lg IGNORE NULLS) OVER n AS nv,
   last_value(CASE WHEN ls IS NOT NULL THEN yr END IGNORE NULLS) OVER b AS qt, last_value(ls IGNORE NULLS) OVER b AS qv, first_value(CASE WHEN ls IS NOT NULL THEN yr END IGNORE NULLS) OVER n AS ot, first_value(ls IGNORE NULLS) OVER n AS ov FROM s
  WINDOW b AS (PARTITION BY key ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY key ORDER BY yr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 c AS (SELECT key, region, f.yr, CASE WHEN seen IS NOT NULL THEN seen WHEN pair THEN path * exp(CASE WHEN pt IS NULL THEN nv WHEN nt IS NULL OR pt = nt THEN pv ELSE pv + (nv - pv) * (f.yr - pt) / (nt - pt) END) WHEN paths THEN path * ratio WHEN sights AND qt IS NOT NULL AND ot IS NOT NULL THEN exp(qv + (ov - qv) * (f.yr - qt) / (ot - qt)) END AS income,
   CASE WHEN seen IS NOT NULL THEN 'seen' WHEN pair THEN 'chained' WHEN paths THEN 'scaled' WHEN sights AND qt IS NOT NULL AND ot IS NOT NULL THEN 'log_linear' END AS flag FROM f JOIN mm ON mm.yr = f.yr),
 p AS (SELECT region, yr, median(income) AS peers FROM c GROUP BY ALL)
SELECT key, CAST(c.yr AS INTEGER) AS "at", round(coalesce(income, peers), 4) AS income, coalesce(flag, CASE WHEN peers IS NOT NULL THEN 'peers' END) AS flag FROM c JOIN p ON p.region = c.region AND p.yr = c.yr"""


def composite_zonal(spark: SparkSession, d: str) -> DataFrame:
    """Quantities by nation and type, then by nation and brand class, with zeros for what sold nothing."""
    l, p, s = table(spark, d, "lineitem"), table(spark, d, "part"), table(spark, d, "supplier")
    cells = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("unit"), F.col("p_size").alias("part"), (F.floor(F.col("l_quantity") / 45) * F.col("l_quantity")).cast("long").alias("q"))
    pieces = table(spark, d, "nation").select(F.col("n_nationkey").alias("unit")).join(F.broadcast(spark.range(1, 51).select(F.col("id").cast("int").alias("part")))).withColumn("piece", F.col("part") % 7)
    return control.composite_zonal(cells, pieces, "unit", "part", "q", "quantity")


SQL["composite_zonal"] = """
WITH c AS (SELECT s_nationkey AS unit, p_size % 7 AS piece, CAST(SUM(floor(l_quantity / 45) * l_quantity) AS BIGINT) AS q FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT n_nationkey AS unit, CAST(t.piece AS INTEGER) AS piece, coalesce(q, 0) AS quantity FROM nation CROSS JOIN range(7) t(piece) LEFT JOIN c ON c.unit = n_nationkey AND c.piece = t.piece"""


def grid_measures(spark: SparkSession, d: str) -> DataFrame:
    """Cells of parts: block means and sums, cells moved to a coarser grid by their centres, income of a cell from its nation's
    weighted mean, grouped by code or, without one, by name."""
    p = table(spark, d, "part")
    cells = p.select((F.col("p_partkey") % 60).alias("row"), F.floor(F.col("p_partkey") / 60).alias("col"), F.col("p_retailprice").alias("v"), (F.col("p_size") * 1.0).alias("w"), F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("0|"), "p_brand")).otherwise((F.col("p_size") % 9).cast("string")).alias("key"))
    centre = F.floor(((F.col("row") + 0.5) / 10 * 3 + 1.5) / 2).cast("long")
    return cells.groupBy("key", F.floor(F.col("row") / 3).cast("long").alias("block"), centre.alias("target")).agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.sum("v"), 6).alias("total"), F.round(F.sum(F.col("v") * F.col("w")) / F.sum("w"), 6).alias("weighted"))


SQL["grid_measures"] = """
WITH c AS (SELECT p_partkey % 60 AS r, p_retailprice AS v, CAST(p_size AS DOUBLE) AS w, CASE WHEN p_size % 4 = 0 THEN '0|' || p_brand ELSE CAST(p_size % 9 AS VARCHAR) END AS key FROM part)
SELECT key, CAST(floor(r / 3) AS BIGINT) AS block, CAST(floor(((r + CAST(0.5 AS DOUBLE)) / 10 * 3 + 1.5) / 2) AS BIGINT) AS target, round(avg(v), 6) AS mean, round(SUM(v), 6) AS total, round(SUM(v * w) / SUM(w), 6) AS weighted FROM c GROUP BY ALL"""


def late_units(spark: SparkSession, d: str) -> DataFrame:
    """The value of a customer's year, or of the next where it first ordered after 1 July; incomes of people times a rate."""
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    by = o.groupBy("o_custkey", "year").agg(F.count(F.lit(1)).alias("n"))
    first = o.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first"))
    w = first.withColumn("year", F.year("first")).withColumn("late", F.col("first") > F.make_date(F.year("first"), F.lit(7), F.lit(1)))
    same, after = by.select("o_custkey", "year", F.col("n").alias("n0")), by.select("o_custkey", (F.col("year") - 1).alias("year"), F.col("n").alias("n1"))
    done = w.join(same, ["o_custkey", "year"], "left").join(after, ["o_custkey", "year"], "left")
    value = F.when(F.col("late"), F.coalesce("n1", "n0")).otherwise(F.col("n0"))
    return done.select("o_custkey", "year", value.alias("people"), F.round(value * (F.col("o_custkey") % 25 + 100.5), 4).alias("income"))


SQL["late_units"] = """
WITH b AS (SELECT o_custkey, year(o_orderdate) AS y, COUNT(*) AS n FROM orders GROUP BY ALL), f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1),
 j AS (SELECT f.o_custkey, year(d) AS y, CASE WHEN d > make_date(year(d), 7, 1) THEN coalesce(b1.n, b0.n) ELSE b0.n END AS v FROM f LEFT JOIN b b0 ON b0.o_custkey = f.o_custkey AND b0.y = year(d) LEFT JOIN b b1 ON b1.o_custkey = f.o_custkey AND b1.y = year(d) + 1)
SELECT o_custkey, CAST(y AS INTEGER) AS year, v AS people, round(v * (o_custkey % 25 + CAST(100.5 AS DOUBLE)), 4) AS income FROM j"""


def cities_on(spark: SparkSession, d: str) -> DataFrame:
    """Customers as cities: those shown on a day, with roles, seats and kinds; and the key of the country that holds them."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer")
    cities = c.select(F.col("c_name").alias("city"), F.when(k % 3 == 0, "1939-09-01;1941-06-22").when(k % 3 == 1, "1942-11-01").alias("dates"), F.concat(F.lit("7 8="), F.col("c_mktsegment"), F.lit(";*=rest")).alias("capital"), F.when(k % 4 == 0, "1939-09-01").alias("seat"), F.when(k % 5 == 0, "IC").when(k % 5 == 1, "P").alias("kinds"))
    shown = control.cities_on(cities, "1939-09-01", "8", {"I": 4, "P": 8, "C": 16})
    held = c.select(F.col("c_name").alias("city"), control.country_key(F.col("c_nationkey"), F.when(k % 6 != 0, F.col("c_mktsegment")), {"MACHIN": "machines", "BUILD": "builders"}).alias("country"))
    return shown.join(held, "city").drop("role").withColumn("role", F.col("country"))


SQL["cities_on"] = """
SELECT c_name AS city, coalesce(c_custkey % 4 = 0, false) AS seat, CAST(CASE c_custkey % 5 WHEN 0 THEN 20 WHEN 1 THEN 8 ELSE 0 END AS INTEGER) AS flags,
  CASE WHEN c_custkey % 6 <> 0 AND c_mktsegment LIKE '%MACHIN%' THEN 'machines' WHEN c_custkey % 6 <> 0 AND c_mktsegment LIKE '%BUILD%' THEN 'builders' ELSE CAST(c_nationkey AS VARCHAR) END AS country, country AS role FROM customer WHERE c_custkey % 3 <> 1"""


def set_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the tables as a finished set: sums against totals, shares, references, stable values, names, arrays, schemas."""
    l, o, p, s, c = (table(spark, d, t) for t in ("lineitem", "orders", "part", "supplier", "customer"))
    one = lambda name, df, e: df.agg(F.lit(name).alias("check"), e.cast("double").alias("value"))
    sums = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("a"), (F.sum(F.floor(F.col("o_totalprice") * 100)) / 100).alias("b"))
    total = sums.agg(F.sum("a").alias("t"))
    share = sums.join(F.broadcast(total)).agg(F.sum(F.col("a") / F.col("t")).alias("s"))
    years = o.select(F.year("o_orderdate").alias("y")).distinct()
    arrays = c.groupBy("c_nationkey").agg(F.collect_list("c_custkey").alias("a"), F.collect_list("c_acctbal").alias("b"), F.collect_list((F.col("c_custkey") % 3).cast("int")).alias("i")).withColumn("lut", F.when(F.col("c_nationkey") % 2 == 0, F.array(F.lit("x"), F.lit("y"), F.lit("z"))).otherwise(F.array(F.lit("x"), F.lit("y"))))
    rows = [
        one("largest gap of sums", sums, F.round(control.relative_gap(sums, "a", "b"), 9)), one("shares", share, F.round(F.max("s"), 9)), one("negative balances", c.where("c_acctbal < 0"), F.count(F.lit(1))),
        one("null or empty names", p.where("p_name is null or p_name = ''"), F.count(F.lit(1))), one("years", years, F.max("y") - F.min("y") + 1 - F.count(F.lit(1))),
        one("lines without parts", control.missing_references(l, "l_partkey", p.where("p_partkey % 9 <> 0"), "p_partkey"), F.count(F.lit(1))),
        one("unstable prices", control.unstable(l.withColumn("u", F.col("l_extendedprice") / F.col("l_quantity")), "l_partkey", "u", 5.0), F.count(F.lit(1))),
        one("arrays out of line", control.aligned(arrays, ["a", "b", "i"], "i", "lut"), F.count(F.lit(1))), one("columns that differ", control.schema_difference(s.withColumnRenamed("s_name", "name"), s.withColumn("s_nationkey", F.col("s_nationkey").cast("long"))), F.count(F.lit(1))),
        one("lines before their order", l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate < o_orderdate"), F.count(F.lit(1))),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


SQL["set_checks"] = """
WITH g AS (SELECT o_custkey, SUM(o_totalprice) AS a, SUM(floor(o_totalprice * 100)) / 100 AS b FROM orders GROUP BY 1), y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
SELECT 'largest gap of sums' AS "check", CAST(round(max(abs(a - b) / abs(a)), 9) AS DOUBLE) AS value FROM g UNION ALL SELECT 'shares', round(SUM(a / (SELECT SUM(a) FROM g)), 9) FROM g
UNION ALL SELECT 'negative balances', COUNT(*) FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'null or empty names', COUNT(*) FROM part WHERE p_name IS NULL OR p_name = '' UNION ALL SELECT 'years', max(y) - min(y) + 1 - COUNT(*) FROM y
UNION ALL SELECT 'lines without parts', COUNT(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 9 <> 0)
UNION ALL SELECT 'unstable prices', COUNT(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING max(l_extendedprice / l_quantity) - min(l_extendedprice / l_quantity) > 5 * abs(min(l_extendedprice / l_quantity)))
UNION ALL SELECT 'arrays out of line', COUNT(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING c_nationkey % 2 = 1 AND max(c_custkey % 3) = 2) UNION ALL SELECT 'columns that differ', 3
UNION ALL SELECT 'lines before their order', COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate"""


def digest_check(spark: SparkSession, d: str) -> DataFrame:
    """Tables' digests against a manifest in which one is wrong and one lacks."""
    from terrane.sources.store import hash_of

    found = None
    for name in ("region", "nation", "supplier"):
        t = table(spark, d, name)
        part = t.select(hash_of(t.columns).alias("h")).agg(F.lit(name).alias("table"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "").cast("binary"), 256).alias("digest"))
        found = part if found is None else found.unionByName(part)
    manifest = found.where("table <> 'nation'").withColumn("digest", F.when(F.col("table") == "region", F.lit("0")).otherwise(F.col("digest")))
    from terrane.operators.encode import manifest_diff

    return manifest_diff(manifest, found, "table", "digest")


SQL["digest_check"] = "SELECT 'region' AS \"table\", 'differs' AS state UNION ALL SELECT 'nation', 'extra'"


def largest_stretch(spark: SparkSession, d: str) -> DataFrame:
    """Each brand's largest connected stretch of parts, neighbours by number and by price class."""
    p = table(spark, d, "part")
    nodes = p.select("p_partkey", F.substring("p_brand", 7, 1).alias("brand"), F.col("p_size").cast("long").alias("area"))
    edges = p.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") + 1).alias("dst")).unionByName(p.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") + 10).alias("dst")))
    return control.largest_stretch(nodes, edges, "p_partkey", "brand", "area")


SQL["largest_stretch"] = """
WITH RECURSIVE p AS (SELECT p_partkey AS k, substr(p_brand, 7, 1) AS o, CAST(p_size AS BIGINT) AS a FROM part),
 e AS (SELECT x.k AS s, y.k AS t FROM p x JOIN p y ON x.o = y.o AND (y.k = x.k + 1 OR y.k = x.k + 10)), b AS (SELECT s, t FROM e UNION SELECT t, s FROM e),
 r AS (SELECT k AS root, k FROM p UNION SELECT r.root, b.t FROM r JOIN b ON b.s = r.k WHERE b.t > r.root), l AS (SELECT k, min(root) AS label FROM r GROUP BY k),
 g AS (SELECT o AS owner, label, SUM(a) AS area, COUNT(*) AS n FROM p JOIN l USING (k) GROUP BY ALL)
SELECT owner, label, CAST(area AS BIGINT) AS area, n FROM g QUALIFY row_number() OVER (PARTITION BY owner ORDER BY area DESC, label) = 1"""
