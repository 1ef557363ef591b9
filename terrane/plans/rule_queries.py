"""Queries on rules kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import rule_tables
from terrane.sources import table

SQL: dict[str, str] = {}


def _places(spark: SparkSession, d: str) -> DataFrame:
    """Customers as places: their nation's short name, their segment, a label from balance and key."""
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        "c_custkey", F.substring("n_name", 1, 3).alias("iso3"), F.col("n_name").alias("unit"), F.concat(F.lit("S "), "c_mktsegment").alias("unit_cs"), F.array(F.col("c_mktsegment"), F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string"))).alias("hist_names"),
        (F.col("c_acctbal") / 60).alias("label_lon"), (F.col("c_custkey") % 90).cast("double").alias("label_lat"), F.concat(F.lit(" "), "c_name").alias("name_1"), F.col("c_mktsegment").alias("kind"),
    )


_PLACES = """p AS (SELECT c_custkey, substr(n_name, 1, 3) AS iso3, n_name AS unit, 'S ' || c_mktsegment AS unit_cs, [c_mktsegment, c_mktsegment || '-' || c_nationkey] AS hist,
  c_acctbal / 60 AS x, CAST(c_custkey % 90 AS DOUBLE) AS y, c_name AS name_1, c_mktsegment AS kind FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_FIELD_RULES = [
    (1, "*", "*", "*", 1), (2, "NAT|xxx", "kind", "BUILDING|AUTO*", 2), (3, "*", "geo", "box:0,10,40,30|circle:100,40,900", 3), (4, "*", "unit", "NATION_3|S MACHINERY", 4),
    (5, "*", "hist", "FURNITURE-7|HOUSEHOLD-9", 5), (6, "*", "name_1", "Customer#00000001*|Customer#000000007", 6), (7, "*", "geo", "poly:60 40;140 40;100 85", 7), (8, "none", "*", "*", 8), (9, "*", "absent", "x*", 9),
]


def rules_by_field(spark: SparkSession, d: str) -> DataFrame:
    """The last of nine rules on fields, names and drawn areas that applies to each place."""
    rules = spark.createDataFrame(_FIELD_RULES, "rule_no int, iso3 string, field string, match string, controller int")
    hits = rule_tables.match_fields(_places(spark, d), rules, ["kind", "name_1"])
    last = hits.groupBy("c_custkey").agg(F.max_by("controller", "rule_no").alias("controller"), F.count(F.lit(1)).alias("n_rules"))
    return last.select("c_custkey", "controller", "n_rules")


SQL["rules_by_field"] = f"""
WITH {_PLACES}, h AS (SELECT c_custkey, unnest(list_filter([1,
  CASE WHEN iso3 = 'NAT' AND (kind = 'BUILDING' OR kind LIKE 'AUTO%') THEN 2 END,
  CASE WHEN (x BETWEEN 0 AND 40 AND y BETWEEN 10 AND 30) OR pow(x - 100, 2) + pow(y - 40, 2) <= pow(CAST(900 AS DOUBLE) / 111.32 / cos(radians(40)), 2) THEN 3 END,
  CASE WHEN unit = 'NATION_3' OR unit_cs = 'S MACHINERY' THEN 4 END, CASE WHEN list_contains(hist, 'FURNITURE-7') OR list_contains(hist, 'HOUSEHOLD-9') THEN 5 END,
  CASE WHEN name_1 LIKE 'Customer#00000001%' OR name_1 = 'Customer#000000007' THEN 6 END,
  CASE WHEN y >= 40 AND y < 85 AND x >= 60 + (y - 40) * CAST(40 AS DOUBLE) / 45 AND x < 140 - (y - 40) * CAST(40 AS DOUBLE) / 45 THEN 7 END], lambda r: r IS NOT NULL)) AS r FROM p)
SELECT c_custkey, max(r) AS controller, COUNT(*) AS n_rules FROM h GROUP BY c_custkey"""

_OVERLAY = [
    (1, "1996-06-01", "1998-12-31", "1-URGENT", None, None, None, None, 740, "Leased {parent}"), (2, None, None, "1-URGENT|2-HIGH", "F", None, None, None, None, None),
    (3, None, "1999-12-31", None, None, "c1|c3", None, "big", 365, "{parent}"), (4, "1997-01-01", None, None, None, None, "c2|c4", "even", 255, "rest of {parent}"),
]


def overlay_rules(spark: SparkSession, d: str) -> DataFrame:
    """The first of four rules on period, kind, parent, country and layer that applies to each order on its own day."""
    o = table(spark, d, "orders")
    layers = F.array_compact(F.array(F.when(F.col("o_totalprice") > 200000, "big"), F.when(F.col("o_orderkey") % 2 == 0, "even")))
    places = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("parent"), F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string")).alias("iso3"), layers.alias("layers"))
    rules = spark.createDataFrame(_OVERLAY, "rule_no int, since string, until string, kinds string, parents string, iso3 string, not_iso3 string, layer string, controller int, name string")
    hits = rule_tables.first_in_force(places, rules, "o_orderkey", F.col("p.day"))
    return hits.groupBy("rule_no", "controller", "name").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


SQL["overlay_rules"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS k, o_orderstatus AS p, 'c' || (o_custkey % 5) AS iso, o_totalprice > 200000 AS big, o_orderkey % 2 = 0 AS even FROM orders),
 h AS (SELECT *, CASE WHEN d BETWEEN '1996-06-01' AND '1998-12-31' AND k = '1-URGENT' THEN 1 WHEN k IN ('1-URGENT', '2-HIGH') AND p = 'F' THEN 2
  WHEN d <= '1999-12-31' AND iso IN ('c1', 'c3') AND big THEN 3 WHEN d >= '1997-01-01' AND iso NOT IN ('c2', 'c4') AND even THEN 4 END AS r FROM o)
SELECT CAST(r AS INTEGER) AS rule_no, CAST(CASE r WHEN 1 THEN 740 WHEN 3 THEN 365 WHEN 4 THEN 255 END AS INTEGER) AS controller, CASE r WHEN 1 THEN 'Leased ' || p WHEN 3 THEN p WHEN 4 THEN 'rest of ' || p END AS name, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys
FROM h WHERE r IS NOT NULL GROUP BY ALL"""


def bloc_rules(spark: SparkSession, d: str) -> DataFrame:
    """The bloc of every supplier's nation, by dispute, detail and membership."""
    s = table(spark, d, "supplier")
    code, detail = F.col("s_nationkey"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).otherwise("")
    rules = [(7, F.contains(detail, F.lit("1")), "axis"), (None, F.startswith(detail, F.lit("Supplier#00000009")), "allied"), (3, ~F.contains(detail, F.lit("5")), "allied")]
    return s.select("s_suppkey", rule_tables.bloc(code, detail, {"allied": [1, 2, 3, 20], "axis": [4, 5, 20]}, [2, 24], rules).alias("bloc"))


SQL["bloc_rules"] = """
WITH s AS (SELECT s_suppkey, s_nationkey AS c, CASE WHEN s_suppkey % 4 <> 0 THEN s_name ELSE '' END AS t FROM supplier)
SELECT s_suppkey, CASE WHEN c IN (2, 24) THEN 'contested' WHEN c = 7 AND t LIKE '%1%' THEN 'axis' WHEN t LIKE 'Supplier#00000009%' THEN 'allied' WHEN c = 3 AND t <> '' AND t NOT LIKE '%5%' THEN 'allied'
  WHEN c IN (1, 2, 3, 20) THEN 'allied' WHEN c IN (4, 5, 20) THEN 'axis' ELSE 'neutral' END AS bloc FROM s"""

_NAMES = [(1, "NATION_1", "dependent", None, 1997, "One dep", "一"), (2, "NATION_1", "any", 1996, 1998, "One", None), (3, "NATION_2", "independent", 1998, None, "Two", "二"), (4, "NATION_2", "any", None, None, "Two old", None), (5, "NATION_5", "independent", None, 1990, "Never", None)]


def name_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Names of nations by status and year of the order, of the first fitting line, else their own."""
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    status = F.when(F.col("o_orderstatus") == "F", "colony").when(F.col("o_orderstatus") == "O", "independent")
    units = o.select("o_orderkey", "n_name", status.alias("status"), F.year("o_orderdate").alias("year"))
    names = spark.createDataFrame(_NAMES, "line_no int, name string, applies_to string, year_from int, year_to int, name_en string, name_zh string")
    done = rule_tables.resolve_names(units, names, ["o_orderkey"], "n_name", "status", "year")
    return done.groupBy("name_en", "name_zh", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


SQL["name_resolution"] = """
WITH u AS (SELECT o_orderkey, n_name, o_orderstatus = 'F' AS dep, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
 h AS (SELECT *, CASE WHEN n_name = 'NATION_1' AND dep AND y <= 1997 THEN 1 WHEN n_name = 'NATION_1' AND y BETWEEN 1996 AND 1998 THEN 2 WHEN n_name = 'NATION_2' AND NOT dep AND y >= 1998 THEN 3 WHEN n_name = 'NATION_2' THEN 4 END AS r FROM u)
SELECT CASE r WHEN 1 THEN 'One dep' WHEN 2 THEN 'One' WHEN 3 THEN 'Two' WHEN 4 THEN 'Two old' ELSE n_name END AS name_en, CASE r WHEN 1 THEN '一' WHEN 3 THEN '二' END AS name_zh, CAST(y AS INTEGER) AS year, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM h GROUP BY ALL"""

def _part_units(spark: SparkSession, d: str) -> DataFrame:
    first, last = F.substring("p_type", 1, 3), F.regexp_extract("p_type", r"(\S+)$", 1)
    return table(spark, d, "part").select(F.col("p_partkey").alias("unit_id"), first.alias("iso3"), last.alias("parent"), F.col("p_name").alias("name"))


def member_lists(spark: SparkSession, d: str) -> DataFrame:
    """Units that lists of members name, take away, or leave to a row of the rest, by period."""
    u = _part_units(spark, d)
    some = u.groupBy("iso3", "name").agg(F.min("parent").alias("parent")).orderBy("iso3", "name", "parent")
    first = some.groupBy("iso3").agg(F.min("name").alias("name"), F.max("name").alias("other")).orderBy("iso3").collect()
    rows = []
    for k, r in enumerate(first):
        other = first[(k + 1) % len(first)]
        rows += [(10 * k, r.iso3, "own", f"{r.name};{other.iso3}:{other.name}", "1900", "1920"), (10 * k + 1, r.iso3, "all but", f"{r.iso3}:*;-{r.other}", "1930", None), (10 * k + 2, r.iso3, "*", "", "1910", "1915"), (10 * k + 3, r.iso3, "*", "", "1925", "1940"), (10 * k + 4, r.iso3, "*", "", "1921", "1924")]
    listed = spark.createDataFrame(rows, "row_no int, iso3 string, name string, members string, start string, stop string")
    return rule_tables.members(listed, u).groupBy("row_no").agg(F.count(F.lit(1)).alias("n"), F.sum("unit_id").alias("ids"))


SQL["member_lists"] = """
WITH u AS (SELECT p_partkey AS id, substr(p_type, 1, 3) AS iso, p_name AS name FROM part),
 f AS (SELECT iso, min(name) AS a, max(name) AS z, row_number() OVER (ORDER BY iso) - 1 AS k, COUNT(*) OVER () AS n FROM u GROUP BY iso),
 g AS (SELECT f.*, o.iso AS oiso, o.a AS oa FROM f JOIN f o ON o.k = (f.k + 1) % f.n),
 own AS (SELECT 10 * k AS r, id FROM g JOIN u ON (u.iso = g.iso AND u.name = g.a) OR (u.iso = oiso AND u.name = oa)),
 allb AS (SELECT 10 * k + 1 AS r, id FROM g JOIN u ON u.iso = g.iso AND u.name <> g.z),
 rest AS (SELECT 10 * k + 2 AS r, id FROM g JOIN u ON u.iso = g.iso WHERE id NOT IN (SELECT id FROM own)
  UNION ALL SELECT 10 * k + 3, id FROM g JOIN u ON u.iso = g.iso WHERE id NOT IN (SELECT id FROM allb) UNION ALL SELECT 10 * k + 4, id FROM g JOIN u ON u.iso = g.iso)
SELECT CAST(r AS INTEGER) AS row_no, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS ids FROM (SELECT * FROM own UNION ALL SELECT * FROM allb UNION ALL SELECT * FROM rest) GROUP BY r"""
