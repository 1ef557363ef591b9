"""Queries on upserts, exports, memberships, digests, documents, and on further joins in time and by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import compact, holds, lighten, role
from terrane.operators import maintain, rules, temporal
from terrane.sources import table

SQL: dict[str, str] = {}


def upsert(spark: SparkSession, d: str) -> DataFrame:
    """Orders not yet open, upserted with the orders since 1999, which carry another priority; and with those that are new only."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    old = o.where("o_orderstatus <> 'O'").select("o_orderkey", "o_orderpriority")
    new = o.where("o_orderdate >= '1999-01-01'").select("o_orderkey", F.concat("o_orderstatus", F.lit(":new")).alias("o_orderpriority"))
    both = [maintain.upsert(old, new, ["o_orderkey"], r).withColumn("mode", F.lit(m)) for r, m in ((True, "replace"), (False, "ignore"))]
    return both[0].unionByName(both[1])


SQL["upsert"] = """
WITH old AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'),
 new AS (SELECT o_orderkey, o_orderstatus || ':new' AS o_orderpriority FROM orders WHERE o_orderdate >= '1999-01-01')
SELECT *, 'replace' AS mode FROM new UNION ALL SELECT *, 'replace' FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL SELECT *, 'ignore' FROM old UNION ALL SELECT *, 'ignore' FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)"""


def subset_export(spark: SparkSession, d: str) -> DataFrame:
    """What an export of the lines shipped in March 1998 takes along."""
    l = table(spark, d, "lineitem").where("l_shipdate >= '1998-03-01' and l_shipdate < '1998-04-01'")
    dims = [("order", table(spark, d, "orders"), "o_orderkey", "l_orderkey"), ("part", table(spark, d, "part"), "p_partkey", "l_partkey"), ("supplier", table(spark, d, "supplier"), "s_suppkey", "l_suppkey")]
    return maintain.referenced(l, dims)


SQL["subset_export"] = """
WITH l AS (SELECT * FROM lineitem WHERE l_shipdate >= '1998-03-01' AND l_shipdate < '1998-04-01')
SELECT 'order' AS kind, o_orderkey AS key FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM l)
UNION ALL SELECT 'part', p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)
UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM l)"""


def membership_sets(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of events of a user before and after the 15th, united, and those of them that are clicks or views."""
    e = table(spark, d, "events")
    kinds = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("event_type")))), "|")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    g = e.groupBy("user_id").agg(kinds(early).alias("a"), kinds(~early).alias("b"))
    both = maintain.union_members(F.col("a"), F.col("b"))
    return g.select("user_id", both.alias("members"), maintain.keep_members(both, ["click", "view"]).alias("kept"))


SQL["membership_sets"] = """
WITH m AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS m FROM events GROUP BY user_id)
SELECT user_id, array_to_string(m, '|') AS members, array_to_string(list_filter(m, lambda x: x IN ('click', 'view')), '|') AS kept FROM m"""


def checksum_tree(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_nationkey", "c_name", F.md5("c_mktsegment").alias("h"))
    return maintain.tree_digest(c, ["c_nationkey"], "c_name", "h", "digest")


SQL["checksum_tree"] = """
WITH b AS (SELECT c_nationkey, substr(md5(c_name), 1, 2) AS b, sha256(string_agg(c_name || '=' || md5(c_mktsegment), chr(10) ORDER BY c_name || '=' || md5(c_mktsegment))) AS d FROM customer GROUP BY ALL)
SELECT c_nationkey, sha256(string_agg(b || d, '' ORDER BY b || d)) AS digest FROM b GROUP BY c_nationkey"""


def json_documents(spark: SparkSession, d: str) -> DataFrame:
    """A nested document a region, its nations by name with their customers."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    j = n.join(c, "n_nationkey", "left").select("n_regionkey", F.struct(F.col("n_name").alias("name"), F.coalesce("customers", F.lit(0)).alias("customers")).alias("s"))
    g = j.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("s")).alias("nations"))
    return r.join(g, F.col("r_regionkey") == F.col("n_regionkey")).select("r_regionkey", F.to_json(F.struct(F.col("r_name").alias("region"), "nations")).alias("doc"))


SQL["json_documents"] = """
WITH c AS (SELECT c_nationkey, COUNT(*) AS k FROM customer GROUP BY 1),
 n AS (SELECT n_regionkey, list({'name': n_name, 'customers': coalesce(k, 0)} ORDER BY n_name, coalesce(k, 0)) AS nations FROM nation LEFT JOIN c ON c_nationkey = n_nationkey GROUP BY 1)
SELECT r_regionkey, CAST(to_json({'region': r_name, 'nations': nations}) AS VARCHAR) AS doc FROM region JOIN n ON n_regionkey = r_regionkey"""


def whole_event_join(spark: SparkSession, d: str) -> DataFrame:
    """Of every part the last economy part of the same brand or of the same size."""
    p = table(spark, d, "part")
    events = p.where("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("no"), F.col("p_brand").alias("name"), F.col("p_size").alias("code"), F.col("p_name").alias("v"))
    return rules.last_of_either(p.select("p_partkey", "p_brand", "p_size"), events, [("p_brand", "name"), ("p_size", "code")], "no", "v", "found").select("p_partkey", "found")


SQL["whole_event_join"] = """
WITH e AS (SELECT * FROM part WHERE p_type = 'ECONOMY'),
 b AS (SELECT p_brand AS k, MAX(p_partkey) AS no FROM e GROUP BY 1), s AS (SELECT p_size AS k, MAX(p_partkey) AS no FROM e GROUP BY 1)
SELECT p.p_partkey, f.p_name AS found FROM part p LEFT JOIN b ON b.k = p.p_brand LEFT JOIN s ON s.k = p.p_size LEFT JOIN part f ON f.p_partkey = greatest(b.no, s.no)"""


def preferred_record(spark: SparkSession, d: str) -> DataFrame:
    """A customer's order of the 60 days before a day, the first by key, or else that of the nearest year."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 60).alias("b"))
    return temporal.preferred(o, "o_custkey", "a", "b", "o_orderkey", ["1996-07-01", "1998-07-01", "2000-07-01"], "o_orderkey", "found")


SQL["preferred_record"] = """
WITH r AS (SELECT o_custkey, CAST(x AS DATE) AS day, o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 60 AS b FROM orders CROSS JOIN (VALUES ('1996-07-01'), ('1998-07-01'), ('2000-07-01')) t(x))
SELECT o_custkey, day, o_orderkey AS found FROM r
QUALIFY row_number() OVER (PARTITION BY o_custkey, day ORDER BY CASE WHEN day BETWEEN a AND b THEN 0 ELSE 1 END, CASE WHEN day BETWEEN a AND b THEN 0 ELSE abs(year(a) - year(day)) END, o_orderkey) = 1"""


def near_value(spark: SparkSession, d: str) -> DataFrame:
    """A customer's orders of the year nearest to 1998 in which it had two or more."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return temporal.floor_then_near(o.withColumn("n", F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))), "o_custkey", "y", "n", 1998, "near")


SQL["near_value"] = """
WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, CASE WHEN COUNT(*) > 1 THEN COUNT(*) ELSE 0 END AS n FROM orders GROUP BY 1, 2),
 f AS (SELECT coalesce(MAX(y) FILTER (y <= 1998), MIN(y)) AS y0 FROM o),
 b AS (SELECT o_custkey, n FROM o, f WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY abs(y - y0), y) = 1)
SELECT o_custkey, coalesce(n, 0) AS near FROM (SELECT DISTINCT o_custkey FROM o) LEFT JOIN b USING (o_custkey)"""


def mode_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """A customer's most frequent priority; of equally frequent ones that of the earlier order."""
    c = table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("at"))
    return c.groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("n", -F.col("at"))).alias("mode"))


SQL["mode_first_seen"] = """
SELECT o_custkey, o_orderpriority AS mode FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n, MIN(o_orderkey) AS seen FROM orders GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, seen) = 1"""


def gap_groups(spark: SparkSession, d: str) -> DataFrame:
    """Years of customers whose largest order exceeds their smallest by more than a fiftieth and one, with their states."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y"))
    g = o.agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("states"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    return g.where("hi > lo * 1.02D + 1").select("o_custkey", "y", "states", "lo", "hi")


SQL["gap_groups"] = """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS states, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi
FROM orders GROUP BY 1, 2 HAVING MAX(o_totalprice) > MIN(o_totalprice) * CAST(1.02 AS DOUBLE) + 1"""


def ranking_page(spark: SparkSession, d: str) -> DataFrame:
    """The 30 customers with the highest order value and customer 7 with its own rank; the share of all orders' value."""
    t = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("v"))
    own, every = t.where("o_custkey = 7").select(F.col("o_custkey").alias("k"), F.col("v").alias("w")), t.agg(F.sum("v").alias("total"))
    top = t.orderBy(F.desc("v"), "o_custkey").limit(30)
    ahead = t.join(F.broadcast(own), (F.col("v") > F.col("w")) | ((F.col("v") == F.col("w")) & (F.col("o_custkey") <= F.col("k"))))
    mine = ahead.groupBy(F.col("k").alias("o_custkey"), F.col("w").alias("v")).agg(F.count(F.lit(1)).alias("rank"))
    ranked = top.groupBy().agg(F.sort_array(F.collect_list(F.struct((-F.col("v")).alias("m"), "o_custkey", "v"))).alias("a")).select(F.posexplode("a").alias("i", "s")).select("s.o_custkey", "s.v", (F.col("i") + 1).cast("long").alias("rank"))
    return ranked.unionByName(mine.where("rank > 30")).join(F.broadcast(every)).select("rank", "o_custkey", F.round(F.col("v").cast("double") / F.col("total").cast("double"), 9).alias("share"))


SQL["ranking_page"] = """
WITH t AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS v FROM orders GROUP BY 1),
 r AS (SELECT *, row_number() OVER (ORDER BY v DESC, o_custkey) AS rank FROM t)
SELECT rank, o_custkey, round(CAST(v AS DOUBLE) / CAST((SELECT SUM(v) FROM t) AS DOUBLE), 9) AS share FROM r WHERE rank <= 30 OR o_custkey = 7"""


def column_functions(spark: SparkSession, d: str) -> DataFrame:
    """Roles, tests of a detail, rounding for documents and lighter colours, on parts."""
    p = table(spark, d, "part")
    colour = F.concat(F.lit("#"), F.substring(F.md5("p_brand"), 1, 6))
    return p.select(
        "p_partkey", role(F.concat(F.lit("40 50=x;"), F.col("p_size").cast("string"), F.lit(" 99= "), F.col("p_type"), F.lit(" ;*=rest")), "7").alias("role"),
        holds("startswith", "small", F.col("p_name")).alias("small"), holds("lacks", "widget", F.col("p_name")).alias("lacks"),
        compact("size_share", F.col("p_size") / F.lit(7.0)).alias("size_share"), compact("price", F.col("p_retailprice") / F.lit(7.0)).alias("price"), lighten(colour, 0.42).alias("light"),
    )


SQL["column_functions"] = """
WITH c AS (SELECT *, [CAST(('0x' || substr(md5(p_brand), i, 2)) AS INTEGER) FOR i IN [1, 3, 5]] AS rgb FROM part)
SELECT p_partkey, CASE WHEN p_size = 7 THEN p_type ELSE 'rest' END AS role, p_name LIKE 'small%' AS small, p_name NOT LIKE '%widget%' AS lacks,
  round(p_size / CAST(7 AS DOUBLE), 7) AS size_share, round(p_retailprice / CAST(7 AS DOUBLE), 3) AS price,
  '#' || array_to_string([format('{:02x}', CAST(round_even(v + (255 - v) * CAST(0.42 AS DOUBLE), 0) AS INTEGER)) FOR v IN rgb], '') AS light FROM c"""
