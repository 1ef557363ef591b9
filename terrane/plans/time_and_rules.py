"""Queries on validity in time and on ordered rules. Each function has its SQL in SQL under the same name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import rules, temporal
from terrane.sources import table

SQL: dict[str, str] = {}


def _order_spans(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("status"), F.to_date("o_orderdate").alias("start_date"))
    return temporal.intervals(o, "o_custkey", "start_date", ["o_orderkey"])


def validity_join(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").select(F.date_trunc("quarter", "o_orderdate").cast("date").alias("d")).distinct()
    held = temporal.interval_join(days, _order_spans(spark, d), "d", "start_date", "next_start", "quarter")
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    g = held.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    g = g.groupBy("d", F.col("r_name").alias("region"), "status").agg(F.count(F.lit(1)).alias("n_customers"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).cast("decimal(20,2)").alias("balance"))
    total = g.groupBy("d", "region").agg(F.sum("n_customers").alias("_t"))
    return g.join(total, ["d", "region"]).select("d", "region", "status", "n_customers", "balance", (F.col("n_customers").cast("double") / F.col("_t")).alias("share"))


SQL["validity_join"] = """
WITH iv AS (SELECT o_custkey, o_orderpriority AS status, CAST(o_orderdate AS DATE) AS s, LEAD(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS e FROM orders),
 snap AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d FROM orders),
 g AS (SELECT snap.d, r_name AS region, status, COUNT(*) AS n_customers, SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS balance FROM snap JOIN iv ON s <= snap.d AND (e IS NULL OR snap.d < e)
   JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL)
SELECT d, region, status, CAST(n_customers AS BIGINT) AS n_customers, CAST(balance AS DECIMAL(20,2)) AS balance, CAST(n_customers AS DOUBLE) / SUM(n_customers) OVER (PARTITION BY d, region) AS share FROM g"""


def changed_between(spark: SparkSession, d: str) -> DataFrame:
    s = _order_spans(spark, d).withColumn("end_date", F.date_sub("next_start", 1))
    base, days = F.lit("1997-01-01").cast("date"), [F.lit("1997-06-30").cast("date"), F.lit("1996-06-30").cast("date")]
    parts = [s.where(temporal.changed_between(F.col("start_date"), F.col("end_date"), base, x)).groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(x.alias("d"), "status", "n") for x in days]
    return parts[0].unionByName(parts[1])


SQL["changed_between"] = """
WITH iv AS (SELECT o_orderpriority AS status, CAST(o_orderdate AS DATE) AS s, LEAD(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS e FROM orders)
SELECT DATE '1997-06-30' AS d, status, COUNT(*) AS n FROM iv WHERE s > DATE '1997-01-01' AND s <= DATE '1997-06-30' GROUP BY ALL
UNION ALL SELECT DATE '1996-06-30', status, COUNT(*) FROM iv WHERE e >= DATE '1996-06-30' AND e < DATE '1997-01-01' GROUP BY ALL"""


def membership_filter(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array_sort(F.collect_set("event_type"))
    lists = table(spark, d, "events").groupBy("user_id").agg(F.array_join(kinds, "|").alias("kinds"))
    member = F.array_contains(F.split("kinds", r"\|"), "click")
    kept = F.array_join(F.filter(F.split("kinds", r"\|"), lambda x: x != "click"), "|")
    return lists.where(member).select("user_id", "kinds", kept.alias("others"))


SQL["membership_filter"] = """
WITH l AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS k FROM events GROUP BY user_id)
SELECT user_id, array_to_string(k, '|') AS kinds, array_to_string(list_filter(k, lambda x: x <> 'click'), '|') AS others FROM l WHERE list_contains(k, 'click')"""


def rule_last_match(spark: SparkSession, d: str) -> DataFrame:
    b, t, s = F.col("p_brand"), F.col("p_type"), F.col("p_size")
    ordered = [(F.lit(True), "neutral"), (rules.glob(b, "Brand#1?|Brand#2*"), "allied"), (rules.glob(t, "*[A-M]*"), "axis"), (rules.prefix_or_equal(b, "Brand#3*|Brand#41"), "contested"), (s > 40, "neutral")]
    p = table(spark, d, "part").withColumn("bloc", rules.resolve([(c, F.lit(v)) for c, v in ordered], True, F.lit(None)))
    return p.groupBy("bloc").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"))


SQL["rule_last_match"] = """
SELECT CASE WHEN p_size > 40 THEN 'neutral' WHEN starts_with(p_brand, 'Brand#3') OR p_brand = 'Brand#41' THEN 'contested' WHEN regexp_matches(p_type, '[A-M]') THEN 'axis'
  WHEN regexp_full_match(p_brand, 'Brand#1.|Brand#2.*') THEN 'allied' ELSE 'neutral' END AS bloc, COUNT(*) AS n, CAST(SUM(p_partkey) AS BIGINT) AS keys FROM part GROUP BY 1"""


def rule_first_match(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    day = lambda s: F.lit(s).cast("date")
    ordered = [
        ((F.col("o_orderstatus") == "F") & (F.col("day") < day("1997-01-01")), "old"),
        (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("day").between(day("1996-06-01"), day("1999-12-31")), "fast"),
        (F.col("o_totalprice") > 200000, "large"), (F.col("o_orderstatus") == "O", "open"),
    ]
    return o.withColumn("layer", rules.resolve([(c, F.lit(v)) for c, v in ordered], False, F.lit("none"))).groupBy("layer").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("decimal(24,2)").alias("total"))


SQL["rule_first_match"] = """
SELECT CASE WHEN o_orderstatus = 'F' AND o_orderdate < DATE '1997-01-01' THEN 'old' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1999-12-31' THEN 'fast'
  WHEN o_totalprice > 200000 THEN 'large' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'none' END AS layer, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS total FROM orders GROUP BY 1"""


def rule_layered_veto(spark: SparkSession, d: str) -> DataFrame:
    k, n, b = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    overlay = F.when(k % 7 == 0, F.lit("overlay"))
    ordered = [(n < 15, F.lit("whole1"), True), (b < 0, F.lit("part1"), False), (n % 2 == 0, F.lit("whole2"), True), (b > 8000, F.lit("part2"), False)]
    c = table(spark, d, "customer").withColumn("control", rules.layered(ordered, F.col("c_mktsegment"), overlay))
    return c.groupBy("control").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


SQL["rule_layered_veto"] = """
WITH c AS (SELECT *, c_custkey % 7 = 0 AS ov FROM customer),
 x AS (SELECT *, CASE WHEN c_nationkey < 15 AND NOT ov THEN 1 END AS a, CASE WHEN c_acctbal < 0 THEN 2 END AS b, CASE WHEN c_nationkey % 2 = 0 AND (NOT ov OR c_acctbal < 0) THEN 3 END AS w, CASE WHEN c_acctbal > 8000 THEN 4 END AS p FROM c)
SELECT CASE greatest(coalesce(a,0), coalesce(b,0), coalesce(w,0), coalesce(p,0)) WHEN 1 THEN 'whole1' WHEN 2 THEN 'part1' WHEN 3 THEN 'whole2' WHEN 4 THEN 'part2' ELSE CASE WHEN ov THEN 'overlay' ELSE c_mktsegment END END AS control,
  COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys FROM x GROUP BY 1"""


def unmatched_rules(spark: SparkSession, d: str) -> DataFrame:
    listed = spark.createDataFrame([(1, "1995|1996|2030"), (2, "1999|2001"), (3, "1890")], "rule int, years string")
    o = table(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("day"), "o_orderstatus").distinct()
    hits = o.join(F.broadcast(spark.createDataFrame([(1, "F"), (2, "P"), (3, "O")], "rule int, s string")), F.col("o_orderstatus") == F.col("s")).select("rule", "day")
    return rules.unmatched(listed, hits, "rule", "years")


SQL["unmatched_rules"] = """
WITH r AS (SELECT rule, unnest(string_split(years, '|')) AS day, s FROM (VALUES (1, '1995|1996|2030', 'F'), (2, '1999|2001', 'P'), (3, '1890', 'O')) t(rule, years, s))
SELECT rule, day FROM r WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = s AND CAST(year(o_orderdate) AS VARCHAR) = day)"""


def geo_predicate(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    e = table(spark, d, "embeddings").where(rules.geo("box:-0.1,-0.1,0.05,0.2|circle:0.1,0.05,9", x, y))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("ids"))


SQL["geo_predicate"] = """
WITH e AS (SELECT *, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT label, COUNT(*) AS n, CAST(SUM(vec_id) AS BIGINT) AS ids FROM e WHERE (x BETWEEN -0.1 AND 0.05 AND y BETWEEN -0.1 AND 0.2)
  OR (x - 0.1) * (x - 0.1) + (y - 0.05) * (y - 0.05) <= pow(9 / 111.32 / cos(radians(0.05)), 2) GROUP BY label"""


def nearest_year(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n_orders"))
    years = spark.createDataFrame([(1996,), (1998,), (2000,)], "year int")
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")).join(F.broadcast(years))
    return temporal.nearest(wanted, known, "o_custkey", "year", "y", "n_orders", "n_nearest").groupBy("year", "n_nearest").agg(F.count(F.lit(1)).alias("n"))


SQL["nearest_year"] = """
WITH k AS (SELECT o_custkey, year(o_orderdate) AS y, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
 w AS (SELECT c_custkey, CAST(year AS INTEGER) AS year FROM customer, (VALUES (1996), (1998), (2000)) t(year)),
 j AS (SELECT w.c_custkey, w.year, k.n, row_number() OVER (PARTITION BY w.c_custkey, w.year ORDER BY abs(k.y - w.year), k.y) AS r FROM w LEFT JOIN k ON k.o_custkey = w.c_custkey)
SELECT year, n AS n_nearest, COUNT(*) AS n FROM j WHERE r = 1 GROUP BY ALL"""


def asof_bracket(spark: SparkSession, d: str) -> DataFrame:
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    daily = table(spark, d, "events").where("event_type = 'purchase'").groupBy("user_id", day.alias("day")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    days = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    grid = daily.select("user_id").distinct().join(F.broadcast(days)).select("user_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    full = temporal.bracket_fill(grid.join(daily, ["user_id", "day"], "left"), ["user_id"], "day", "v", "filled")
    return full.groupBy("day").agg(F.round(F.sum("filled"), 6).alias("total"), F.count("v").alias("known"))


SQL["asof_bracket"] = """
WITH e AS (SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day, CAST(COUNT(*) AS DOUBLE) AS v FROM events WHERE event_type = 'purchase' GROUP BY ALL),
 g AS (SELECT u.user_id, CAST(t.day AS INTEGER) AS day, e.v FROM (SELECT DISTINCT user_id FROM e) u CROSS JOIN (SELECT unnest(range(lo, hi + 1)) AS day FROM (SELECT min(day) AS lo, max(day) AS hi FROM e)) t LEFT JOIN e ON e.user_id = u.user_id AND e.day = t.day),
 b AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN day END IGNORE NULLS) OVER a AS pd, last_value(v IGNORE NULLS) OVER a AS pv, first_value(CASE WHEN v IS NOT NULL THEN day END IGNORE NULLS) OVER f AS nd, first_value(v IGNORE NULLS) OVER f AS nv FROM g
   WINDOW a AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT day, round(SUM(CASE WHEN pd IS NULL THEN nv WHEN nd IS NULL OR pd = nd THEN pv ELSE pv + (nv - pv) * (day - pd) / (nd - pd) END), 6) AS total, COUNT(v) AS known FROM b GROUP BY day"""


def loglinear_fill(spark: SparkSession, d: str) -> DataFrame:
    m = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1
    avg = table(spark, d, "orders").groupBy(m.alias("m")).agg((F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double") / F.count(F.lit(1))).alias("v"))
    holes = avg.withColumn("known", F.when(F.col("m") % 3 == 0, F.col("v"))).withColumn("all", F.lit(1))
    return temporal.bracket_fill(holes, ["all"], "m", "known", "filled", log=True).select("m", F.round("filled", 4).alias("filled"))


SQL["loglinear_fill"] = """
WITH a AS (SELECT (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS m, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / COUNT(*) AS v FROM orders GROUP BY 1),
 h AS (SELECT CAST(m AS INTEGER) AS m, CASE WHEN m % 3 = 0 THEN ln(v) END AS k FROM a),
 b AS (SELECT m, last_value(CASE WHEN k IS NOT NULL THEN m END IGNORE NULLS) OVER p AS pm, last_value(k IGNORE NULLS) OVER p AS pk, first_value(CASE WHEN k IS NOT NULL THEN m END IGNORE NULLS) OVER f AS nm, first_value(k IGNORE NULLS) OVER f AS nk FROM h
  WINDOW p AS (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT m, round(exp(CASE WHEN pm IS NULL THEN nk WHEN nm IS NULL OR pm = nm THEN pk ELSE pk + (nk - pk) * (m - pm) / (nm - pm) END), 4) AS filled FROM b"""
