"""Queries on sums, shares, allocation, calibration and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrane.functions import share
from terrane.operators import allocate, spatial
from terrane.sources import table

SQL: dict[str, str] = {}


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(14,2)")


def _net() -> Column:
    return _money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))


def star_view(spark: SparkSession, d: str) -> DataFrame:
    l, o, c, n, r = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.sum(_net()).cast("decimal(24,4)").alias("revenue"))


SQL["star_view"] = """
SELECT r_name, n_name, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(24,4)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


def anti_semi_orphans(spark: SparkSession, d: str) -> DataFrame:
    c, o, l = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "lineitem")
    idle = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"))
    used = o.join(l.where("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    served = c.join(used, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(F.lit("served").alias("kind"), F.col("c_custkey").alias("key"))
    return idle.unionByName(served)


SQL["anti_semi_orphans"] = """
SELECT 'customer' AS kind, c_custkey AS key FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT 'served', c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45))"""


def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum(F.col("c_acctbal").cast("decimal(12,2)")).alias("b"))
    j = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(c, "n_nationkey")
    return j.select("r_name", "n_name", F.round(share(F.col("b").cast("double"), F.sum("b").over(Window.partitionBy("r_name")).cast("double")), 9).alias("share"))


SQL["share_of_total"] = """
WITH c AS (SELECT c_nationkey, SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS b FROM customer GROUP BY 1)
SELECT r_name, n_name, round(CAST(b AS DOUBLE) / nullif(CAST(SUM(b) OVER (PARTITION BY r_name) AS DOUBLE), 0), 9) AS share FROM c JOIN nation ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey"""


def two_basis_rollup(spark: SparkSession, d: str) -> DataFrame:
    l, o, c, s = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "supplier"))
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    part = j.groupBy("c_nationkey", "s_nationkey").agg(F.sum("l_quantity").cast("decimal(20,0)").alias("q"))
    two = part.select("q", F.explode(F.create_map(F.lit("buyer"), F.col("c_nationkey"), F.lit("seller"), F.col("s_nationkey"))).alias("basis", "nation"))
    return two.groupBy("basis", "nation").agg(F.sum("q").cast("bigint").alias("quantity"))


SQL["two_basis_rollup"] = """
WITH j AS (SELECT c_nationkey, s_nationkey, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT 'buyer' AS basis, c_nationkey AS nation, CAST(SUM(q) AS BIGINT) AS quantity FROM j GROUP BY 2 UNION ALL SELECT 'seller', s_nationkey, CAST(SUM(q) AS BIGINT) FROM j GROUP BY 2"""


def dominant_category(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("v", _money("o_totalprice"))
    return allocate.dominant(o, ["c_nationkey"], "o_orderpriority", "v", "top_priority")


SQL["dominant_category"] = """
WITH s AS (SELECT c_nationkey, o_orderpriority, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_nationkey, o_orderpriority AS top_priority FROM s QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY v DESC, o_orderpriority) = 1"""


def median_ratio(spark: SparkSession, d: str) -> DataFrame:
    p, l = table(spark, d, "part"), table(spark, d, "lineitem")
    ratio = F.col("l_extendedprice") / (F.col("l_quantity") * F.col("p_retailprice"))
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.round(F.median(ratio), 9).alias("ratio"), F.count(F.lit(1)).alias("n"))


SQL["median_ratio"] = "SELECT strftime(l_shipdate, '%Y-%m') AS month, round(median(l_extendedprice / (l_quantity * p_retailprice)), 9) AS ratio, COUNT(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"


def pivot_bloc(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return p.select("year", *(F.coalesce(F.col(c), F.lit(0)).alias(f"n_{c.lower()}") for c in "FOP"))


SQL["pivot_bloc"] = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) FILTER (o_orderstatus = 'F') AS n_f, COUNT(*) FILTER (o_orderstatus = 'O') AS n_o, COUNT(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1"


def coverage(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), table(spark, d, "labels")
    g = docs.join(labels, "doc_id", "left").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("n_good"), F.count_if(F.col("toxic") == 1).alias("n_toxic"), F.sum("n_chars").alias("chars"))
    return g.select("source", "lang", "n", "n_good", "n_toxic", F.round(F.col("chars") / F.greatest(F.sum("chars").over(Window.partitionBy("source")), F.lit(1)), 9).alias("share"))


SQL["coverage"] = """
WITH g AS (SELECT source, lang, COUNT(*) AS n, COUNT(*) FILTER (quality = 1) AS n_good, COUNT(*) FILTER (toxic = 1) AS n_toxic, SUM(n_chars) AS c FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)
SELECT source, lang, n, n_good, n_toxic, round(c / greatest(SUM(c) OVER (PARTITION BY source), 1), 9) AS share FROM g"""


def concat_sorted(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ";").alias("kinds"), F.max("value").alias("hi"), F.min("value").alias("lo"))
    return e.where(F.col("hi") > F.col("lo") * 1.02 + 1).select("user_id", "kinds")


SQL["concat_sorted"] = "SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS kinds FROM events GROUP BY user_id HAVING max(value) > min(value) * 1.02 + 1"


def block_downsample(spark: SparkSession, d: str) -> DataFrame:
    gx, gy = F.floor(F.col("l_quantity") / 5).cast("bigint"), F.floor(F.col("l_discount").cast("decimal(4,2)") / F.lit(0.03).cast("decimal(4,2)")).cast("bigint")
    return table(spark, d, "lineitem").groupBy(gx.alias("gx"), gy.alias("gy")).agg(F.count(F.lit(1)).alias("cells"), F.sum("l_quantity").cast("bigint").alias("quantity"))


SQL["block_downsample"] = "SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS gx, CAST(floor(CAST(round(l_discount * 100) AS INTEGER) / 3) AS BIGINT) AS gy, COUNT(*) AS cells, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2"


def zonal_two_level(spark: SparkSession, d: str) -> DataFrame:
    l, p, s = table(spark, d, "lineitem"), table(spark, d, "part"), table(spark, d, "supplier")
    cells = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("nation"), F.col("p_size").alias("size"), F.col("l_quantity").cast("bigint").alias("q"))
    zones = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")).join(F.broadcast(spark.range(1, 51).select(F.col("id").cast("int").alias("size"))))
    return spatial.zonal_two_level(cells, zones, ["nation", "size"], "q", "quantity")


SQL["zonal_two_level"] = """
WITH c AS (SELECT s_nationkey AS nation, p_size AS size, CAST(SUM(l_quantity) AS BIGINT) AS q FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT n_nationkey AS nation, CAST(r.size AS INTEGER) AS size, coalesce(q, 0) AS quantity FROM nation CROSS JOIN range(1, 51) r(size) LEFT JOIN c ON c.nation = n_nationkey AND c.size = r.size"""


def calibrate_national(spark: SparkSession, d: str) -> DataFrame:
    l, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    cells = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    targets = s.groupBy("s_nationkey").agg(F.sum(F.col("s_acctbal").cast("decimal(12,2)")).cast("double").alias("target"))
    return allocate.calibrate(cells, targets, "s_nationkey", "q", "target", "value").select("s_nationkey", "l_returnflag", F.round("value", 4).alias("value"))


SQL["calibrate_national"] = """
WITH c AS (SELECT s_nationkey, l_returnflag, SUM(l_quantity) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
 t AS (SELECT s_nationkey, CAST(SUM(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS target FROM supplier GROUP BY 1)
SELECT s_nationkey, l_returnflag, round(q * target / SUM(q) OVER (PARTITION BY s_nationkey), 4) AS value FROM c JOIN t USING (s_nationkey)"""


def calibrate_subnational(spark: SparkSession, d: str) -> DataFrame:
    p, l = table(spark, d, "part"), table(spark, d, "lineitem")
    cells = l.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_returnflag", "p_brand").agg(F.sum("l_quantity").alias("q"))
    targets = cells.where(F.substring("p_brand", 7, 1).isin("1", "2")).select("l_returnflag", "p_brand", (F.substring("p_brand", 7, 1).cast("double") + 1).alias("t"))
    return allocate.calibrate_covered(cells, targets, "l_returnflag", "p_brand", "q", "t", "value").select("l_returnflag", "p_brand", F.round("value", 4).alias("value"))


SQL["calibrate_subnational"] = """
WITH c AS (SELECT l_returnflag, p_brand, SUM(l_quantity) AS q, CASE WHEN substr(p_brand, 7, 1) IN ('1', '2') THEN CAST(substr(p_brand, 7, 1) AS DOUBLE) + 1 END AS t FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT l_returnflag, p_brand, round(CASE WHEN t IS NULL THEN q ELSE t / SUM(t) OVER w * SUM(CASE WHEN t IS NOT NULL THEN q END) OVER w END, 4) AS value FROM c WINDOW w AS (PARTITION BY l_returnflag)"""


def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", F.greatest(F.round(F.col("c_acctbal") * 100).cast("bigint"), F.lit(0)).cast("double").alias("w"), F.lit(1000).alias("budget"), F.lit(1.0).alias("even"))
    return allocate.largest_remainder(c, ["c_nationkey"], "w", "budget", ["c_custkey"], "seats", "even").select("c_nationkey", "c_custkey", "seats")


SQL["largest_remainder"] = """
WITH c AS (SELECT c_nationkey, c_custkey, CAST(greatest(CAST(round(c_acctbal * 100) AS BIGINT), 0) AS DOUBLE) AS w FROM customer),
 x AS (SELECT *, 1000 * w / SUM(w) OVER (PARTITION BY c_nationkey) AS e FROM c),
 f AS (SELECT *, floor(e) AS lo, 1000 - SUM(floor(e)) OVER (PARTITION BY c_nationkey) AS rest, row_number() OVER (PARTITION BY c_nationkey ORDER BY e - floor(e) DESC, c_custkey) AS r FROM x)
SELECT c_nationkey, c_custkey, CAST(lo + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS seats FROM f"""


def running_cap(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey", F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("want"))
    return allocate.running_cap(o, ["day"], ["o_orderkey"], "want", F.lit(500), "got").groupBy("day").agg(F.sum("got").alias("got"), F.count_if(F.col("got") < F.col("want")).alias("cut"))


SQL["running_cap"] = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS want FROM orders),
 x AS (SELECT *, greatest(0, least(want, 500 - coalesce(SUM(want) OVER (PARTITION BY day ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS got FROM o)
SELECT day, CAST(SUM(got) AS BIGINT) AS got, COUNT(*) FILTER (got < want) AS cut FROM x GROUP BY day"""


def top_composition(spark: SparkSession, d: str) -> DataFrame:
    l, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    q = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey", "l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    top = q.withColumn("r", F.row_number().over(Window.partitionBy("s_nationkey").orderBy(F.desc("q"), "l_partkey"))).where("r <= 12")
    return top.groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "l_partkey"))), lambda x: x["l_partkey"].cast("string")), ",").alias("parts"))


SQL["top_composition"] = """
WITH q AS (SELECT s_nationkey, l_partkey, SUM(l_quantity) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY q DESC, l_partkey) AS r FROM q)
SELECT s_nationkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY r) AS parts FROM r WHERE r <= 12 GROUP BY 1"""


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("p_size").cast("double"), F.floor(F.col("p_retailprice") / 40).cast("double")
    return table(spark, d, "part").select("p_partkey", x.alias("x1"), y.alias("y1"), (x + F.col("p_partkey") % 4).alias("x2"), (y + F.col("p_partkey") % 3).alias("y2"))


_BOXES = "b AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x1, floor(p_retailprice / 40) AS y1, p_size + p_partkey % 4 AS x2, floor(p_retailprice / 40) + p_partkey % 3 AS y2 FROM part)"


def paint_smallest(spark: SparkSession, d: str) -> DataFrame:
    area = (F.col("x2") - F.col("x1") + 1) * (F.col("y2") - F.col("y1") + 1)
    return spatial.paint(_boxes(spark, d), 1.0, [area.alias("a"), F.col("p_partkey")], "p_partkey")


SQL["paint_smallest"] = f"""
WITH {_BOXES}, c AS (SELECT p_partkey, (x2 - x1 + 1) * (y2 - y1 + 1) AS a, gx, unnest(range(CAST(y1 AS BIGINT), CAST(y2 AS BIGINT) + 1)) AS gy FROM (SELECT *, unnest(range(CAST(x1 AS BIGINT), CAST(x2 AS BIGINT) + 1)) AS gx FROM b))
SELECT gx, gy, p_partkey FROM c QUALIFY row_number() OVER (PARTITION BY gx, gy ORDER BY a, p_partkey) = 1"""


def cell_join(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "lineitem").select(F.col("l_quantity").alias("px"), F.floor(F.col("l_extendedprice") / 1000).alias("py"))
    return spatial.points_per_box(points, _boxes(spark, d), "p_partkey", "px", "py", 4.0)


SQL["cell_join"] = f"WITH {_BOXES} SELECT p_partkey, COUNT(*) AS n FROM lineitem JOIN b ON l_quantity BETWEEN x1 AND x2 AND floor(l_extendedprice / 1000) BETWEEN y1 AND y2 GROUP BY 1"


def adjacency(spark: SparkSession, d: str) -> DataFrame:
    return spatial.adjacency(spatial.cover(_boxes(spark, d), 2.0), "p_partkey")


SQL["adjacency"] = f"""
WITH {_BOXES}, c AS (SELECT DISTINCT p_partkey, gx, unnest(range(CAST(floor(y1 / 2) AS BIGINT), CAST(floor(y2 / 2) AS BIGINT) + 1)) AS gy FROM (SELECT *, unnest(range(CAST(floor(x1 / 2) AS BIGINT), CAST(floor(x2 / 2) AS BIGINT) + 1)) AS gx FROM b))
SELECT DISTINCT p.p_partkey AS a, q.p_partkey AS b FROM c p JOIN c q USING (gx, gy) WHERE p.p_partkey < q.p_partkey"""



def distance_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return spatial.pairs_within(e, "vec_id", "x", "y", 0.01).select("a", "b")


SQL["distance_pairs"] = """
WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT p.vec_id AS a, q.vec_id AS b FROM e p JOIN e q ON p.vec_id < q.vec_id AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 0.01 * 0.01"""


def turn_tally(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).cast("decimal(20,2)").alias("balance"), F.countDistinct("c_mktsegment").alias("segments"))


SQL["turn_tally"] = "SELECT c_nationkey, COUNT(*) AS n, COUNT(*) FILTER (c_acctbal < 0) AS in_debt, CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(20,2)) AS balance, COUNT(DISTINCT c_mktsegment) AS segments FROM customer GROUP BY 1"


def conflict_pairs(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    a = n.select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("ra"))
    b = n.select(F.col("n_nationkey").alias("b"), F.col("n_regionkey").alias("rb"))
    same = a.join(b, F.col("ra") == F.col("rb")).where("a < b").select("a", "b", F.lit("peace").alias("state"))
    war = a.join(b, (F.col("ra") + 1) == F.col("rb")).where("(a + b) % 3 = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit("war").alias("state"))
    return same.unionByName(war)


SQL["conflict_pairs"] = """
SELECT p.n_nationkey AS a, q.n_nationkey AS b, 'peace' AS state FROM nation p JOIN nation q ON p.n_regionkey = q.n_regionkey AND p.n_nationkey < q.n_nationkey
UNION ALL SELECT least(p.n_nationkey, q.n_nationkey), greatest(p.n_nationkey, q.n_nationkey), 'war' FROM nation p JOIN nation q ON p.n_regionkey + 1 = q.n_regionkey WHERE (p.n_nationkey + q.n_nationkey) % 3 = 0"""


def conservation_checks(spark: SparkSession, d: str) -> DataFrame:
    l, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    by = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey").agg(F.sum("l_quantity").alias("q"))
    whole = l.agg(F.sum("l_quantity").alias("w"))
    return by.agg(F.sum("q").alias("q"), F.count_if(F.col("q") < 0).alias("negative")).crossJoin(whole).select(F.abs(F.col("q") - F.col("w")).alias("gap"), "negative")


SQL["conservation_checks"] = "SELECT abs(SUM(q) - (SELECT SUM(l_quantity) FROM lineitem)) AS gap, COUNT(*) FILTER (q < 0) AS negative FROM (SELECT s_nationkey, SUM(l_quantity) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)"
