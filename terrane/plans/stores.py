"""Queries that write to the shared folder and read back: dated tables, cascades, documents, files, outlines, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane import sources
from terrane.sources import store, table

SQL: dict[str, str] = {}


def rebuilt_dates(spark: SparkSession, d: str) -> DataFrame:
    """Orders by year, two years rebuilt twice with doubled prices; appended to another table in two halves."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path, other = store.shared_dir(spark, "by-year"), store.shared_dir(spark, "appended")
    store.rebuild(o, path, "year")
    for _ in range(2):
        store.rebuild(o.where("year in (1996, 1999)").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, "year")
    for half in (0, 1):
        store.append(o.where(f"o_orderkey % 2 = {half}").select("year", "o_orderkey", "o_totalprice"), other)
    sums = lambda t, how: t.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("how", F.lit(how))
    return sums(spark.read.parquet(path), "rebuilt").unionByName(sums(spark.read.parquet(other), "appended"))


SQL["rebuilt_dates"] = """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS p FROM orders)
SELECT year, COUNT(*) AS n, round(SUM(CASE WHEN year IN (1996, 1999) THEN p * 2 ELSE p END), 2) AS total, 'rebuilt' AS how FROM o GROUP BY year UNION ALL SELECT year, COUNT(*), round(SUM(p), 2), 'appended' FROM o GROUP BY year"""


def orphan_cascade(spark: SparkSession, d: str) -> DataFrame:
    """What is left of lines, parts, suppliers and nations when the lines shipped before 2001 go."""
    l = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    tables = {"lineitem": l, "part": table(spark, d, "part"), "supplier": table(spark, d, "supplier"), "nation": table(spark, d, "nation")}
    left = store.drop_dates(tables, list(range(1990, 2001)), "year", ["lineitem"], [("part", "p_partkey", "lineitem", "l_partkey"), ("supplier", "s_suppkey", "lineitem", "l_suppkey"), ("nation", "n_nationkey", "supplier", "s_nationkey")])
    keys = {"part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey", "lineitem": "l_orderkey"}
    out = None
    for name, key in keys.items():
        part = left[name].agg(F.lit(name).alias("kind"), F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("long")).alias("keys"))
        out = part if out is None else out.unionByName(part)
    return out


SQL["orphan_cascade"] = """
WITH l AS (SELECT * FROM lineitem WHERE year(l_shipdate) > 2000), s AS (SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM l))
SELECT 'lineitem' AS kind, COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS keys FROM l UNION ALL SELECT 'part', COUNT(*), CAST(SUM(p_partkey) AS BIGINT) FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)
UNION ALL SELECT 'supplier', COUNT(*), CAST(SUM(s_suppkey) AS BIGINT) FROM s UNION ALL SELECT 'nation', COUNT(*), CAST(SUM(n_nationkey) AS BIGINT) FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM s)"""


def year_documents(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document a year and nation, written by year, read back and taken apart."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = o.groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    docs = g.select("year", F.to_json(F.struct("nation", F.struct("n", F.round("top", 2).alias("top")).alias("facts"))).alias("doc"))
    path = store.shared_dir(spark, "documents")
    store.write_documents(docs, path, "year", "doc")
    back = spark.read.text(path).select("year", F.from_json("value", "nation int, facts struct<n: long, top: double>").alias("j"))
    return back.select(F.col("year").cast("int").alias("year"), "j.nation", "j.facts.n", "j.facts.top")


SQL["year_documents"] = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS nation, COUNT(*) AS n, round(max(o_totalprice), 2) AS top FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


def gzip_files(spark: SparkSession, d: str) -> DataFrame:
    """Texts packed without a time, half of them left plain, and unpacked by what they begin with; equal data, equal bytes."""
    docs = table(spark, d, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw"))
    packed = docs.withColumn("data", F.when(F.col("doc_id") % 2 == 0, store.gzipped("raw")).otherwise(F.col("raw"))).withColumn("again", store.gzipped("raw"))
    return packed.select("doc_id", F.md5(store.plain("data")).alias("md5"), ((F.col("doc_id") % 2 == 1) | (F.col("data") == F.col("again"))).alias("steady"))


SQL["gzip_files"] = "SELECT doc_id, md5(coalesce(text, '')) AS md5, true AS steady FROM documents"


def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Parts written as CSV with and without a header, and read back with declared columns; as text, null is empty."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_name")).alias("p_name"), "p_retailprice")
    headed, bare = store.shared_dir(spark, "csv"), store.shared_dir(spark, "csv")
    p.write.option("header", True).csv(headed)
    p.write.csv(bare)
    schema = "p_partkey long, p_name string, p_retailprice double"
    a = sources.csv(spark, headed, schema, as_text=True).withColumn("how", F.lit("header"))
    b = sources.csv(spark, bare, schema, header=False).withColumn("how", F.lit("names"))
    return a.unionByName(b)


SQL["csv_scan"] = """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_name END AS p_name, p_retailprice FROM part)
SELECT p_partkey, coalesce(p_name, '') AS p_name, p_retailprice, 'header' AS how FROM p UNION ALL SELECT p_partkey, p_name, p_retailprice, 'names' FROM p"""


def geojson_scan(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as squares in a feature collection, one of two parts, read back as polygons."""
    s = table(spark, d, "supplier")
    ring = lambda x, y: F.concat(F.lit("[["), *[v for i, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))) for v in ((F.lit("],[") if i else F.lit("")), (x + dx).cast("string"), F.lit(","), (y + dy).cast("string"))], F.lit("]]"))
    x, y = F.col("s_suppkey") % 100, F.col("s_nationkey")
    one = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(x, y), F.lit("]}"))
    two = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring(x, y), F.lit("],["), ring(x + 5, y), F.lit("]]}"))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"key":'), F.col("s_suppkey").cast("string"), F.lit(',"name":"'), F.col("s_name"), F.lit('"},"geometry":'), F.when(F.col("s_suppkey") % 3 == 0, two).otherwise(one), F.lit("}"))
    path = store.shared_dir(spark, "geojson")
    files = s.groupBy("s_nationkey").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))
    files.select("value").repartition(8).write.option("lineSep", "\n").text(path)
    back = sources.geojson_lines(spark, path, "key: bigint, name: string")
    first = lambda i: F.get(F.get(F.get(F.get("polygons", F.lit(0)), F.lit(0)), F.lit(2)), F.lit(i))
    return back.select("key", "name", F.size("polygons").alias("parts"), first(0).alias("x"), first(1).alias("y"))


SQL["geojson_scan"] = "SELECT s_suppkey AS key, s_name AS name, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS parts, CAST(s_suppkey % 100 + 1 AS DOUBLE) AS x, CAST(s_nationkey + 1 AS DOUBLE) AS y FROM supplier"


def dated_areas(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines of areas with levels and partial dates, those of two levels in force on two days."""
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    tags = F.create_map(F.lit("admin_level"), (F.col("o_orderkey") % 5 + 3).cast("string"), F.lit("start_date"), F.when(F.col("o_orderkey") % 4 != 0, F.substring(day, 1, 7)), F.lit("end_date"), F.when(F.col("o_orderkey") % 3 != 0, F.substring(day, 1, 4)), F.lit("name"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")))
    lines = o.select(F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.map_filter(tags, lambda k, v: v.isNotNull()).alias("tags"), F.hex(F.encode(F.col("o_orderstatus"), "UTF-8")).alias("wkb"))).alias("value"))
    path = store.shared_dir(spark, "areas")
    lines.write.text(path)
    found = store.dated_areas(spark, path, ["4", "6"], ["1997-06-01", "1999-02-15"])
    return found.select("id", "name", "level", "start", "stop", F.decode("wkb", "UTF-8").alias("status"))


SQL["dated_areas"] = """
WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'relation ' || o_orderkey END AS name, CAST(o_orderkey % 5 + 3 AS VARCHAR) AS level,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS start, CASE WHEN o_orderkey % 3 <> 0 THEN make_date(year(o_orderdate), 12, 31) END AS stop, o_orderstatus AS status FROM orders)
SELECT * FROM o WHERE level IN ('4', '6') AND (((start IS NULL OR start <= DATE '1997-06-01') AND (stop IS NULL OR stop >= DATE '1997-06-01')) OR ((start IS NULL OR start <= DATE '1999-02-15') AND (stop IS NULL OR stop >= DATE '1999-02-15')))"""


def outline_store(spark: SparkSession, d: str) -> DataFrame:
    """A store of outlines of which some keys are read; the filter reaches the scan."""
    path = store.shared_dir(spark, "outlines")
    table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.encode("p_name", "UTF-8").alias("wkb")).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    return store.outlines(spark, path, "id", [1, 7, 30, 99, 150]).select("id", F.decode("wkb", "UTF-8").alias("name"))


SQL["outline_store"] = "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey IN (1, 7, 30, 99, 150)"


def inherited_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """A base date's customers with the date's own rows over them, and rows that only the date has."""
    c = table(spark, d, "customer")
    base = c.where("c_custkey % 3 <> 0").select("c_custkey", "c_mktsegment", "c_acctbal")
    own = c.where("c_custkey % 5 = 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).alias("c_mktsegment"), (F.col("c_acctbal") * 2).alias("c_acctbal"))
    return store.inherited(base, own, "c_custkey")


SQL["inherited_snapshot"] = """
SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) END AS c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 5 = 0 THEN 'own' ELSE 'base' END AS source FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 = 0"""


def appended_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of segments, grown by priorities and names of regions, and stripped back to its mark."""
    c, o, r = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "region")
    empty = spark.createDataFrame([], "n long, value string")
    base = store.Appended.append(empty, c.select(F.col("c_mktsegment").alias("value")))
    mark = store.Appended.record(base)
    grown = store.Appended.append(base, o.select(F.col("o_orderpriority").alias("value")).unionByName(r.select(F.col("r_name").alias("value"))))
    return grown.withColumn("state", F.lit("grown")).unionByName(store.Appended.strip(grown, mark).withColumn("state", F.lit("stripped")))


SQL["appended_dictionary"] = """
WITH a AS (SELECT DISTINCT c_mktsegment AS v FROM customer), b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n FROM a),
 x AS (SELECT o_orderpriority AS v FROM orders UNION SELECT r_name FROM region), c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 + (SELECT COUNT(*) FROM a) AS n FROM x WHERE v NOT IN (SELECT v FROM a))
SELECT n, v AS value, 'grown' AS state FROM b UNION ALL SELECT n, v, 'grown' FROM c UNION ALL SELECT n, v, 'stripped' FROM b"""


def publish_batches(spark: SparkSession, d: str) -> DataFrame:
    """Nations as files to publish: batches of at most 900, two files and all removals in the last."""
    n = F.col("n_nationkey")
    changed = table(spark, d, "nation").select(n.alias("position"), F.concat(F.lit("f"), F.lpad(n.cast("string"), 2, "0")).alias("path"), (n * 97 % 400 + 50).cast("long").alias("size"), (n % 6 == 4).alias("gone"))
    return store.publish_batches(changed, 900, ["f08", "f01"])


SQL["publish_batches"] = """
WITH RECURSIVE f AS (SELECT n_nationkey AS k, 'f' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS path, n_nationkey * 97 % 400 + 50 AS size, n_nationkey % 6 = 4 AS gone FROM nation),
 a AS (SELECT *, row_number() OVER (ORDER BY k) AS i FROM f WHERE NOT gone AND path NOT IN ('f08', 'f01')),
 b AS (SELECT i, path, size, 0 AS batch, size AS held FROM a WHERE i = 1 UNION ALL SELECT a.i, a.path, a.size, CASE WHEN held + a.size > 900 THEN batch + 1 ELSE batch END, CASE WHEN held + a.size > 900 THEN a.size ELSE held + a.size END FROM b JOIN a ON a.i = b.i + 1),
 t AS (SELECT path, size, CASE path WHEN 'f08' THEN 0 ELSE 1 END AS o FROM f WHERE path IN ('f08', 'f01')),
 l AS (SELECT batch, held FROM b ORDER BY i DESC LIMIT 1), z AS (SELECT CASE WHEN held + (SELECT SUM(size) FROM t) <= 900 THEN batch ELSE batch + 1 END AS tail FROM l),
 r AS (SELECT batch, path, size, 0 AS g, i AS o FROM b UNION ALL SELECT tail, path, size, 1, o FROM t, z UNION ALL SELECT tail, path, NULL, 2, k FROM f, z WHERE gone)
SELECT CAST(batch AS INTEGER) AS batch, CAST(row_number() OVER (ORDER BY batch, g, o) - 1 AS INTEGER) AS position, path, CAST(size AS BIGINT) AS size FROM r"""


def outline_stream(spark: SparkSession, d: str) -> DataFrame:
    """Parts' outlines as squares, some with a hole or a second or tiny part, written as streams and read back."""
    # a small file is few tasks, but its outlines are much work
    p = table(spark, d, "part").select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    x, y = F.col("p_partkey") % 90 / 7, F.col("p_size") / 3
    square = lambda x, y, a: F.array(*[F.array((x + dx * a).cast("double"), (y + dy * a).cast("double")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    none = F.array().cast("array<array<array<double>>>")
    units = F.concat(F.array(F.concat(F.array(square(x, y, 2.0)), F.when(F.col("p_size") % 2 == 0, F.array(square(x + 0.5, y + 0.5, 0.5))).otherwise(none))), F.when(F.col("p_size") % 3 == 0, F.array(F.array(square(x + 5, y, 1.0)))).otherwise(F.array().cast("array<array<array<array<double>>>>")), F.array(F.array(square(x + 9, y, 0.0001))))
    streams = p.select("p_partkey", store.encode_outlines(0.01)(units).alias("data"))
    return store.decode_outlines(streams, "p_partkey", "data").select("p_partkey", "part", "ring", "point", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


SQL["outline_stream"] = """
WITH p AS (SELECT p_partkey, CAST(p_partkey % 90 AS DOUBLE) / 7 AS x, CAST(p_size AS DOUBLE) / 3 AS y, p_size FROM part),
 r AS (SELECT p_partkey, 0 AS part, 0 AS ring, x, y, 2.0 AS a FROM p UNION ALL SELECT p_partkey, 0, 1, x + 0.5, y + 0.5, 0.5 FROM p WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 1, 0, x + 5, y, 1.0 FROM p WHERE p_size % 3 = 0)
SELECT p_partkey, CAST(part AS INTEGER) AS part, CAST(ring AS INTEGER) AS ring, CAST(point AS INTEGER) AS point, round(round_even((x + a * dx) * 1000, 0) / 1000, 3) AS x, round(round_even((y + a * dy) * 1000, 0) / 1000, 3) AS y
FROM r, (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) q(point, dx, dy)"""
