"""Queries on column functions: dates, places, codes, colours, random numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane import functions as fn
from terrane.sources import table

SQL: dict[str, str] = {}


def date_functions(spark: SparkSession, d: str) -> DataFrame:
    """Whole, partial and open dates, the day of a yearly picture, and dates kept as integers."""
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    partial = F.substring(F.concat(F.when(F.col("o_orderkey") % 5 == 0, "~").otherwise(""), day), F.lit(1), (F.lit(4) + F.col("o_orderkey") % 3 * 3 + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)).cast("int"))
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int") + F.when(F.col("o_orderkey") % 7 == 0, 5000).otherwise(0)
    return o.select("o_orderkey", fn.fuzzy_date(partial).alias("since"), fn.fuzzy_date(partial, end=True).alias("until"), fn.snapshot_date(F.year("o_orderdate")).alias("picture"), fn.int_date(number).alias("iso"))


SQL["date_functions"] = """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS t FROM orders)
SELECT k AS o_orderkey, CAST(date_trunc(CASE k % 3 WHEN 0 THEN 'year' WHEN 1 THEN 'month' ELSE 'day' END, t) AS DATE) AS since,
  CASE k % 3 WHEN 0 THEN make_date(year(t), 12, 31) WHEN 1 THEN last_day(t) ELSE t END AS until, make_date(year(t), 7, 1) AS picture,
  CASE WHEN k % 7 <> 0 THEN strftime(t, '%Y-%m-%d') END AS iso FROM o"""


def place_functions(spark: SparkSession, d: str) -> DataFrame:
    """Distances, areas and a conic projection, at places made of the first components of embeddings."""
    x, y = (F.get("embedding", i).cast("double") for i in (0, 1))
    lon, lat = x * 170, y * 80
    east, north = fn.lambert(lon, lat, 0.77)
    return table(spark, d, "embeddings").select(
        "vec_id", F.round(fn.planar_km(lon, lat, F.lit(5.0), F.lit(50.0)), 5).alias("km"), F.round(fn.haversine_km(lon, lat, F.lit(5.0), F.lit(50.0)), 5).alias("arc_km"),
        F.round(fn.planar_km2(x * x, lat), 5).alias("km2"), F.round(fn.cell_km2(F.pmod("vec_id", F.lit(2160)), 1 / 12), 6).alias("cell_km2"), F.round(east, 8).alias("east"), F.round(north, 8).alias("north"),
    )


SQL["place_functions"] = """
WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[1] AS DOUBLE) * 170 AS lon, CAST(embedding[2] AS DOUBLE) * 80 AS lat FROM embeddings),
 r AS (SELECT *, 1 / pow(tan(pi() / 4 + radians(lat) / 2), 0.77) AS rho, radians(lon - 5) * 0.77 AS turn, 90 - (vec_id % 2160) / 12.0 AS top FROM e)
SELECT vec_id, round(sqrt(pow((lon - 5) * 111.32 * cos(radians(50)), 2) + pow((lat - 50) * 110.57, 2)), 5) AS km,
  round(2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(50 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(50)) * pow(sin(radians(5 - lon) / 2), 2)))), 5) AS arc_km,
  round(x * x * 111.32 * 111.32 * cos(radians(lat)), 5) AS km2, round(6371.0088 * 6371.0088 * radians(CAST(1 AS DOUBLE) / 12) * (sin(radians(CAST(top AS DOUBLE))) - sin(radians(CAST(top AS DOUBLE) - CAST(1 AS DOUBLE) / 12))), 6) AS cell_km2,
  round(rho * sin(turn), 8) AS east, round(-rho * cos(turn), 8) AS north FROM r"""


def name_functions(spark: SparkSession, d: str) -> DataFrame:
    """Names normalised and split, codes folded, ideographs told from other letters, byte sums."""
    p = table(spark, d, "part")
    mixed = F.concat(F.lit("Émile Œ-Ñandú "), "p_name")
    sign = F.when(F.col("p_size") % 3 == 0, "中华").when(F.col("p_size") % 3 == 1, "中华x").otherwise("")
    code = F.when(F.col("p_size") % 4 == 0, F.lit("-99")).otherwise(F.col("p_brand"))
    return p.select(
        "p_partkey", fn.normal_name(mixed).alias("norm"), fn.camel_split(F.concat(F.initcap("p_name"), F.initcap("p_type"))).alias("split"), fn.only_cjk(F.concat(F.lit(" "), sign)).alias("cjk"),
        fn.fold(code, {"Brand#11": "B1", "SMALL": "S1"}, F.split_part("p_type", F.lit(" "), F.lit(1))).alias("code"), fn.byte_sum(F.encode("p_name", "UTF-8")).alias("byte_sum"),
    )


SQL["name_functions"] = """
SELECT p_partkey, regexp_replace(lower('Emile -Nandu ' || p_name), '[^a-z]', '', 'g') AS norm,
  regexp_replace(list_aggregate([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], 'string_agg', ' ') || list_aggregate([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_type, ' ')], 'string_agg', ' '), '([a-z])([A-Z])', '\\1 \\2', 'g') AS split,
  CASE WHEN p_size % 3 = 0 THEN '中华' END AS cjk,
  CASE WHEN p_size % 4 = 0 THEN (CASE split_part(p_type, ' ', 1) WHEN 'SMALL' THEN 'S1' ELSE split_part(p_type, ' ', 1) END) WHEN p_brand = 'Brand#11' THEN 'B1' ELSE p_brand END AS code,
  CAST(list_sum([ord(c) FOR c IN string_split(p_name, '')]) AS BIGINT) AS byte_sum FROM part""".replace("\\\\", "\\")


#: Heights and the red, green and blue of their tint.
TINTS = [(-500, 214, 226, 196), (0, 218, 229, 199), (150, 226, 232, 203), (400, 236, 235, 208), (800, 238, 230, 196), (1300, 230, 214, 172)]


def colour_functions(spark: SparkSession, d: str) -> DataFrame:
    """A colour from a hash, a tint by height."""
    p = table(spark, d, "part")
    height = F.col("p_retailprice") - 600
    tint = [F.round(fn.ramp(height, [(t[0], t[i]) for t in TINTS]), 6).alias(n) for i, n in enumerate("rgb", 1)]
    return p.select("p_partkey", fn.hash_colour(F.col("p_partkey").cast("string")).alias("colour"), *tint)


_RAMP = "CASE WHEN z <= -500 THEN {0} " + " ".join("WHEN z <= %d THEN {%d} + (z - (%d)) * ({%d} - {%d}) / CAST(%d AS DOUBLE)" % (b[0], i, a[0], i + 1, i, b[0] - a[0]) for i, (a, b) in enumerate(zip(TINTS, TINTS[1:]))) + " ELSE {5} END"
SQL["colour_functions"] = f"""
WITH h AS (SELECT p_partkey, p_retailprice - 600 AS z, CAST(('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS BIGINT) AS h FROM part),
 l AS (SELECT *, (h % 360) / CAST(360 AS DOUBLE) AS hue, CAST(0.55 AS DOUBLE) + ((h >> 9) % 12) / CAST(100 AS DOUBLE) AS li, CAST(0.35 AS DOUBLE) + ((h >> 13) % 20) / CAST(100 AS DOUBLE) AS sa FROM h),
 m AS (SELECT *, li + sa - li * sa AS m2, 2 * li - (li + sa - li * sa) AS m1 FROM l),
 c AS (SELECT *, [CASE WHEN t < 1 / CAST(6 AS DOUBLE) THEN m1 + (m2 - m1) * 6 * t WHEN t < 0.5 THEN m2 WHEN t < 2 / CAST(3 AS DOUBLE) THEN m1 + (m2 - m1) * (2 / CAST(3 AS DOUBLE) - t) * 6 ELSE m1 END
   FOR t IN [x - floor(x) FOR x IN [hue + 1 / CAST(3 AS DOUBLE), hue, hue - 1 / CAST(3 AS DOUBLE)]]] AS rgb FROM m)
SELECT p_partkey, '#' || array_to_string([format('{{:02x}}', CAST(round_even(v * 255, 0) AS INTEGER)) FOR v IN rgb], '') AS colour,
  {", ".join(f"round({_RAMP.format(*[t[i] for t in TINTS])}, 6) AS {n}" for i, n in enumerate("rgb", 1))} FROM c"""


def random_functions(spark: SparkSession, d: str) -> DataFrame:
    """Seeded numbers, keys of pairs, clamped values and a root that compresses."""
    n = table(spark, d, "supplier")
    state, number = fn.random_step(F.col("s_suppkey") * 2654435761 % 4294967296)
    again, second = fn.random_step(state)
    return n.select(
        "s_suppkey", state.alias("state"), F.round(number, 9).alias("number"), again.alias("state2"), F.round(second, 9).alias("number2"), fn.pair_key(F.col("s_suppkey") % 4096, F.col("s_nationkey").cast("long")).alias("pair"),
        fn.clamp(F.col("s_acctbal") / 1000, -0.5, 4.0).alias("held"), F.round(F.pow(F.greatest(F.col("s_acctbal"), F.lit(1.0)) / 1000, F.lit(0.4)), 9).alias("quality"),
    )


def _rng(seed: str) -> tuple[str, str]:
    """The generator in 128-bit integers, whose products can't overflow."""
    low = lambda x: f"(({x}) & 4294967295)"
    mul = lambda a, b: f"((CAST({a} AS HUGEINT) * CAST({b} AS HUGEINT)) % 4294967296)"
    s = low(f"CAST({seed} AS BIGINT) + 1831565813")
    return s, mul(f"xor({s}, {s} >> 15)", f"({s} | 1)")


SQL["random_functions"] = f"""
WITH s0 AS (SELECT *, (s_suppkey * 2654435761) % 4294967296 AS seed FROM supplier),
 s1 AS (SELECT *, {_rng("seed")[0]} AS a, CAST({_rng("seed")[1]} AS BIGINT) AS t FROM s0),
 s2 AS (SELECT *, xor(t, CAST((t + (CAST(xor(t, t >> 7) AS HUGEINT) * CAST((t | 61) AS HUGEINT)) % 4294967296) % 4294967296 AS BIGINT)) AS u FROM s1),
 s3 AS (SELECT *, {_rng("a")[0]} AS b, CAST({_rng("a")[1]} AS BIGINT) AS t2 FROM s2),
 s4 AS (SELECT *, xor(t2, CAST((t2 + (CAST(xor(t2, t2 >> 7) AS HUGEINT) * CAST((t2 | 61) AS HUGEINT)) % 4294967296) % 4294967296 AS BIGINT)) AS u2 FROM s3)
SELECT s_suppkey, a AS state, round(xor(u, u >> 14) / CAST(4294967296 AS DOUBLE), 9) AS number, b AS state2, round(xor(u2, u2 >> 14) / CAST(4294967296 AS DOUBLE), 9) AS number2,
  least(s_suppkey % 4096, s_nationkey) * 4096 + greatest(s_suppkey % 4096, s_nationkey) AS pair,
  CAST(greatest(CAST(-0.5 AS DOUBLE), least(CAST(4 AS DOUBLE), s_acctbal / 1000)) AS DOUBLE) AS held, round(pow(greatest(s_acctbal, 1) / 1000, 0.4), 9) AS quality FROM s4"""


def rounded_points(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates rounded inside nested arrays, laid out again as rows."""
    points = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(F.get("embedding", 2 * i).cast("double"), F.get("embedding", 2 * i + 1).cast("double")))
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode(fn.round_points(points, 3)))
    return e.select("vec_id", F.col("pos").cast("int").alias("pos"), F.get("col", F.lit(0)).alias("x"), F.get("col", F.lit(1)).alias("y"))


SQL["rounded_points"] = """
SELECT vec_id, CAST(i AS INTEGER) AS pos, round(CAST(embedding[2 * i + 1] AS DOUBLE), 3) AS x, round(CAST(embedding[2 * i + 2] AS DOUBLE), 3) AS y FROM embeddings, range(4) t(i)"""
