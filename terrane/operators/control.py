"""Who holds what, and what it counts: control on a date, precedence of series, cities, checks of a finished set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def controllers(units: DataFrame, events: DataFrame, day: Column) -> DataFrame:
    """units (unit_id, code, sovereign, start, stop) in force on the day, with controller and how: that of the last whole event in
    force for the unit's code, else its sovereign, else itself. events: code, start, stop, scope, controller, line_no."""
    held = lambda a, z: (a.isNull() | (a <= day)) & (z.isNull() | (z >= day))
    live = units.where(held(F.col("start"), F.col("stop"))).select("unit_id", "code", "sovereign")
    last = events.where(held(F.col("start"), F.col("stop")) & (F.col("scope") == "whole")).groupBy("code").agg(F.max_by("controller", "line_no").alias("by_event"))
    done = live.join(last, "code", "left")
    how = F.when(F.col("by_event").isNotNull(), "event").when(F.col("sovereign").isNotNull(), "sovereign").otherwise("self")
    return done.select("unit_id", F.coalesce("by_event", "sovereign", "code").alias("controller"), how.alias("how"))


def first_known(choices: list[tuple[str, Column]], out: str, why: str) -> list[Column]:
    """The first of the values that isn't null, and its name."""
    flag = None
    for name, value in choices:
        flag = F.when(value.isNotNull(), name) if flag is None else flag.when(value.isNotNull(), name)
    return [F.coalesce(*[v for _, v in choices]).alias(out), flag.alias(why)]


def income_precedence(rows: DataFrame, region: DataFrame) -> DataFrame:
    """key, at, income, flag of every key and time of rows (key, at, seen, path; both may be null). Of a key with both: seen;
    else its path times the ratio seen / path, interpolated by logarithm between the times that have both and kept beyond
    them. With a path alone: the path times the median ratio of that time (interpolated over times without one). With seen
    alone: seen; else log-linear between two of them. Without either, the median of the region's keys at the time. A key has
    few times, and a time's median is of one value a key."""
    w = Window.partitionBy("key")
    r = rows.join(region, "key").withColumn("log", F.when(F.col("seen").isNotNull() & F.col("path").isNotNull(), F.ln(F.col("seen") / F.col("path"))))
    r = r.withColumn("both", F.count("log").over(w) > 0).withColumn("paths", F.count("path").over(w) > 0).withColumn("sights", F.count("seen").over(w) > 0)
    ratios = r.groupBy("at").agg(F.median(F.exp("log")).alias("ratio"))
    ratios = filled(ratios.withColumn("all", F.lit(0)), ["all"], "at", "ratio", "ratio_filled").select("at", "ratio_filled")
    r = filled(r, ["key"], "at", "log", "log_filled")
    r = filled(r.withColumn("log_seen", F.ln("seen")), ["key"], "at", "log_seen", "seen_line", beyond=False).join(F.broadcast(ratios), "at")
    choices = [
        ("seen", F.col("seen")), ("chained", F.when(F.col("both"), F.col("path") * F.exp("log_filled"))), ("scaled", F.when(~F.col("both") & F.col("paths"), F.col("path") * F.col("ratio_filled"))),
        ("log_linear", F.when(F.col("sights") & ~F.col("paths"), F.exp("seen_line"))),
    ]
    r = r.select("key", "region", "at", *first_known(choices, "income", "flag"))
    medians = r.groupBy("region", "at").agg(F.median("income").alias("peers"))
    return r.join(medians, ["region", "at"]).select("key", "at", *first_known([("own", F.col("income")), ("peers", F.col("peers"))], "income2", "f2"), "flag").select("key", "at", F.col("income2").alias("income"), F.coalesce("flag", "f2").alias("flag"))


def filled(df: DataFrame, key: list[str], at: str, value: str, out: str, beyond: bool = True) -> DataFrame:
    """Nulls by linear interpolation between known neighbours; beyond the first and last the nearest known one, or null."""
    back, on = Window.partitionBy(*key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*key).orderBy(at).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("t"), F.col(value).alias("v")))
    p, n = F.last(known, True).over(back), F.first(known, True).over(on)
    line = F.when(p["t"] == n["t"], p["v"]).when(p.isNotNull() & n.isNotNull(), p["v"] + (n["v"] - p["v"]) * (F.col(at) - p["t"]) / (n["t"] - p["t"]))
    return df.withColumn(out, F.coalesce(line, p["v"], n["v"]) if beyond else line)


def composite_zonal(cells: DataFrame, pieces: DataFrame, unit: str, part: str, value: str, out: str) -> DataFrame:
    """Sums of a value by unit and piece: first by unit and part, zero sums dropped, then the part's piece (pieces: unit, part,
    piece), then again; pieces that get nothing come back with zero."""
    first = cells.groupBy(unit, part).agg(F.sum(value).alias("_v")).where("_v <> 0")
    second = first.join(pieces.select(unit, part, "piece"), [unit, part]).groupBy(unit, "piece").agg(F.sum("_v").alias(out))
    return pieces.select(unit, "piece").distinct().join(second, [unit, "piece"], "left").withColumn(out, F.coalesce(out, F.lit(0)))


def cities_on(cities: DataFrame, day: str, code: str, bits: dict[str, int]) -> DataFrame:
    """The cities shown on a day (dates empty, or holding it): role for a code, whether it is a capital or a seat, and flags."""
    from terrane.functions import flags, role

    shown = (F.coalesce(F.col("dates"), F.lit("")) == "") | F.contains(F.col("dates"), F.lit(day))
    return cities.where(shown).select("city", role(F.col("capital"), code).alias("role"), F.coalesce(F.contains(F.col("seat"), F.lit(day)), F.lit(False)).alias("seat"), flags(F.coalesce("kinds", F.lit("")), bits).alias("flags"))


def country_key(controller: Column, detail: Column, clients: dict[str, str]) -> Column:
    """The controller, or for a client state (a word in the detail) its own key."""
    out = None
    for word, name in clients.items():
        hit = F.coalesce(F.contains(detail, F.lit(word)), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(controller.cast("string"))


def relative_gap(df: DataFrame, a: str, b: str) -> Column:
    """The largest |a - b| / |a| over the rows; rows without a or with a zero don't count."""
    return F.max(F.when(F.col(a) != 0, F.abs(F.col(a) - F.col(b)) / F.abs(F.col(a))))


def missing_references(facts: DataFrame, column: str, dims: DataFrame, key: str) -> DataFrame:
    """Values of the column that the dimension lacks; null refers to nothing and isn't one."""
    return facts.where(F.col(column).isNotNull()).select(F.col(column).alias("missing")).distinct().join(dims, F.col("missing") == F.col(key), "left_anti")


def unstable(df: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """Keys whose value varies by more than the tolerance, relative to the smallest."""
    return df.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high")).where((F.col("high") - F.col("low")) > tolerance * F.abs(F.col("low")))


def aligned(df: DataFrame, arrays: list[str], index: str, lut: str) -> DataFrame:
    """The rows whose arrays differ in length, or whose index points outside its table, or whose table repeats a value."""
    same = F.size(arrays[0]) == F.size(arrays[0])
    for a in arrays[1:]:
        same = same & (F.size(a) == F.size(arrays[0]))
    inside = F.forall(index, lambda i: (i >= 0) & (i < F.size(lut)))
    return df.where(~(same & inside & (F.size(F.array_distinct(lut)) == F.size(lut))))


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """column, left, right of the columns that two tables don't share or have in different types."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    rows = [(c, x.get(c), y.get(c)) for c in sorted(x.keys() | y.keys()) if x.get(c) != y.get(c)]
    return a.sparkSession.createDataFrame(rows, "column string, left string, right string")


def largest_stretch(nodes: DataFrame, edges: DataFrame, key: str, owner: str, area: str) -> DataFrame:
    """owner, label, area and size of each owner's largest connected stretch (by area, then smallest label)."""
    from terrane.operators.graph import components

    own = nodes.select(F.col(key).alias("k"), F.col(owner).alias("o"))
    inner = edges.join(own.select(F.col("k").alias("src"), F.col("o").alias("so")), "src").join(own.select(F.col("k").alias("dst"), F.col("o").alias("do")), "dst").where("so = do and src <> dst")
    labels = components(inner.select("src", "dst"))
    placed = nodes.select(F.col(key).alias("node"), F.col(owner).alias("owner"), F.col(area).alias("area")).join(labels, "node", "left")
    sums = placed.groupBy("owner", F.coalesce("label", "node").alias("label")).agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n"))
    return sums.groupBy("owner").agg(F.min(F.struct((-F.col("area")).alias("a"), "label", "n")).alias("b")).select("owner", "b.label", (-F.col("b.a")).alias("area"), "b.n")
