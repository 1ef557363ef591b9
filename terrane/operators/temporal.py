"""Validity in time: closed intervals, interval joins, nearest and bracketing matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def in_force(day: Column, start: Column, end: Column) -> Column:
    """start <= day <= end, where a null bound is open."""
    return (start.isNull() | (start <= day)) & (end.isNull() | (end >= day))


def changed_between(start: Column, end: Column, base: Column, day: Column) -> Column:
    """Going forward what starts in (base, day], going back what ends in [day, base)."""
    return F.when(day >= base, (start > base) & (start <= day)).otherwise((end >= day) & (end < base))


def intervals(df: DataFrame, key: str, start: str, order: list[str]) -> DataFrame:
    """Adds next_start: each row holds from its start until the day before the key's next one."""
    return df.withColumn("next_start", F.lead(start).over(Window.partitionBy(key).orderBy(start, *order)))


def interval_join(points: DataFrame, spans: DataFrame, point: str, start: str, stop: str, step: str = "month") -> DataFrame:
    """Points in [start, stop) (null stop: open), as an equi join on calendar steps: a span is spread over the steps of the
    points' range that it touches, so no pair outside a step is formed and a step's rows are dealt by hash."""
    lo, hi = F.min(point).alias("lo"), F.max(point).alias("hi")
    bounds = F.broadcast(points.agg(lo, hi))
    at = F.date_trunc(step, F.col(point)).cast("date")
    first = F.date_trunc(step, F.greatest(F.col(start), F.col("lo"))).cast("date")
    last = F.date_trunc(step, F.least(F.coalesce(F.date_sub(F.col(stop), 1), F.col("hi")), F.col("hi"))).cast("date")
    spread = spans.crossJoin(bounds).where(first <= last).withColumn("_step", F.explode(F.sequence(first, last, F.expr({"quarter": "interval 3 months"}.get(step, f"interval 1 {step}"))))).drop("lo", "hi")
    return points.withColumn("_step", at).join(spread, "_step").where((F.col(start) <= F.col(point)) & (F.col(stop).isNull() | (F.col(point) < F.col(stop)))).drop("_step")


def nearest(left: DataFrame, right: DataFrame, key: str, at: str, other: str, value: str, out: str) -> DataFrame:
    """Of the key's rows the value whose time is nearest, of equal ones the earlier. right has few times a key: its times
    are gathered in one array a key, and the join is on the key alone."""
    held = right.groupBy(key).agg(F.collect_list(F.struct(F.col(other).alias("t"), F.col(value).alias("v"))).alias("_held"))
    best = F.array_min(F.transform("_held", lambda x: F.struct(F.abs(x["t"] - F.col(at)).alias("d"), x["t"].alias("t"), x["v"].alias("v"))))
    return left.join(held, key, "left").withColumn(out, best["v"]).drop("_held")


def bracket_fill(df: DataFrame, key: list[str], at: str, value: str, out: str, log: bool = False) -> DataFrame:
    """Linear (or log-linear) interpolation of null values between known ones; beyond the first and last they are kept."""
    v = F.ln(value) if log else F.col(value)
    back = Window.partitionBy(*key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy(*key).orderBy(at).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("t"), v.alias("v")))
    p, n = F.last(known, True).over(back), F.first(known, True).over(on)
    line = F.when(p.isNull(), n["v"]).when(n.isNull() | (p["t"] == n["t"]), p["v"]).otherwise(p["v"] + (n["v"] - p["v"]) * (F.col(at) - p["t"]) / (n["t"] - p["t"]))
    return df.withColumn(out, F.exp(line) if log else line)


def preferred(records: DataFrame, key: str, start: str, stop: str, order: str, days: list[str], value: str, out: str) -> DataFrame:
    """key, day and the value of the record in force on the day (the first in order), or else of the record whose start
    year is nearest. Keys without records don't appear. One partial aggregation: no record meets another."""
    dated = records.withColumn("day", F.explode(F.array(*[F.lit(d).cast("date") for d in days])))
    off = ~F.coalesce(F.col("day").between(F.col(start).cast("date"), F.col(stop).cast("date")), F.lit(False))
    gap = F.when(off, F.abs(F.year(start) - F.year("day"))).otherwise(F.lit(0))
    return dated.groupBy(key, "day").agg(F.min_by(value, F.struct(off, gap, F.col(order))).alias(out))


def floor_then_near(series: DataFrame, key: str, at: str, value: str, asked: int, out: str) -> DataFrame:
    """From the last step at or before the asked one (the first step of all if there is none) outward: the nearest positive
    value of each key, the earlier of two equally near; 0 if it has none. Steps are integers."""
    base = F.coalesce(F.max(F.when(F.col(at) <= asked, F.col(at))), F.min(at))
    steps = series.agg(base.alias("_from"))
    near = F.min_by(value, F.when(F.col(value) > 0, F.struct(F.abs(F.col(at) - F.col("_from")), F.col(at))))
    return series.join(F.broadcast(steps)).groupBy(key).agg(F.coalesce(near, F.lit(0)).alias(out))
