"""Ordered rules compiled to columns: patterns, first and last match, layers with a veto, unmatched rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def glob(value: Column, pattern: str) -> Column:
    """A case-sensitive |-list of patterns with * ? [..]; a null value is the empty string."""
    one = []
    for p in pattern.split("|"):
        body = re.sub(r"\\\[(!?)(.*?)\\\]", lambda m: "[" + ("^" if m[1] else "") + m[2].replace(r"\-", "-") + "]", re.escape(p)).replace(r"\*", ".*").replace(r"\?", ".")
        one.append(f"(?:{body})")
    return F.coalesce(value, F.lit("")).rlike("^(?s:" + "|".join(one) + ")$")


def prefix_or_equal(value: Column, pattern: str) -> Column:
    """A |-list of values; one that ends in * matches by prefix. Null never matches."""
    v = F.trim(F.replace(value, F.lit(" "), F.lit(" ")))
    out = F.lit(False)
    for p in pattern.split("|"):
        out = out | (v.startswith(p[:-1]) if p.endswith("*") else v == p)
    return F.coalesce(out, F.lit(False))


def resolve(rules: list[tuple[Column, Column]], last: bool, otherwise: Column) -> Column:
    """The value of the first (or last) rule whose condition holds."""
    out = otherwise
    for condition, value in rules if last else reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def layered(rules: list[tuple[Column, Column, bool]], base: Column, overlay: Column) -> Column:
    """The last matching rule, except that whole rules don't count over an overlay until some other rule has matched."""
    out, open_ = F.coalesce(overlay, base), overlay.isNull()
    for condition, value, whole in rules:
        fires = condition & (open_ if whole else F.lit(True))
        out, open_ = F.when(fires, value).otherwise(out), open_ | fires
    return out


def first_match(matches: DataFrame, keys: list[str], rule_no: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(rule_no)
    return matches.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def geo(predicate: str, x: Column, y: Column) -> Column:
    """`box:W,S,E,N`, `circle:LON,LAT,KM` (a circle in degrees) and `poly:LON LAT;LON LAT;...`, alternatives parted by |."""
    out = F.lit(False)
    for part in predicate.split("|"):
        kind, _, args = part.strip().partition(":")
        if kind == "poly":
            ring = [tuple(float(v) for v in p.split()) for p in args.split(";")]
            crossings = F.lit(0)
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                if ay != by:
                    passes = ((F.lit(ay) > y) != (F.lit(by) > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
                    crossings = crossings + F.when(passes, 1).otherwise(0)
            out = out | (crossings % 2 == 1)
            continue
        v = [float(a) for a in args.split(",")]
        if kind == "box":
            out = out | (x.between(v[0], v[2]) & y.between(v[1], v[3]))
        elif kind == "circle":
            import math

            r = v[2] / 111.32 / max(math.cos(math.radians(v[1])), 0.2)
            out = out | ((x - v[0]) * (x - v[0]) + (y - v[1]) * (y - v[1]) <= r * r)
        else:
            raise ValueError(f"unknown shape {kind}")
    return out


def unmatched(rules: DataFrame, hits: DataFrame, rule: str, dates: str) -> DataFrame:
    """Rules with the dates (a |-list) on which they hit nothing."""
    every = rules.withColumn("day", F.explode(F.split(dates, r"\|")))
    return every.join(hits, [rule, "day"], "left_anti").select(rule, "day")


def last_of_either(left: DataFrame, events: DataFrame, pairs: list[tuple[str, str]], number: str, value: str, out: str) -> DataFrame:
    """The value of the last event (largest number, which is unique) that agrees with a row in any of the pairs of columns
    (left, event). Events are reduced to one a key before each join, so no row is multiplied; null agrees with nothing."""
    found = []
    for i, (mine, other) in enumerate(pairs):
        last = events.where(F.col(other).isNotNull()).groupBy(F.col(other).alias(f"_k{i}")).agg(F.max(F.struct(F.col(number).alias("n"), F.col(value).alias("v"))).alias(f"_e{i}"))
        left = left.join(last, F.col(mine) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        found.append(f"_e{i}")
    best = F.greatest(*found) if len(found) > 1 else F.col(found[0])
    return left.withColumn(out, best["v"]).drop(*found)
