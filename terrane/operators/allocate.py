"""Conserved allocation, calibration, shares and running limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def largest_remainder(df: DataFrame, group: list[str], weight: str, total: str, order: list[str], out: str, fallback: str | None = None) -> DataFrame:
    """Whole numbers that sum to the group's total, in proportion to the weights: floors, then one more for the largest
    remainders, ties by order. A group without weight uses the fallback weights, and equal ones if these are zero too."""
    w = Window.partitionBy(*group)
    chosen = F.col(weight)
    if fallback:
        chosen = F.when(F.sum(weight).over(w) > 0, F.col(weight)).otherwise(F.col(fallback))
    x = df.withColumn("_w", F.coalesce(chosen, F.lit(0)))
    x = x.withColumn("_w", F.when(F.sum("_w").over(w) > 0, F.col("_w")).otherwise(F.lit(1)))
    x = x.withColumn("_exact", F.col(total) * F.col("_w") / F.sum("_w").over(w)).withColumn("_low", F.floor("_exact"))
    rank = F.row_number().over(w.orderBy(F.desc(F.col("_exact") - F.col("_low")), *order))
    x = x.withColumn("_rank", rank).withColumn("_rest", F.col(total) - F.sum("_low").over(w))
    return x.withColumn(out, (F.col("_low") + F.when(F.col("_rank") <= F.col("_rest"), 1).otherwise(0)).cast("long")).drop("_w", "_exact", "_low", "_rank", "_rest")


def calibrate(cells: DataFrame, targets: DataFrame, key: str, value: str, target: str, out: str) -> DataFrame:
    """Values scaled so that each key sums to its target; a key whose cells are all zero is spread evenly. Keys without a
    target keep their values. Sums are made by an aggregation, and the cells are joined with one row a key."""
    sums = cells.groupBy(key).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n")).join(targets.select(key, F.col(target).alias("_target")), key, "left")
    scaled = F.when(F.col("_target").isNull(), F.col(value)).when(F.col("_sum") > 0, F.col(value) * F.col("_target") / F.col("_sum")).otherwise(F.col("_target") / F.col("_n"))
    return cells.join(sums, key).withColumn(out, scaled).drop("_sum", "_n", "_target")


def calibrate_covered(cells: DataFrame, targets: DataFrame, country: str, part: str, value: str, target: str, out: str) -> DataFrame:
    """Covered parts take the shape of their targets while the country keeps its sum: they share what the uncovered leave."""
    sums = cells.groupBy(country, part).agg(F.sum(value).alias("_sum")).join(targets.select(country, part, F.col(target).alias("_t")), [country, part], "left")
    w = Window.partitionBy(country)
    covered = F.sum(F.when(F.col("_t").isNotNull(), F.col("_sum"))).over(w)
    factor = F.when(F.col("_t").isNull(), F.lit(1.0)).otherwise(F.col("_t") / F.sum("_t").over(w) * covered / F.nullif(F.col("_sum"), F.lit(0.0)))
    return cells.join(sums.withColumn("_f", F.coalesce(factor, F.lit(1.0))), [country, part]).withColumn(out, F.col(value) * F.col("_f")).drop("_sum", "_t", "_f")


def running_cap(df: DataFrame, group: list[str], order: list[str], want: str, cap: Column, out: str) -> DataFrame:
    """What each row gets of a capacity that the rows before it use up."""
    before = F.coalesce(F.sum(want).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn(out, F.greatest(F.lit(0), F.least(F.col(want), cap - before)).cast("long"))


def dominant(df: DataFrame, key: list[str], category: str, weight: str, out: str) -> DataFrame:
    """The category with the largest summed weight of each key, of equal ones the first by name."""
    sums = df.groupBy(*key, category).agg(F.sum(weight).alias("_w"))
    return sums.groupBy(*key).agg(F.min_by(category, F.struct((-F.col("_w")).alias("w"), F.col(category).alias("c"))).alias(out))
