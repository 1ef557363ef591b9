"""Series by key: splicing at an anchor, casting back with peers, bounded scaling with carried ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def splice(df: DataFrame, key: str, at: str, anchor: int, value: str, proxy: str, out: str) -> DataFrame:
    """From the anchor on the value; before it the proxy times value / proxy at the anchor. Null where what it needs is
    null or zero. (key, at) is unique."""
    ratio = F.max(F.when(F.col(at) == anchor, F.col(value) / F.nullif(F.col(proxy), F.lit(0)))).over(Window.partitionBy(key))
    return df.withColumn(out, F.when(F.col(at) >= anchor, F.col(value)).otherwise(F.col(proxy) * ratio))


def cast_back(df: DataFrame, key: str, group: str, at: str, anchor: int, value: str, out: str, how: str) -> DataFrame:
    """Fills null values before the anchor with the growth of the group's peers, or of all peers where the group has none
    with a positive total. Peers are the keys without a null among the given rows, so a filled key is never a peer and the
    order of keys doesn't count. `how`: given, group, all, or null where nothing helps. Totals have one row a group and
    time, whatever the number of keys."""
    peers = df.withColumn("_whole", F.count(value).over(Window.partitionBy(key)) == F.count(F.lit(1)).over(Window.partitionBy(key)))
    by = peers.where("_whole").groupBy(group, at).agg(F.sum(value).alias("_g"))
    every = by.groupBy(at).agg(F.sum("_g").alias("_a"))
    by = by.join(by.where(F.col(at) == anchor).select(group, F.nullif(F.col("_g"), F.lit(0)).alias("_g0")), group).select(group, at, (F.col("_g") / F.col("_g0")).alias("_by_group"))
    every = every.join(every.where(F.col(at) == anchor).select(F.nullif(F.col("_a"), F.lit(0)).alias("_a0"))).select(at, (F.col("_a") / F.col("_a0")).alias("_by_all"))
    start = F.max(F.when(F.col(at) == anchor, F.col(value))).over(Window.partitionBy(key))
    grown = peers.withColumn("_start", start).join(by, [group, at], "left").join(every, at, "left")
    before = F.col(at) < anchor
    label = F.when(F.col(value).isNotNull(), "given").when(before & (F.col("_start") * F.col("_by_group")).isNotNull(), "group").when(before & (F.col("_start") * F.col("_by_all")).isNotNull(), "all")
    growth = F.when(before, F.coalesce("_by_group", "_by_all"))
    return grown.withColumn(how, label).withColumn(out, F.coalesce(F.col(value), F.col("_start") * growth)).select(*df.columns, out, how)


def bounded_ratio(df: DataFrame, key: str, at: str, ratio: str, dominated: Column, excluded: Column, out: str, why: str, low: float = 0.6, high: float = 1.67) -> DataFrame:
    """The ratio to scale by, and why: `dominant` keeps 1; `carried` takes the key's last scaled ratio before (1 without
    one); `outlier`, outside [low, high] or null, keeps 1; `scaled` takes the ratio itself."""
    inside = F.coalesce(F.col(ratio).between(low, high), F.lit(False))
    reason = F.when(dominated, "dominant").when(excluded, "carried").when(~inside, "outlier").otherwise("scaled")
    before = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col(why) == "scaled", F.col(ratio)), True).over(before)
    return df.withColumn(why, reason).withColumn(out, F.when(F.col(why) == "scaled", F.col(ratio)).when(F.col(why) == "carried", F.coalesce(last, F.lit(1.0))).otherwise(F.lit(1.0)))
