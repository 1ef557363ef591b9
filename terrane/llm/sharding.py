"""Sharding by fixed virtual slots.

Records hash into thousands of slots, a number that never changes. Bytes are aggregated per slot, and a small table maps
slots to shards. Rebalancing and growing edit that table, never the hash; every edit is a new version of the table.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLOTS = 4096
MAP_SCHEMA = "slot int, shard int, bytes long, rows long"


def into_slots(df: DataFrame, keys: list[str], slots: int = SLOTS, out: str = "virtual_slot") -> DataFrame:
    """Adds the record's slot. Null keys hash like any other value, so they share the slot of their other keys. Rows that are
    equal in all keys share a slot; with a record's id among the keys, groups of equal texts are spread over all slots, which
    is what even sizes need when one text is a third of all rows. A column of that name already there is an error."""
    if out in df.columns:
        raise ValueError(f"the input has a column {out} already")
    return df.withColumn(out, F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))


def measure(df: DataFrame, size: str, slot: str = "virtual_slot", slots: int = SLOTS) -> list[tuple[int, int]]:
    """Bytes and rows of every slot. At most `slots` rows reach the driver, whatever the input's size."""
    got = {r[0]: (r[1], r[2]) for r in df.groupBy(slot).agg(F.sum(size), F.count(F.lit(1))).collect()}
    return [got.get(s, (0, 0)) for s in range(slots)]


def balance(load: list[tuple[int, int]], shards: int) -> list[int]:
    """A first map: the heaviest slot goes to the lightest shard; of equal ones the lowest number. Empty slots go round."""
    heap = [(0, k) for k in range(shards)]
    out = [0] * len(load)
    for s in sorted(range(len(load)), key=lambda s: (-load[s][0], s)):
        total, k = heap[0]
        out[s] = k if load[s][0] else s % shards
        if load[s][0]:
            heapq.heapreplace(heap, (total + load[s][0], k))
    return out


def rebalance(current: list[int], load: list[tuple[int, int]], shards: int, tolerance: float = 0.02) -> list[int]:
    """Edit a map until no shard is over the mean by more than the tolerance, moving whole slots from the heaviest shard
    to the lightest; with more shards than before the new ones start empty. Ends when no slot's move helps."""
    out, total = list(current), [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for s, k in enumerate(out):
        total[k] += load[s][0]
        held[k].append(s)
    for _ in range(len(load)):
        most, least = max(range(shards), key=lambda k: (total[k], -k)), min(range(shards), key=lambda k: (total[k], k))
        gap = total[most] - total[least]
        if total[most] <= (1 + tolerance) * sum(total) / shards:
            break
        fit = [s for s in held[most] if 0 < load[s][0] < gap]
        if not fit:
            break
        s = min(fit, key=lambda s: (abs(2 * load[s][0] - gap), s))
        held[most].remove(s)
        held[least].append(s)
        out[s] = least
        total[most] -= load[s][0]
        total[least] += load[s][0]
    return out


class SlotMap:
    """The stored slot-to-shard map: one folder a version, never overwritten, so that an older assignment can be read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the whole versions, in order; none where the path doesn't exist."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and fs.exists(done(f"{self.path}/{n}/_SUCCESS")))

    def write(self, version: int, shards: list[int], load: list[tuple[int, int]]) -> DataFrame:
        """A new version. One that is there already is an error."""
        rows = [(s, k, *load[s]) for s, k in enumerate(shards)]
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("error").parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version}")

    def edit(self, load: list[tuple[int, int]], shards: int, tolerance: float = 0.02) -> DataFrame:
        """The map for this load: the latest version, read back, with whole slots moved until it is even, written as the next
        version; a first version if there is none."""
        have = self.versions()
        if not have:
            return self.write(1, balance(load, shards), load)
        current = [r["shard"] for r in self.read(have[-1]).orderBy("slot").collect()]
        return self.write(have[-1] + 1, rebalance(current, load, shards, tolerance), load)


def assign(df: DataFrame, stored: DataFrame, order: list[str], virtual: str = "virtual_slot", shard: str = "shard", place: str = "slot") -> DataFrame:
    """Adds each record's shard and its place in it, gapless from 0: the rows of the shard's lower slots come first, and
    inside a slot the order is by the given columns; rows equal in all of them come in any order. The map has one row a slot,
    so it is small enough to broadcast. An empty table stays empty. Columns named like the new ones are an error."""
    clash = {shard, place, "_s", "_before", "_inside"} & set(df.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = stored.select(F.col("slot").alias("_s"), F.col("shard").alias(shard), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(virtual).orderBy(*order)) - 1
    return df.withColumn("_inside", inside).join(F.broadcast(small), F.col(virtual) == F.col("_s")).withColumn(place, F.col("_before") + F.col("_inside")).drop("_s", "_before", "_inside")
