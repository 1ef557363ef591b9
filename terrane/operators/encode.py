"""Encodings and versions: dictionaries, deltas, runs, content versions, manifests, varint codecs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terrane.operators.graph import cut


def dictionary(df: DataFrame, value: str, position: str) -> DataFrame:
    """value and code: numbers from 0 in the order of first appearance, for non-null values. The values are dealt by ranges
    of their first places and numbered in each partition; what partitions hold before is added from one row a partition."""
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(position).alias("first_at"))
    dealt = cut(first.repartitionByRange("first_at", value).sortWithinPartitions("first_at", value).withColumn("_id", F.monotonically_increasing_id()))
    place = F.shiftright("_id", 33)
    sizes = dealt.groupBy(place.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = dealt.withColumn("_p", place).join(F.broadcast(before), "_p")
    return numbered.select(value, "first_at", (F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)).cast("int").alias("code"))


def deltas(df: DataFrame, key: list[str], order: list[str], value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(value) - F.coalesce(F.lag(value).over(Window.partitionBy(*key).orderBy(*order)), F.lit(0)))


def runs(df: DataFrame, key: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Numbers the runs of equal values of each key from 1."""
    w = Window.partitionBy(*key).orderBy(*order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    return df.withColumn("_c", change).withColumn(out, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def versions(df: DataFrame, key: str, content: str, day: str) -> DataFrame:
    """Equal contents of a key are one version with its days; several get the suffixes #1, #2 by first day, then content."""
    v = df.groupBy(key, F.md5(F.coalesce(content, F.lit(""))).alias("hash")).agg(F.min(day).alias("first_day"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    number = F.row_number().over(w.orderBy("first_day", "hash"))
    return v.withColumn("version_id", F.when(F.count(F.lit(1)).over(w) > 1, F.concat(F.col(key).cast("string"), F.lit("#"), number.cast("string"))).otherwise(F.col(key).cast("string")))


def manifest_diff(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """key and state (missing, extra, differs) of the entries that two manifests don't agree on. A null digest is a value:
    it differs from any other and agrees with itself."""
    a, b = (t.select(key, F.col(digest).alias(f"{n}_digest"), F.lit(True).alias(f"{n}_has")) for t, n in ((old, "old"), (new, "new")))
    j = a.join(b, key, "full_outer")
    state = F.when(F.col("old_has").isNull(), "extra").when(F.col("new_has").isNull(), "missing").when(~F.col("old_digest").eqNullSafe(F.col("new_digest")), "differs")
    return j.withColumn("state", state).where("state is not null").select(key, "state")


def unsigned_varint(n: int, out: bytearray) -> None:
    """Seven bits a byte, low ones first."""
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)


def varint(values: list[int]) -> bytes:
    """Zigzag varints."""
    out = bytearray()
    for v in values:
        unsigned_varint((v << 1) ^ (v >> 63), out)
    return bytes(out)


def unvarint(data: bytes) -> list[int]:
    """Raises ValueError on a truncated or overlong number."""
    out, n, shift = [], 0, 0
    for byte in data:
        if shift > 63:
            raise ValueError("number is too long")
        n |= (byte & 127) << shift
        if byte & 128:
            shift += 7
        else:
            out.append(n >> 1 ^ -(n & 1))
            n = shift = 0
    if shift:
        raise ValueError("truncated")
    return out


@F.pandas_udf(T.BinaryType())
def encode_deltas(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else varint(np.diff(np.asarray(v, np.int64), prepend=0).tolist()))


@F.pandas_udf(T.ArrayType(T.LongType()))
def decode_deltas(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else np.cumsum(np.array(unvarint(bytes(b)), np.int64)).tolist())
