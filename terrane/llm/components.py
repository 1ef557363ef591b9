"""Connected components: numpy inside a task, star contractions between tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import tidy
from terrane.llm._shared import discard, stored


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of 0 .. n - 1 over the links a - b: roots hook onto smaller roots and
    paths are halved until every link lies inside one tree."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            break
        root[np.maximum(x, y)] = np.minimum(x, y)
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
    return root


def reduced(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of some links: the smallest id and each other id once."""
    ids, where = np.unique(np.concatenate([src, dst]), return_inverse=True)
    root = labels(len(ids), where[: len(src)], where[len(src) :])
    leaf = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[leaf]], ids[leaf]


def _local(edges: DataFrame) -> DataFrame:
    """Links contracted in each task, so that a node that many links share leaves a task once."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, dst, pending = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            src, dst = np.concatenate([src, np.asarray(b.column(0))]), np.concatenate([dst, np.asarray(b.column(1))])
            pending += len(b)
            if pending > 1_000_000:
                src, dst = reduced(src, dst)
                pending = 0
                if len(src) > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])
                    src = dst = np.zeros(0, np.int64)
        src, dst = reduced(src, dst)
        for i in range(0, len(src), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(src[i : i + 50_000]), pa.array(dst[i : i + 50_000])], names=["src", "dst"])

    return edges.select("src", "dst").mapInArrow(tidy(work), "src long, dst long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node that has a link other than to itself.

    Links are null-free longs src, dst. Large-star and small-star steps alternate, each a minimum by node with map-side
    combine and a join that adaptive execution can split; every round is written to the shared folder. It ends when every
    link is a leaf's link to its root, in about log(diameter) rounds."""
    now = stored(_local(edges.where("src <> dst")), "links")
    while True:
        both = now.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(now.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.select(F.col("v").alias("dst"), F.col("m").alias("src")).unionByName(small.select(F.col("u").alias("dst"), F.col("m").alias("src"))).where("src <> dst").distinct()
        before, now = now, stored(small, "links")
        discard(before)
        # done: every node is a leaf of one star, or the centre of one, and not both
        leaves = now.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
        bad = leaves.where("n > 1").select("dst").unionByName(now.join(leaves.select(F.col("dst").alias("src")), "src", "left_semi").select(F.col("src").alias("dst")))
        if not bad.take(1):
            return now.select(F.col("dst").alias("node"), F.col("src").alias("root")).unionByName(now.select(F.col("src").alias("node"), F.col("src").alias("root")).distinct())
