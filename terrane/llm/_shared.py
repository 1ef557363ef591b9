"""Where operators keep tables that all executors can read, and which columns they add."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, as in tests, a temporary folder is set for the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="terrane-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting changed for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows written as a table in the shared folder and read from there: cuts lineage and survives lost executors. The
    shuffle files of the write go when it ends, since nothing reads them again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that stored() wrote, once nothing reads it."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of texts hold a few MB, unless the session asks for some size of its own: a batch has copies in the
    JVM and in the worker, and two workers may stand behind one task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "64MB", "67108864"):
        spark.conf.set(name, "8MB")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
