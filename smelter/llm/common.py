"""Shared folder, durable intermediate tables, and row numbers without one large task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Groups that are numbered on their own inside a key, so that no key is one task's work.
PARTS = 1024
#: Rows of at most about 50 bytes that are broadcast.
BROADCAST_ROWS = 200_000
#: Short rows that one task may well do.
TASK_ROWS = 50_000
#: Bytes of rows that are sent to a Python worker at once, where rows hold whole texts.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = named or tempfile.mkdtemp(prefix="checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared folder until nothing refers to it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is computed inside the block sends rows to Python in batches of about BATCH_BYTES, or less where less is set.

    By default a batch may have 10,000 rows, whose texts stand in the memory of the
    executor and of its Python workers several times over. Results don't depend on it;
    afterwards the session's own setting holds again.
    """
    before = spark.conf.get(BATCH_SETTING)
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(BATCH_SETTING, str(min(most, BATCH_BYTES) if most > 0 else BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


class Scratch:
    """Parquet tables in the shared folder that are removed when the block ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        # what led here isn't read again; Spark removes its shuffle files once the driver has collected them
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """`df`, written under a name of its own."""
        return self.write(df, f"kept-{uuid.uuid4().hex}")

    def __exit__(self, *_) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def sent_whole_if_small(df: DataFrame, rows: str = "1", most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, a stored table of short rows, marked for broadcast if it has at most `most` rows.

    `rows` is SQL for what one of its rows counts, if that is more than one.

    So a large table on the other side isn't shuffled to meet a few rows. With more rows
    Spark joins by shuffling both.
    """
    total = df.agg(F.coalesce(F.sum(F.expr(rows)), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """`df`, known to have at most `rows` short rows, in no more tasks than they ask for, but one for each core.

    So a small table doesn't become as many files as there are shuffle partitions, where
    Spark was told not to merge those. With more rows all partitions stay.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def part_of(*cols: Column, parts: int = PARTS) -> Column:
    """A number below `parts` that depends on the values only."""
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, size: str | None = None, extra: DataFrame | None = None) -> DataFrame:
    """Add `name`: the row's place within `keys`, gapless from 0, or the sum of `size` before it.

    `df` has a column `part` and should be durable, since it is read twice. Rows are
    numbered within (keys, part); the parts' totals, at most one row for each part of
    each key, are summed up and added. So a key with a third of all rows is still
    many groups. Keys and `size` must not be null. `extra` has a row for each value of
    the keys; its columns come along with the totals and need no join of their own.
    """
    one = F.col(size) if size else F.lit(1).cast("long")
    totals = df.groupBy(*keys, "part").agg(F.sum(one).alias("total"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset_"))
    if extra is not None:
        offsets = offsets.join(extra, keys)
    within = Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("inner_", F.coalesce(F.sum(one).over(within), F.lit(0)))
    joined = inner.join(offsets, [*keys, "part"])
    return joined.withColumn(name, F.col("inner_") + F.col("offset_")).drop("inner_", "offset_")
