"""The lake: one folder per layer, one parquet folder per table."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from smelter.schemas import APPEND_PARTITIONS, BUCKET, FILE, PARTITIONS

LAYERS = ("bronze", "silver", "gold")


def layer_of(table: str) -> str:
    """Layer by naming convention: raw_*, stg_*, then dimensions and facts."""
    if table.startswith("raw_"):
        return "bronze"
    if table.startswith("stg_"):
        return "silver"
    return "gold"


@dataclass(frozen=True)
class Lake:
    """Locations of the layer tables under one root, on any Hadoop file system."""

    root: str

    def layer_path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def path(self, table: str) -> str:
        return f"{self.layer_path(layer_of(table))}/{table}"

    def stream_path(self, table: str) -> str:
        """Where the stream puts its files; they are listed in its own log."""
        return f"{self.layer_path('_stream')}/{table}"

    def progress_path(self, table: str) -> str:
        return f"{self.layer_path('_progress')}/{table}"

    def mark_path(self, table: str, source: str) -> str:
        """What `table` has taken in of `source`."""
        return f"{self.layer_path('_marks')}/{table}/{source}"

    def changes_path(self, table: str) -> str:
        """A folder for each run that has changed the table."""
        return f"{self.layer_path('_changes')}/{table}"

    def schema_path(self, table: str) -> str:
        """The versions of the schema that appended extracts share, numbered from 1."""
        return f"{self.layer_path('_schemas')}/{table}"

    def parts(self, spark: SparkSession, table: str) -> list[str]:
        """The folders that hold the table: that of the runs, and that of the stream."""
        found = [p for p in (self.path(table), self.stream_path(table)) if exists(spark, p)]
        return found or [self.path(table)]

    def forget_schema(self, spark: SparkSession, table: str) -> None:
        remove(spark, self.schema_path(table))

    def forget_stream(self, spark: SparkSession, table: str) -> None:
        """Remove what the stream has taken in, and its memory of it."""
        remove(spark, self.stream_path(table))
        remove(spark, self.progress_path(table))

    def read(self, spark: SparkSession, table: str, layout: bool = False) -> DataFrame:
        """The table; with `layout` also the columns its folders are named after,
        so that a filter on them skips folders."""
        shared = self._schema(spark, table)
        whole = [
            (spark.read.schema(shared) if shared and path == self.path(table) else spark.read).parquet(path)
            for path in self.parts(spark, table)
        ]
        stored = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), whole)
        if layout:
            return stored
        return stored.drop(*APPEND_PARTITIONS, *PARTITIONS.get(table, {}), BUCKET, FILE)


    def _schema(self, spark: SparkSession, table: str) -> StructType | None:
        """The newest schema of a table that extracts are appended to."""
        path = self.schema_path(table)
        newest = max((int(n) for n in names(spark, path) if n.isdigit()), default=None)
        if newest is None:
            return None
        return StructType.fromJson(json.loads(read_text(spark, f"{path}/{newest}")))


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop_path(spark, path)
    return fs.exists(jpath)


def rename(spark: SparkSession, source: str, target: str) -> None:
    src, fs = _hadoop_path(spark, source)
    dst, _ = _hadoop_path(spark, target)
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    jpath, fs = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def make_folder(spark: SparkSession, path: str) -> None:
    jpath, fs = _hadoop_path(spark, path)
    fs.mkdirs(jpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it isn't there."""
    jpath, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a short text, which is there as a whole or not at all."""
    staging = f"{path}__new"
    jpath, fs = _hadoop_path(spark, staging)
    out = fs.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()
    remove(spark, path)
    rename(spark, staging, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    jpath, fs = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return None
    data = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def size(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files that a path or pattern names."""
    jpath, fs = _hadoop_path(spark, pattern)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(jpath) or ())


def folders(spark: SparkSession, path: str) -> dict[str, frozenset[str]]:
    """The names of the files in each folder of a partitioned table."""
    jpath, fs = _hadoop_path(spark, path)
    found = (s.getPath() for s in fs.listStatus(jpath) if s.isDirectory())
    return {
        p.getName(): frozenset(f.getPath().getName() for f in fs.listStatus(p))
        for p in found
        if "=" in p.getName()
    }


def tables(spark: SparkSession, lake: Lake) -> DataFrame:
    """Tables present in each layer."""
    found = []
    for layer in LAYERS:
        jpath, fs = _hadoop_path(spark, lake.layer_path(layer))
        if not fs.exists(jpath):
            continue
        names = (status.getPath().getName() for status in fs.listStatus(jpath))
        found += [(layer, n) for n in names if not n.startswith(("_", "."))]
    return spark.createDataFrame(sorted(found), "layer string, table string")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows, as stored."""
    return df.limit(rows)


def preview_with_count(df: DataFrame, rows: int = 5) -> tuple[DataFrame, int]:
    """First rows, and how many there are in all."""
    return preview(df, rows), df.count()
