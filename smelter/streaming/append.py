"""Appending new raw files to bronze, each file exactly once.

Structured Streaming keeps the list of files already taken in its checkpoint
and commits every batch as a whole: a run that dies is continued by the next
one without losing or repeating a file. The stream has a folder of its own,
which only it writes to; `Lake.read` puts it together with what runs append.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from smelter.schemas import APPEND_PARTITIONS, RAW_TABLES
from smelter.sources.csv import (
    csv_options,
    file_name,
    file_path,
    header_schema,
    raw_location,
    stamp_lineage,
)
from smelter.sources.lake import Lake


def append_new_files(
    spark: SparkSession,
    raw_root: str,
    lake: Lake,
    table: str,
    multiline: bool = False,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Take in the files that arrived since the last run, then stop."""
    spec = RAW_TABLES[table]
    location = raw_location(raw_root, spec)
    arriving = (
        spark.readStream.options(**csv_options(spec, multiline))
        .schema(header_schema(spark, location, spec, multiline))
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(location)
    )
    stamped = stamp_lineage(arriving, file_name(), file_path()).withColumns(
        {name: F.expr(text) for name, text in APPEND_PARTITIONS.items()}
    )
    return (
        stamped.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*APPEND_PARTITIONS)
        .option("path", lake.stream_path(table))
        .option("checkpointLocation", lake.progress_path(table))
        .trigger(availableNow=True)
        .start()
    )
