"""From the stream of bronze to silver, batch by batch.

A batch says which keys and files have come. Their rows are looked up in all extracts
from the batch's earliest day on, so what is merged is the newest there is, whether files
come late, batches come again, or runs append to the same table in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from smelter.operators.incremental import Arrived, has_gap, newest_rows
from smelter.operators.merge import source_of
from smelter.plans import bronze, incremental
from smelter.plans.steps import SILVER
from smelter.schemas import APPEND_PARTITIONS, FILE
from smelter.sinks.buckets import bucket_count, recover_buckets
from smelter.sources.lake import Lake, read_text, write_text

#: The last batch taken in; kept in the stream's checkpoint, since batches are numbered anew without it.
TAKEN = "_taken"


def came_with(batch: DataFrame, extracts: DataFrame, key: tuple[str, ...]) -> Arrived:
    """The newest rows of the keys and files in a batch, by `extracts`, which hold the batch and all that is newer."""
    keys = batch.filter(~has_gap(key)).select(*key).distinct()
    files = batch.select(source_of(batch).alias(FILE)).distinct()
    by_key = extracts.filter(~has_gap(key)).join(keys, list(key), "left_semi")
    by_file = extracts.join(files, source_of(extracts) == files[FILE], "left_semi")
    newest = newest_rows(by_key, key).unionByName(newest_rows(by_file, key).filter(has_gap(key)))
    return Arrived(newest, keys, files)


def upsert_batch(spark: SparkSession, lake: Lake, table: str, batch: DataFrame, batch_id: int) -> None:
    """Take one batch in; one that was taken in before is passed over."""
    mark = f"{lake.progress_path(table)}/{TAKEN}"
    if int(read_text(spark, mark) or -1) >= batch_id:
        return
    recover_buckets(spark, lake.path(table))
    n = bucket_count(spark, lake.path(table))
    (column,) = APPEND_PARTITIONS
    day = batch.agg(F.min(column)).first()[0]
    if n is None:
        incremental.store_silver(spark, lake, table)  # nothing to merge into yet: everything is taken in
    elif day is not None:
        step = SILVER[table]
        main, *others = step.inputs
        extracts = bronze.since(spark, lake, main, str(day))
        lists = {raw: (bronze.current(spark, lake, raw), None) for raw in others}
        came = came_with(batch.drop(column), extracts, step.key)
        incremental.take_in(spark, lake, table, came, lists, n)
    write_text(spark, mark, str(batch_id))


def upsert_from_stream(
    spark: SparkSession, lake: Lake, table: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Take into a silver table what the stream has added to bronze since the last call, then stop."""
    path = lake.stream_path(SILVER[table].inputs[0])
    arriving = (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )
    return (
        arriving.writeStream.foreachBatch(
            lambda batch, batch_id: upsert_batch(batch.sparkSession, lake, table, batch, batch_id)
        )
        .option("checkpointLocation", lake.progress_path(table))
        .trigger(availableNow=True)
        .start()
    )
