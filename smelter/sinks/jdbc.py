"""Export of tables to a SQL store. Executors write in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


class ExportMismatch(RuntimeError):
    """The SQL table does not hold the rows that were sent."""


def export_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    keep_definition: bool = False,
    batch_size: int = 10_000,
    connections: int = 32,
    verify: bool = True,
) -> int:
    """Replace `table` with the rows of `df`; returns the row count.

    The table is dropped and created anew, or only emptied with
    `keep_definition`, which keeps its column types, indexes and grants. A task
    that is run again after its first commit would leave its rows twice, so the
    table is counted afterwards and a difference is an error; the export itself
    can simply be repeated.
    """
    props = dict(properties or {})
    sent = Observation()
    (
        df.observe(sent, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("truncate", keep_definition)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .jdbc(url, table, properties=props)
    )
    rows = int(sent.get["rows"])
    if verify:
        stored = count_rows(df.sparkSession, url, table, props)
        if stored != rows:
            raise ExportMismatch(f"{table}: sent {rows} rows, stored {stored}")
    return rows


def count_rows(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str]
) -> int:
    """Row count taken inside the SQL store; one number comes back."""
    query = f"(SELECT count(*) AS n FROM {table}) counted"
    return int(spark.read.jdbc(url, query, properties=dict(properties)).first()[0])
