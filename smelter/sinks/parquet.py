"""Parquet writers that report how many rows they wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from smelter.sources import lake


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
    rebalance: bool = True,
    order: Column | None = None,
) -> int:
    """Write `df` and return its row count, counted while writing.

    The count rides on the write itself, so the plan runs once. A partitioned
    table is first rebalanced on its partition columns: each folder gets few,
    evenly sized files, and a folder with much of the data is split over
    several tasks; `rebalance` off saves that shuffle where all rows belong to
    one folder anyway. `dynamic` replaces only the folders present in `df`. With
    `order` the rows of each folder are sorted by it, over all of the folder's files:
    tasks get ranges of it, so a folder with much of the data is split here too.
    """
    if order is not None:
        df = df.repartitionByRange(*partition_by, order).sortWithinPartitions(*partition_by, order)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return int(written.get["rows"])


def replace_months(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    column: str,
    first: int,
    order: Column | None = None,
) -> int:
    """Replace the months from `first` on, and the rows without a month, by `df`.

    Folders of that range which `df` has no rows for are removed after the write:
    those whose files are still the same.
    """
    before = lake.folders(spark, path)
    rows = write_table(df, path, partition_by=(column,), dynamic=True, order=order)
    for name, files in lake.folders(spark, path).items():
        month = name.partition("=")[2]
        in_range = not month.isdigit() or int(month) >= first
        if in_range and files == before.get(name):
            lake.remove(spark, f"{path}/{name}")
    return rows


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    finish: Callable[[str], None] | None = None,
    order: Column | None = None,
) -> int:
    """Replace a table that `df` may itself be reading.

    The new version is written next to the old one and then swapped in, so a
    job that dies halfway leaves the old version in place. `recover` finishes a
    swap that was cut short. `finish` is called with the new version's folder
    before the swap.
    """
    staging, previous = f"{path}__new", f"{path}__old"
    recover(spark, path)
    rows = write_table(df, staging, partition_by=partition_by, order=order)
    if finish:
        finish(staging)
    if lake.exists(spark, path):
        lake.rename(spark, path, previous)
    lake.rename(spark, staging, path)
    lake.remove(spark, previous)
    return rows


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the last complete version after an interrupted swap."""
    previous = f"{path}__old"
    if not lake.exists(spark, previous):
        return
    if lake.exists(spark, path):
        lake.remove(spark, previous)
    else:
        lake.rename(spark, previous, path)
