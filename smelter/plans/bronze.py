"""Bronze: raw CSV files with their lineage columns."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from smelter.operators.incremental import newest_rows
from smelter.schemas import APPEND_PARTITIONS, RAW_TABLES
from smelter.sources.csv import file_name, file_path, raw_location, read_csv, stamp_lineage
from smelter.sources.lake import Lake, folders, names


def extract(
    spark: SparkSession,
    raw_root: str,
    table: str,
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """One raw table, each row stamped with the time and the file it came from."""
    spec = RAW_TABLES[table]
    scanned = read_csv(spark, raw_location(raw_root, spec), spec, infer, multiline)
    return stamp_lineage(scanned, file_name(), file_path())


def current(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Newest state of a bronze table that extracts are appended to."""
    return newest_rows(lake.read(spark, table), RAW_TABLES[table].key)


def days(spark: SparkSession, lake: Lake, table: str) -> dict[str, str] | None:
    """For each day on which extracts were appended, a text that changes with its files.

    None if the table also has files outside of the folders of days.
    """
    found: dict[str, list[str]] = {}
    for part in lake.parts(spark, table):
        if any(name.endswith(".parquet") for name in names(spark, part)):
            return None
        for folder, files in folders(spark, part).items():
            found.setdefault(folder.partition("=")[2], []).extend(files)
    return {day: hashlib.sha256("\n".join(sorted(f)).encode()).hexdigest() for day, f in found.items()}


def since(spark: SparkSession, lake: Lake, table: str, day: str) -> DataFrame:
    """All extracts from a day on; the folders of earlier days aren't read."""
    stored = lake.read(spark, table, layout=True)
    (column,) = APPEND_PARTITIONS
    return stored.filter(F.col(column) >= F.lit(day).cast("date")).drop(column)
