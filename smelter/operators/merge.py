"""Newest row per key, and upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smelter.schemas import BUCKET
from smelter.sinks.parquet import recover, replace_table
from smelter.sources.csv import EXTRACTED_AT, SOURCE_FILE, SOURCE_PATH


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str = EXTRACTED_AT
) -> DataFrame:
    """Keep the newest row of each key.

    An aggregate, not a window: every task first reduces its own rows to one
    per key, so a key with very many versions never meets in a single task.
    Rows of equal version are told apart by their other columns, which makes
    the choice repeatable when a task is run again.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    newest = df.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_row"))
    kept = {c: F.col(c) for c in keys} | {c: F.col("_row")[c] for c in (version, *rest)}
    return newest.select(*(kept[c].alias(c) for c in df.columns))


def latest_per_file(df: DataFrame, extracts: DataFrame | None = None) -> DataFrame:
    """Keep the rows of the newest extract of each source file.

    For rows without a key: extracting a file again replaces its rows, and
    equal rows within one extract are all kept. A file is known by its whole path
    where that was stamped, as folders reuse names. `extracts` holds all rows of
    the extracts when `df` is only a part of them.
    """

    seen = df if extracts is None else extracts
    newest = seen.groupBy(source_of(seen).alias("_file")).agg(F.max(EXTRACTED_AT).alias("_newest"))
    same = source_of(df).eqNullSafe(newest["_file"]) & (df[EXTRACTED_AT] == newest["_newest"])
    return df.join(newest, same, "left_semi")


def source_of(rows: DataFrame) -> Column:
    """The file of each row: its whole path where that was stamped."""
    named = rows[SOURCE_FILE]
    return F.coalesce(rows[SOURCE_PATH], named) if SOURCE_PATH in rows.columns else named


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `updates`, plus the rows of `target` whose key is not among them.

    Nulls in a key are equal to each other, so a row without a key is replaced too.
    """
    changed = updates.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = reduce(and_, (target[k].eqNullSafe(changed[f"_{k}"]) for k in keys))
    return target.join(changed, same, "left_anti").unionByName(updates)


def replace_from(
    target: DataFrame, rebuilt: DataFrame, month: Column, first: int
) -> DataFrame:
    """`target` with all months from `first` on, and rows without a month, taken from `rebuilt`."""
    return target.filter(month < first).unionByName(rebuilt)


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
) -> int:
    """Upsert into a stored table, which stays readable until the swap."""
    recover(spark, path)
    merged = upsert(spark.read.parquet(path).drop(BUCKET), updates, keys)
    return replace_table(spark, merged, path, partition_by)
