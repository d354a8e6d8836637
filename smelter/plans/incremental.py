"""Silver and the entity dimensions kept up to date: what has arrived is read, what it touches is written.

Silver remembers, for each raw table, the days of extracts and their files it has taken
in. A run reads the earliest changed day and all later ones. It notes which entities the
replaced and the new rows belong to; a dimension rebuilds the entities noted since its
last run. Whatever has no such memory is built from everything once.

The order within a run makes it safe to die: first the note, then the table, then the
memory. What is taken in twice ends the same.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smelter.operators.incremental import Arrived, arrived, from_origin, merged, rebuilt, replaced, with_origin
from smelter.plans import bronze, silver
from smelter.plans.steps import ENTITIES, GOLD, SILVER
from smelter.schemas import BUCKET, FILE, RAW_TABLES
from smelter.sinks.buckets import (
    bucket_count,
    bucket_of,
    buckets_for,
    read_buckets,
    recover_buckets,
    replace_buckets,
    write_buckets,
)
from smelter.sources.lake import Lake, names, read_text, remove, size, write_text

#: Columns by which the rows of a silver table belong to entities.
CARRIED = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("customer_id",),
    "stg_products": ("product_id",),
    "stg_order_items": ("product_id", "seller_id"),
    "stg_sellers": ("seller_id",),
}


def forget(spark: SparkSession, lake: Lake, table: str) -> None:
    """Called when `table` is written as a whole: it has taken in nothing, and nothing knows what changed in it."""
    remove(spark, f"{lake.layer_path('_marks')}/{table}")
    remove(spark, lake.changes_path(table))
    for step_name, step in (SILVER | GOLD).items():
        if table in step.inputs:
            remove(spark, lake.mark_path(step_name, table))


def _layout(spark: SparkSession, lake: Lake, table: str, sources: Sequence[str]) -> int:
    """Folders for a table that is laid out anew, by the bytes of what it is built from."""
    parts = [p for s in sources for p in lake.parts(spark, s)]
    return bucket_count(spark, lake.path(table)) or buckets_for(sum(size(spark, p) for p in parts))


def _folders(touched: DataFrame) -> list[int]:
    """Numbers of folders: as many as the table has at most, whatever the rows."""
    return sorted(r[0] for r in touched.distinct().collect())


# --- silver -------------------------------------------------------------------------


def silver_rows(table: str, newest: DataFrame, lists: Sequence[DataFrame] = (), **extra) -> DataFrame:
    """The silver rows of raw rows, each without a whole key with its file."""
    return from_origin(SILVER[table].build(with_origin(newest, SILVER[table].key), *lists, **extra))


def silver_bucket(table: str, n: int) -> Column:
    key = [F.col(c) for c in SILVER[table].key]
    return F.when(F.col(FILE).isNull(), bucket_of(key, n)).otherwise(bucket_of([F.col(FILE)], n))


def _days(text: str | None) -> dict[str, str] | None:
    return None if text is None else dict(line.split() for line in text.splitlines())


def first_change(known: Mapping[str, str], found: Mapping[str, str]) -> str | None:
    """The earliest day with other files than known; None if there is none. Days that are gone change nothing."""
    return min((day for day, files in found.items() if known.get(day) != files), default=None)


def retranslated(stored: DataFrame, renamed: DataFrame, keys: DataFrame, english: DataFrame) -> DataFrame:
    """Stored products that haven't come again but whose category has another name now."""
    names_of = renamed.select(F.col("product_category_name").alias("category_name_pt"))
    old = stored.join(names_of, "category_name_pt", "left_semi").join(keys, "product_id", "left_anti")
    again = silver.translated(old.withColumnRenamed("category_name", "_before"), english)
    return again.filter(~F.col("category_name").eqNullSafe(F.col("_before"))).select(*stored.columns)


def silver_update(
    table: str, stored: DataFrame, came: Arrived, lists: Mapping[str, tuple[DataFrame, Arrived | None]], **extra
) -> tuple[DataFrame, DataFrame]:
    """The new rows of a silver table, and the keys that they and nothing else stand for.

    `lists` has, for each further input, its whole state and what of it has arrived.
    """
    built = silver_rows(table, came.newest, [state for state, _ in lists.values()], **extra)
    keys = came.keys
    for state, changed in lists.values():
        if changed is not None:
            again = retranslated(stored, changed.newest, keys, state)
            built = built.unionByName(again)
            keys = keys.unionByName(again.select(*SILVER[table].key))
    return built, keys


def store_silver(spark: SparkSession, lake: Lake, table: str, **extra) -> int:
    """Bring a silver table up to date; returns the rows written, 0 if nothing has arrived."""
    step, path = SILVER[table], lake.path(table)
    recover_buckets(spark, path)
    main, *others = step.inputs
    found = {raw: bronze.days(spark, lake, raw) for raw in step.inputs}
    known = {raw: _days(read_text(spark, lake.mark_path(table, raw))) for raw in step.inputs}
    n = bucket_count(spark, path)
    states = {raw: bronze.current(spark, lake, raw) for raw in others}

    if n is None or any(known[raw] is None or found[raw] is None for raw in step.inputs):
        forget(spark, lake, table)
        n = _layout(spark, lake, table, step.inputs)
        rows = silver_rows(table, bronze.current(spark, lake, main), list(states.values()), **extra)
        written = write_buckets(spark, rows, path, silver_bucket(table, n), n)
    else:
        first = {raw: first_change(known[raw], found[raw]) for raw in step.inputs}
        if not any(first.values()):
            return 0
        came = _arrived(spark, lake, main, first[main])
        lists = {raw: (states[raw], first[raw] and _arrived(spark, lake, raw, first[raw])) for raw in others}
        written = take_in(spark, lake, table, came, lists, n, **extra)
    for raw, days in found.items():
        if days is not None:
            text = "\n".join(f"{day} {files}" for day, files in sorted(days.items()))
            write_text(spark, lake.mark_path(table, raw), text)
    return written


def take_in(
    spark: SparkSession,
    lake: Lake,
    table: str,
    came: Arrived,
    lists: Mapping[str, tuple[DataFrame, Arrived | None]],
    n: int,
    **extra,
) -> int:
    """Merge what has arrived into the folders of a silver table that it touches."""
    step, path = SILVER[table], lake.path(table)
    # which products a new category name touches is looked up in the whole table, all else by its key
    whole = spark.read.parquet(path).drop(BUCKET)
    _, keys = silver_update(table, whole, came, lists, **extra)
    by_key = keys.select(bucket_of([F.col(c) for c in step.key], n))
    by_file = came.files.select(bucket_of([F.col(FILE)], n))
    folders = _folders(by_key.union(by_file))
    stored = read_buckets(spark, path, folders)
    built, keys = silver_update(table, stored, came, lists, **extra)
    _note(spark, lake, table, replaced(stored, keys, came.files, step.key), built)
    rows = merged(stored, built, keys, came.files, step.key)
    return replace_buckets(spark, rows, path, silver_bucket(table, n), folders)


def _arrived(spark: SparkSession, lake: Lake, raw: str, day: str | None) -> Arrived:
    extracts = bronze.since(spark, lake, raw, day) if day else lake.read(spark, raw).limit(0)
    return arrived(extracts, RAW_TABLES[raw].key)


def _note(spark: SparkSession, lake: Lake, table: str, old: DataFrame, new: DataFrame) -> None:
    """Store which entities the old and the new rows belong to."""
    if table in CARRIED:
        columns = CARRIED[table]
        touched = old.select(*columns).unionByName(new.select(*columns)).distinct()
        touched.write.parquet(f"{lake.changes_path(table)}/run={time.time_ns():020d}")


# --- gold ---------------------------------------------------------------------------


def entity_update(
    dimension: str, entities: DataFrame, facts: DataFrame, ids: DataFrame
) -> DataFrame:
    """The rows of a dimension for some of its entities, from all that belongs to them."""
    (key,) = GOLD[dimension].key
    return GOLD[dimension].build(entities.join(ids, key, "left_semi"), facts.join(ids, key, "left_semi"))


def store_dimension(spark: SparkSession, lake: Lake, table: str, inputs: Sequence[DataFrame]) -> int:
    """Bring a dimension up to date; returns the rows written."""
    path = lake.path(table)
    recover_buckets(spark, path)
    n = bucket_count(spark, path)
    if table not in ENTITIES:
        return _store_changed(spark, lake, table, inputs, n)
    step = GOLD[table]
    (key,) = step.key
    runs = {source: names(spark, lake.changes_path(source)) for source in step.inputs}
    seen = {source: read_text(spark, lake.mark_path(table, source)) for source in step.inputs}
    if n is None or any(mark is None for mark in seen.values()):
        n = _layout(spark, lake, table, step.inputs)
        written = write_buckets(spark, step.build(*inputs), path, bucket_of([F.col(key)], n), n)
    else:
        new = [f"{lake.changes_path(s)}/{run}" for s in step.inputs for run in runs[s] if run > seen[s]]
        if not new:
            return 0
        noted = [spark.read.parquet(p).select(key) for p in new]
        ids = reduce(DataFrame.unionByName, noted).filter(F.col(key).isNotNull()).distinct()
        folders = _folders(ids.select(bucket_of([F.col(key)], n)))
        entities, facts = inputs
        there = bucket_count(spark, lake.path(step.inputs[0]))
        if there:  # silver is laid out by the same key, so only some of its folders are read
            wanted = _folders(ids.select(bucket_of([F.col(key)], there)))
            entities = read_buckets(spark, lake.path(step.inputs[0]), wanted).drop(FILE)
        updates = entity_update(table, entities, facts, ids)
        rows = rebuilt(read_buckets(spark, path, folders), updates, ids, step.key)
        written = replace_buckets(spark, rows, path, bucket_of([F.col(key)], n), folders)
    for source in step.inputs:
        # "run=" comes before the name of any run: none has been there so far
        write_text(spark, lake.mark_path(table, source), max(runs[source], default="run="))
    return written


def missing(rows: DataFrame, among: DataFrame) -> DataFrame:
    """Rows that aren't `among` others in all their columns; nulls are equal to each other."""
    other = among.select(*(F.col(c).alias(f"_{c}") for c in rows.columns))
    same = reduce(lambda a, b: a & b, (rows[c].eqNullSafe(other[f"_{c}"]) for c in rows.columns))
    return rows.join(other, same, "left_anti")


def _store_changed(
    spark: SparkSession, lake: Lake, table: str, inputs: Sequence[DataFrame], n: int | None
) -> int:
    """Write a dimension that is built from everything; folders in which no row changes stay."""
    step, path = GOLD[table], lake.path(table)
    bucket = [F.col(c) for c in step.key]
    state = step.build(*inputs)
    if n is None:
        n = _layout(spark, lake, table, step.inputs)
        return write_buckets(spark, state, path, bucket_of(bucket, n), n)
    stored = spark.read.parquet(path).drop(BUCKET)
    differing = missing(state, stored).unionByName(missing(stored, state))
    folders = _folders(differing.select(bucket_of(bucket, n)))
    if not folders:
        return 0
    rows = state.filter(bucket_of(bucket, n).isin(folders))
    return replace_buckets(spark, rows, path, bucket_of(bucket, n), folders)


def drop_old_notes(spark: SparkSession, lake: Lake) -> None:
    """Remove the notes that all dimensions have taken in."""
    for source in CARRIED:
        readers = [d for d in ENTITIES if source in GOLD[d].inputs]
        marks = [read_text(spark, lake.mark_path(d, source)) for d in readers]
        if all(marks):
            for run in names(spark, lake.changes_path(source)):
                if run < min(marks):  # the newest stays, so that names go on growing
                    remove(spark, f"{lake.changes_path(source)}/{run}")
