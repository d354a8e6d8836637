"""Running the layers: every table of a layer, then the next layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from smelter.operators.audit import audit
from smelter.operators.clustering import cluster_key
from smelter.operators.merge import upsert_table
from smelter.plans import bronze, incremental
from smelter.plans.steps import GOLD, GOLD_CHECKS, LAYERS, MARTS, SILVER, SILVER_CHECKS
from smelter.plans.summaries import KEY_COUNTS, stored_key_counts, update_summary
from smelter.schemas import APPEND_PARTITIONS, CLUSTERS, FACT_TIMES, PARTITIONS, RAW_TABLES
from smelter.sinks.jdbc import export_table
from smelter.session import shuffle_partitions
from smelter.sinks.buckets import recover_buckets
from smelter.sinks.parquet import replace_months, replace_table, write_table
from smelter.sources.csv import SOURCE_PATH, UNPARSED, raw_location
from smelter.sources.drift import conformed
from smelter.sources.lake import Lake, exists, size

SUMMARY = "layer string, table string, rows long, status string, error string, unparsed long"
# Rows in memory take about this many times their bytes in a stored file.
IN_MEMORY = 4


class Outcome(NamedTuple):
    layer: str
    table: str
    rows: int
    status: str  # ok, failed or skipped
    error: str | None = None
    unparsed: int | None = None  # raw lines with a value that is none of its type


class Written(NamedTuple):
    rows: int
    unparsed: int


class LayerFailed(RuntimeError):
    """Some tables failed; the others were still built."""

    def __init__(self, outcomes: Sequence[Outcome]):
        failed = [o for o in outcomes if o.status == "failed"]
        super().__init__("; ".join(f"{o.layer}.{o.table}: {o.error}" for o in failed))
        self.outcomes = list(outcomes)


@dataclass(frozen=True)
class Options:
    """How to run.

    bronze_append  keep earlier extracts and let silver read the newest rows
    gold_upsert    update and insert by key instead of replacing gold tables
    incremental    silver and dimensions take in what has arrived since their last run
                   (needs bronze_append and gold_upsert)
    facts_since    rebuild only the facts of this month and later, and those without
                   a time (needs gold_upsert)
    cluster        sort the facts of a month so that filters on seller, customer or order
                   skip row groups
    infer, multiline, tidy   see read_csv and the silver place names
    workers        tables of one layer built at the same time
    strict         raise after a layer in which a table failed
    shuffle_partitions   of each layer; by default from the bytes it reads
    """

    bronze_append: bool = False
    gold_upsert: bool = False
    incremental: bool = False
    facts_since: date | None = None
    cluster: bool = False
    infer: bool = False
    multiline: bool = False
    tidy: bool = False
    workers: int = 4
    strict: bool = True
    shuffle_partitions: int | None = None

    def __post_init__(self) -> None:
        if self.facts_since and not self.gold_upsert:
            raise ValueError("facts_since needs gold_upsert: without it, all facts are rebuilt")
        if self.incremental and not (self.bronze_append and self.gold_upsert):
            raise ValueError("incremental needs bronze_append and gold_upsert")


def _attempt(layer: str, table: str, work: Callable[[], Written | int | None]) -> Outcome:
    try:
        done = work()
    except Exception as error:  # one broken table must not stop the others
        text = str(error).strip() or type(error).__name__
        return Outcome(layer, table, 0, "failed", text.splitlines()[0])
    if done is None:
        return Outcome(layer, table, 0, "skipped")
    rows, unparsed = done if isinstance(done, tuple) else (done, None)
    return Outcome(layer, table, rows, "ok", None, unparsed)


def _attempt_all(
    spark: SparkSession,
    layer: str,
    tables: Iterable[str],
    work: Callable[[str], Written | int | None],
    workers: int = 1,
    strict: bool = False,
) -> DataFrame:
    one = inheritable_thread_target(spark)(lambda t: _attempt(layer, t, lambda: work(t)))
    with ThreadPoolExecutor(max(workers, 1)) as pool:
        outcomes = list(pool.map(one, tables))
    if strict and any(o.status == "failed" for o in outcomes):
        raise LayerFailed(outcomes)
    return spark.createDataFrame(outcomes, SUMMARY)


def _with_layout(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in layout.items()})


def store_bronze(
    spark: SparkSession, lake: Lake, raw_root: str, table: str, options: Options
) -> Written | int:
    df = bronze.extract(spark, raw_root, table, options.infer, options.multiline)
    failures = None
    if UNPARSED in df.columns:
        failures = Observation()
        df = df.observe(failures, F.count(UNPARSED).alias("unparsed"))
    if options.bronze_append:
        dated = _with_layout(conformed(spark, lake, table, df), APPEND_PARTITIONS)  # all rows of a run share one folder
        rows = write_table(
            dated, lake.path(table), "append", tuple(APPEND_PARTITIONS), rebalance=False
        )
    else:
        rows = replace_table(spark, df, lake.path(table))
        lake.forget_schema(spark, table)
        lake.forget_stream(spark, table)
        incremental.forget(spark, lake, table)
    return rows if failures is None else Written(rows, int(failures.get["unparsed"]))


def _tidied(table: str, options: Options) -> dict[str, bool]:
    return {"tidy": True} if options.tidy and table in ("stg_customers", "stg_sellers") else {}


def _silver_input(
    spark: SparkSession, lake: Lake, options: Options
) -> Callable[[str], DataFrame]:
    def read(table: str) -> DataFrame:
        streamed = table in RAW_TABLES and exists(spark, lake.stream_path(table))
        if streamed or (options.bronze_append and table in RAW_TABLES):
            return bronze.current(spark, lake, table)
        return lake.read(spark, table)

    return read


def store_silver(spark: SparkSession, lake: Lake, table: str, options: Options) -> int:
    if options.incremental:
        return incremental.store_silver(spark, lake, table, **_tidied(table, options))
    step, read = SILVER[table], _silver_input(spark, lake, options)
    rows = step.build(*map(read, step.inputs), **_tidied(table, options))
    incremental.forget(spark, lake, table)
    return replace_table(spark, rows, lake.path(table))


def store_gold(spark: SparkSession, lake: Lake, table: str, options: Options) -> int:
    step, read, path = GOLD[table], _silver_input(spark, lake, options), lake.path(table)
    layout = PARTITIONS.get(table, {})
    inputs = [read(name) for name in step.inputs]
    if options.incremental and not layout:
        return incremental.store_dimension(spark, lake, table, inputs)
    recover_buckets(spark, path)
    update = options.gold_upsert and exists(spark, path)

    if layout:
        (column,) = layout
        order = None
        if options.cluster:
            sources = dict(zip(step.inputs, inputs))
            order = cluster_key({c: sources[source] for c, source in CLUSTERS[table].items()})
        if not (update and options.facts_since):
            # all rows are built anew, so all months are replaced
            df = _with_layout(step.build(*inputs), layout)
            return replace_table(spark, df, path, partition_by=(column,), order=order)
        # Months are replaced as a whole: an upsert that neither joins nor
        # rewrites the months that stay as they are.
        source, time = FACT_TIMES[table]
        first = options.facts_since.replace(day=1)
        at = step.inputs.index(source)
        inputs[at] = inputs[at].filter((F.col(time) >= F.lit(first)) | F.col(time).isNull())
        df = _with_layout(step.build(*inputs), layout)
        return replace_months(spark, df, path, column, first.year * 100 + first.month, order)
    incremental.forget(spark, lake, table)
    if update:
        return upsert_table(spark, path, step.build(*inputs), step.key)
    return replace_table(spark, step.build(*inputs), path)


def run_layer(
    spark: SparkSession,
    layer: str,
    lake: Lake,
    raw_root: str | None = None,
    options: Options = Options(),
    tables: Sequence[str] | None = None,
) -> DataFrame:
    """Build the tables of one layer; returns (layer, table, rows, status, error)."""
    work = {
        "bronze": lambda t: store_bronze(spark, lake, raw_root, t, options),
        "silver": lambda t: store_silver(spark, lake, t, options),
        "gold": lambda t: store_gold(spark, lake, t, options),
    }[layer]
    names = tables or LAYERS[layer]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(
        "spark.sql.shuffle.partitions",
        options.shuffle_partitions or layer_width(spark, layer, lake, raw_root, names),
    )
    try:
        done = _attempt_all(spark, layer, names, work, options.workers, options.strict)
        if layer == "gold" and options.incremental:
            incremental.drop_old_notes(spark, lake)
        return done
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def layer_width(
    spark: SparkSession, layer: str, lake: Lake, raw_root: str | None, tables: Sequence[str]
) -> int:
    """Shuffle partitions for a layer, from the sizes of the files it reads.

    The largest input of a table decides, as if all of it were shuffled. AQE merges
    what turns out smaller, but splits nothing before a join or an aggregate.
    """
    if layer == "bronze":
        patterns = [[raw_location(raw_root, RAW_TABLES[t])] for t in tables]
        factor = 1
    else:
        steps = SILVER | GOLD
        patterns = [[p for i in steps[t].inputs for p in lake.parts(spark, i)] for t in tables]
        factor = IN_MEMORY
    largest = max((sum(size(spark, p) for p in group) for group in patterns), default=0)
    return shuffle_partitions(largest * factor, spark.sparkContext.defaultParallelism)


def run_all(
    spark: SparkSession, raw_root: str, lake: Lake, options: Options = Options()
) -> DataFrame:
    """Bronze, silver and gold in one application."""
    summary = None
    for layer in LAYERS:
        done = run_layer(spark, layer, lake, raw_root, options)
        summary = done if summary is None else summary.unionByName(done)
    return summary


def export_gold(
    spark: SparkSession,
    lake: Lake,
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str = "gold",
    tables: Sequence[str] = tuple(GOLD),
    **export_options,
) -> DataFrame:
    """Send the gold tables to a SQL store; a missing table is skipped."""

    def work(table: str) -> int | None:
        if not exists(spark, lake.path(table)):
            return None
        df = lake.read(spark, table)
        return export_table(df, url, f"{schema}.{table}", properties, **export_options)

    return _attempt_all(spark, schema, tables, work)


def export_raw(
    spark: SparkSession,
    raw_root: str,
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str = "bronze",
    tables: Sequence[str] = tuple(RAW_TABLES),
    options: Options = Options(),
    **export_options,
) -> DataFrame:
    """Send the raw files, with lineage, straight to a SQL store."""

    def work(table: str) -> int:
        df = bronze.extract(spark, raw_root, table, options.infer, options.multiline)
        df = df.drop(SOURCE_PATH, UNPARSED)
        return export_table(df, url, f"{schema}.{table}", properties, **export_options)

    return _attempt_all(spark, schema, tables, work)


def audit_lake(spark: SparkSession, lake: Lake, stored: bool = False) -> DataFrame:
    """Rows, null keys, duplicate keys and orphan keys of silver and gold.

    With `stored` the facts are audited by their monthly key counts, brought up to date
    first: only the facts of changed months are read.
    """
    counts = {}
    if stored:
        for name in KEY_COUNTS.values():
            update_summary(spark, lake, name)
        counts = stored_key_counts(spark, lake)
    return audit(SILVER_CHECKS | GOLD_CHECKS, lambda table: lake.read(spark, table), counts)


def mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A mart over the stored gold tables."""
    step = MARTS[name]
    return step.build(*(lake.read(spark, table) for table in step.inputs))
