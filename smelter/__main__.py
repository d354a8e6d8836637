"""Command line: python -m smelter --raw RAW --lake LAKE [options]."""

from __future__ import annotations

import argparse
from datetime import date

from smelter.plans.runner import Options, audit_lake, export_gold, mart, run_all, run_layer
from smelter.plans.steps import LAYERS, MARTS, SILVER
from smelter.plans.summaries import MERGED, merged_mart, update_summaries
from smelter.schemas import RAW_TABLES
from smelter.session import get_session
from smelter.sources.lake import Lake, preview_with_count, tables
from smelter.streaming.append import append_new_files
from smelter.streaming.upsert import upsert_from_stream


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="smelter", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw CSV files")
    parser.add_argument("--lake", required=True, help="root folder of the layers")
    parser.add_argument("--append", action="store_true", help="append to bronze")
    parser.add_argument("--upsert", action="store_true", help="upsert gold")
    parser.add_argument(
        "--incremental", action="store_true", help="take in what has arrived since the last run"
    )
    parser.add_argument("--since", type=date.fromisoformat, help="first month of facts to rebuild")
    parser.add_argument("--cluster", action="store_true", help="sort facts by seller and customer")
    parser.add_argument("--infer", action="store_true", help="let Spark guess raw types")
    parser.add_argument("--multiline", action="store_true", help="line breaks inside review text")
    parser.add_argument("--tidy", action="store_true", help="trim and even out place names")
    parser.add_argument("--jdbc-url", help="SQL store to export the gold tables to")
    parser.add_argument("--jdbc-driver", help="driver class of the SQL store")
    parser.add_argument("--layer", choices=LAYERS, help="build this layer only")
    parser.add_argument("--table", action="append", help="with --layer: this table only; repeatable")
    parser.add_argument("--stream", action="store_true", help="take in new raw files, each once, and stop; with --incremental also into silver")
    parser.add_argument("--mart", choices=MARTS, help="show a mart of the stored lake and stop")
    parser.add_argument(
        "--summaries", action="store_true",
        help="bring the monthly summaries up to date; with --mart: show it from them",
    )
    parser.add_argument("--preview", help="show first rows and row count of a stored table and stop")
    parser.add_argument("--workers", type=int, default=4, help="tables built at the same time")
    parser.add_argument("--lenient", action="store_true", help="go on after a layer with failures")
    parser.add_argument("--shuffle-partitions", type=int, help="instead of a number from input sizes")
    args = parser.parse_args(argv)
    if args.table and not args.layer:
        parser.error("--table needs --layer")
    if args.mart and args.summaries and args.mart not in MERGED:
        parser.error(f"{args.mart} has no summaries")
    if args.incremental and not (args.append and args.upsert):
        parser.error("--incremental needs --append and --upsert")
    if args.since and not args.upsert:
        parser.error("--since needs --upsert")

    spark = get_session()
    lake = Lake(args.lake)
    options = Options(
        bronze_append=args.append,
        gold_upsert=args.upsert,
        incremental=args.incremental,
        facts_since=args.since,
        cluster=args.cluster,
        infer=args.infer,
        multiline=args.multiline,
        tidy=args.tidy,
        workers=args.workers,
        strict=not args.lenient,
        shuffle_partitions=args.shuffle_partitions,
    )
    if args.mart:
        source = merged_mart if args.summaries else mart
        source(spark, lake, args.mart).show(1000, truncate=False)
        return
    if args.preview:
        first, count = preview_with_count(lake.read(spark, args.preview))
        first.show(truncate=False)
        print(f"{count} rows")
        return
    if args.stream:
        for table in args.table or RAW_TABLES:
            append_new_files(spark, args.raw, lake, table, args.multiline).awaitTermination()
        if args.incremental:
            taken = [t for t, step in SILVER.items() if step.inputs[0] in (args.table or RAW_TABLES)]
            for table in taken:
                upsert_from_stream(spark, lake, table).awaitTermination()
        return
    if args.layer:
        done = [run_layer(spark, args.layer, lake, args.raw, options, args.table)]
    else:
        done = [run_all(spark, args.raw, lake, options)]
    if args.summaries:
        for name, months in update_summaries(spark, lake).items():
            print(f"{name}: {len(months)} months")
    if args.jdbc_url:
        properties = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
        done.append(export_gold(spark, lake, args.jdbc_url, properties))
    failed = 0
    for summary in done:
        summary.show(100, truncate=False)
        failed += summary.filter("status = 'failed'").count()
    tables(spark, lake).groupBy("layer").count().show()
    if not args.layer:
        audit_lake(spark, lake, args.summaries).show(200, truncate=False)
    if failed:
        raise SystemExit(f"{failed} tables failed")


if __name__ == "__main__":
    main()
