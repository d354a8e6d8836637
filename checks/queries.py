"""Every operator as a query over the test tables.

Each query reads its whole tables and builds one lazy plan from the raw views
through silver and gold. Only the outermost select is for the check: lineage
times are dropped, decimals and times are given the types both engines share.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.adapters import RAW_INPUTS, RAW_VIEWS, TEST_TABLES
from smelter.functions import columns as C
from smelter.operators.audit import audit, audit_counts, key_counts
from smelter.operators.incremental import arrived, merged, newest_rows, rebuilt
from smelter.operators.merge import latest_per_file, latest_per_key, replace_from, upsert
from smelter.plans import gold
from smelter.plans.incremental import entity_update, silver_rows, silver_update
from smelter.plans.steps import GOLD_CHECKS, SILVER_CHECKS, STEPS, derive
from smelter.plans.summaries import MERGED, SUMMARIES, with_month
from smelter.schemas import FACT_TIMES, FILE, PARTITIONS, RAW_TABLES
from smelter.sources.csv import EXTRACTED_AT, SOURCE_PATH, stamp_lineage
from smelter.sources.lake import preview

Query = Callable[[SparkSession, str], DataFrame]

# Orders from this moment on arrive in the second batch of the loading queries.
SECOND_BATCH_FROM = "2000-01-01 00:00:00"


def raw_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw view over the test tables, without lineage."""
    inputs = {
        table: spark.read.schema(TEST_TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")
        for table in RAW_INPUTS[name]
    }
    text = RAW_VIEWS[name]
    for table in inputs:
        text = text.replace(f"from {table}", f"from {{{table}}}")
    return spark.sql(text, **inputs)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stamp_lineage(raw_view(spark, sf_dir, name), F.lit(f"{name}.csv"))


def comparable(df: DataFrame) -> DataFrame:
    """The columns both engines can be compared on."""

    def shared(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.DateType)):
            column = column.cast("timestamp_ntz")
        return column.alias(field.name)

    return df.select(*(shared(f) for f in df.schema if f.name != EXTRACTED_AT))


def table_query(name: str) -> Query:
    """A silver, gold or mart table, derived from the raw views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(derive(name, partial(raw_table, spark, sf_dir)))

    return run


def bronze_query(name: str) -> Query:
    """A raw table printed as CSV lines and read back with the declared types.

    from_csv is the parser of the CSV scan, so this checks the types and the
    null handling of the scan without writing files.
    """
    spec = RAW_TABLES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = raw_view(spark, sf_dir, name)
        declared = ", ".join(f"{c} {spec.columns[c]}" for c in view.columns)
        line = F.to_csv(F.struct(*view.columns))
        parsed = view.select(F.from_csv(line, declared).alias("row"))
        return comparable(stamp_lineage(parsed.select("row.*"), F.lit(f"{name}.csv")))

    return run


def preview_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five rows; ordered here, because stored order is not part of a table."""
    products = raw_table(spark, sf_dir, "raw_products")
    return comparable(preview(products.orderBy("product_id"), 5))


def clean_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct places of customers and sellers, tidied from text with stray blanks."""
    places = None
    for table, prefix in (("raw_customers", "customer"), ("raw_sellers", "seller")):
        raw = raw_view(spark, sf_dir, table)
        city = F.concat(F.lit("  "), F.replace(f"{prefix}_city", F.lit(" "), F.lit("   ")))
        state = F.concat(F.lower(f"{prefix}_state"), F.lit(" "))
        place = raw.select(
            F.lit(prefix).alias("place_of"),
            C.tidy_place(city).alias("city"),
            C.tidy_code(state).alias("state"),
        )
        places = place if places is None else places.unionByName(place)
    return comparable(
        places.groupBy("place_of", "city", "state").agg(F.count(F.lit(1)).alias("rows_seen"))
    )


def order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, extracted twice: open ones have been delivered by the second time."""
    raw = raw_view(spark, sf_dir, "raw_orders")
    was_open = F.col("order_status").isin("shipped", "processing", "invoiced", "approved")
    first = raw.withColumn(EXTRACTED_AT, F.lit("2024-01-01").cast("timestamp"))
    second = (
        raw.filter(was_open)
        .withColumn("order_status", F.lit("delivered"))
        .withColumn(EXTRACTED_AT, F.lit("2024-01-02").cast("timestamp"))
    )
    return first.unionByName(second)


def newest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = order_batches(spark, sf_dir)
    return comparable(latest_per_key(batches, RAW_TABLES["raw_orders"].key))


def upsert_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as of the first batch, upserted with those the second batch touches.

    The first batch knows the customers that had ordered by then. The updates
    are all other customers and those with later orders.
    """
    raw = partial(raw_table, spark, sf_dir)
    customers, orders = derive("stg_customers", raw), derive("stg_orders", raw)
    start = F.lit(SECOND_BATCH_FROM).cast("timestamp")
    late = F.coalesce(F.col("order_purchase_at") >= start, F.lit(True))  # undated ones came last
    seen = orders.groupBy("customer_id").agg(
        F.count_if(~late).alias("early"), F.count_if(late).alias("late")
    )
    old = seen.filter("early > 0")
    settled = seen.filter("early > 0 and late = 0")
    target = gold.dim_customers(
        customers.join(old, "customer_id", "left_semi"), orders.filter(~late)
    )
    updates = gold.dim_customers(
        customers.join(settled, "customer_id", "left_anti"), orders
    )
    return comparable(upsert(target, updates, ["customer_id"]))


def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from two folders whose files have one name; the first one's was extracted twice."""
    places = raw_view(spark, sf_dir, "raw_geolocation")

    def extracted(rows: DataFrame, folder: str, day: str) -> DataFrame:
        stamped = stamp_lineage(rows, F.lit("part-0.csv"), F.lit(f"{folder}/part-0.csv"))
        return stamped.withColumn(EXTRACTED_AT, F.lit(day).cast("timestamp"))

    even = places.filter(F.col("geolocation_zip_code_prefix").cast("int") % 2 == 0)
    history = extracted(places, "a", "2024-01-01").unionByName(extracted(even, "a", "2024-01-02"))
    history = history.unionByName(extracted(places, "b", "2024-01-01"))
    return comparable(latest_per_file(history).drop(SOURCE_PATH))


def upsert_dim_payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment types as of the first payments, upserted with those of all; both know a null type."""
    payments = derive("stg_order_payments", partial(raw_table, spark, sf_dir))
    first = payments.filter("payment_sequential = 1")
    target, updates = gold.dim_payment_types(first), gold.dim_payment_types(payments)
    return comparable(upsert(upsert(target, updates, ["payment_type"]), updates, ["payment_type"]))


def incremental_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a first day, updated by those of a second: new, dearer and unusable ones.

    On the first day file a also has lines without a number. On the second day it comes
    again with other ones, so those of the first day go; file b comes for the first time.
    """
    key = RAW_TABLES["raw_order_items"].key
    view = raw_view(spark, sf_dir, "raw_order_items")
    rest = [c for c in view.columns if c not in key]
    lines = view.groupBy(*key).agg(*(F.min(c).alias(c) for c in rest))  # numbers repeat in the test tables
    order = F.col("order_id").cast("long")
    unnumbered = lines.withColumn("order_item_id", F.lit(None).cast("int"))

    def extracted(rows: DataFrame, file: str, day: str) -> DataFrame:
        stamped = stamp_lineage(rows, F.lit(f"{file}.csv"), F.lit(f"raw/{file}.csv"))
        return stamped.withColumn(EXTRACTED_AT, F.lit(day).cast("timestamp"))

    monday = extracted(
        lines.filter(order % 5 != 0).unionByName(unnumbered.filter(order % 40 == 1)), "a", "2024-01-01"
    )
    again = lines.filter(order % 7 == 0).withColumns(
        {
            "price": F.col("price") + 1,
            "product_id": F.when(order % 3 != 0, F.col("product_id")),
        }
    )
    tuesday = extracted(
        again.filter(order % 5 != 0).unionByName(unnumbered.filter(order % 40 == 3)), "a", "2024-01-02"
    ).unionByName(
        extracted(lines.filter((order % 5 == 0) & (order % 7 != 0)), "b", "2024-01-02")
    )
    stored = silver_rows("stg_order_items", newest_rows(monday, key))
    came = arrived(tuesday, key)
    built, keys = silver_update("stg_order_items", stored, came, {})
    return comparable(merged(stored, built, keys, came.files, key).drop(FILE))


def incremental_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of a first day, updated by some that changed and by categories that got another name."""
    products = raw_table(spark, sf_dir, "raw_products")
    names = raw_table(spark, sf_dir, "raw_category_translation")
    part = F.col("product_id").cast("long")
    moved = products.filter(part % 9 == 0).withColumn(
        "product_category_name", F.lower(F.lit("PROMO_pt"))
    )
    renamed = names.filter(F.col("product_category_name").like("%s%")).withColumn(
        "product_category_name_english", F.upper("product_category_name_english")
    )
    key, name_key = RAW_TABLES["raw_products"].key, RAW_TABLES["raw_category_translation"].key
    stored = silver_rows("stg_products", newest_rows(products, key), [names])
    state = names.join(renamed, list(name_key), "left_anti").unionByName(renamed)
    came = arrived(moved, key)
    lists = {"raw_category_translation": (state, arrived(renamed, name_key))}
    built, keys = silver_update("stg_products", stored, came, lists)
    return comparable(merged(stored, built, keys, came.files, key).drop(FILE))


def incremental_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the first orders; then orders come in, and some of the first turn out to be others'."""
    raw = partial(raw_table, spark, sf_dir)
    customers, orders = derive("stg_customers", raw), derive("stg_orders", raw)
    number = F.col("order_id").cast("long")
    other = F.col("customer_id").cast("long") % 7 + 1
    mistaken = F.when(number % 3 == 0, other.cast("string")).otherwise(F.col("customer_id"))
    first = orders.filter(number % 10 != 0).withColumn("customer_id", mistaken)
    changed = (number % 10 == 0) | (number % 3 == 0)
    touched = first.filter(changed).select("customer_id")
    ids = touched.unionByName(orders.filter(changed).select("customer_id")).distinct()
    stored = gold.dim_customers(customers, first)
    updates = entity_update("dim_customers", customers, orders, ids)
    return comparable(rebuilt(stored, updates, ids, ["customer_id"]))


def since_query(fact: str) -> Query:
    """A fact of the first batch with the months of the second rebuilt.

    What the first state has of these months, and of rows without a time, is out of
    date: other keys, and each row twice.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = partial(raw_table, spark, sf_dir)
        step, (source, time) = STEPS[fact], FACT_TIMES[fact]
        inputs = {name: derive(name, raw) for name in step.inputs}
        month = F.expr(*PARTITIONS[fact].values())
        start = date.fromisoformat(SECOND_BATCH_FROM[:10])
        later = (F.col(time) >= F.lit(start)) | F.col(time).isNull()

        def built(rows) -> DataFrame:
            return step.build(*(rows(df) if n == source else df for n, df in inputs.items()))

        rebuilt = built(lambda df: df.filter(later))
        key = step.key[0]
        stale = rebuilt.withColumn(key, F.concat(F.lit("old-"), key))
        first = built(lambda df: df.filter(~later)).unionByName(stale).unionByName(rebuilt)
        return comparable(replace_from(first, rebuilt, month, start.year * 100 + start.month))

    return run


def merged_query(mart: str) -> Query:
    """A mart merged from monthly summaries."""
    build, inputs = MERGED[mart]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = partial(raw_table, spark, sf_dir)
        made: dict[str, DataFrame] = {}

        def get(name: str) -> DataFrame:
            if name not in made:
                summary = SUMMARIES.get(name)
                if summary is None:
                    made[name] = derive(name, raw)
                else:
                    fact = with_month(get(summary.fact), summary.fact)
                    made[name] = summary.build(fact, *map(get, summary.inputs))
            return made[name]

        return comparable(build(*map(get, inputs)))

    return run


def audit_query(checks) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made: dict[str, DataFrame] = {}

        def read(name: str) -> DataFrame:
            if name not in made:
                made[name] = derive(name, partial(raw_table, spark, sf_dir))
            return made[name]

        return comparable(audit(checks, read))

    return run


def audit_months_query(fact: str) -> Query:
    """The audit of a fact month by month, as from its monthly key counts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        check = GOLD_CHECKS[fact]
        (month,) = PARTITIONS[fact]
        raw = partial(raw_table, spark, sf_dir)
        counted = key_counts(with_month(derive(fact, raw), fact), check, month)
        parents = {parent: derive(parent, raw) for _, parent in check.parents}
        return comparable(audit_counts(counted, check, parents, month))

    return run


QUERIES: dict[str, Query] = {
    **{f"bronze_{name.removeprefix('raw_')}": bronze_query(name) for name in RAW_TABLES},
    **{name: table_query(name) for name in STEPS},
    "preview_products": preview_products,
    "clean_locations": clean_locations,
    "latest_per_key": newest_orders,
    "latest_per_file": newest_files,
    "upsert_dim_customers": upsert_dim_customers,
    "upsert_dim_payment_types": upsert_dim_payment_types,
    "incremental_order_items": incremental_order_items,
    "incremental_products": incremental_products,
    "incremental_dim_customers": incremental_dim_customers,
    "since_fct_sales": since_query("fct_sales"),
    "since_fct_order_reviews": since_query("fct_order_reviews"),
    **{f"merged_{name}": merged_query(name) for name in MERGED},
    "audit_silver": audit_query(SILVER_CHECKS),
    "audit_gold": audit_query(GOLD_CHECKS),
    "audit_months_fct_sales": audit_months_query("fct_sales"),
    "audit_months_fct_order_reviews": audit_months_query("fct_order_reviews"),
}
