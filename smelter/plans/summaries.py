"""Monthly summaries of the facts, and the marts merged from them.

A summary has a few rows for each month, stored in a folder of its own. Only months
whose fact files have changed are summed up again; a mart reads no lines at all. An order
belongs to one month, so its monthly distinct counts add up exactly. People come back in
other months: their ids are stored once a month, and next to them sketches, which answer
at once within a known error. Keys and references are counted by month too, so that an
audit reads the facts of changed months only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smelter.functions import columns as C
from smelter.operators.audit import audit_counts, key_counts
from smelter.operators.ranking import add_ranks
from smelter.plans.marts import REVENUE
from smelter.plans.steps import GOLD_CHECKS
from smelter.schemas import PARTITIONS
from smelter.sinks.buckets import NO_ROWS, recover_buckets, replace_folders
from smelter.sources.lake import Lake, exists, folders, read_text, remove, write_text

#: Registers of a sketch: 2 ^ 12, for a standard error of about 1.04 / 2 ^ 6 = 1.6 percent.
SKETCH_SIZE = 12
UNDATED = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Summary:
    """What is kept of a fact: `build` gets the fact with its month, and further tables."""

    fact: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()

    @property
    def month(self) -> str:
        (column,) = PARTITIONS[self.fact]
        return column


def _lines(sales: DataFrame, *keys: str) -> DataFrame:
    return sales.groupBy("order_month", *keys).agg(
        F.sum("price").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("items"),
        F.count_if("is_on_time").alias("on_time"),
    )


def categories(sales: DataFrame) -> DataFrame:
    return _lines(sales, "category_name")


def states(sales: DataFrame) -> DataFrame:
    return _lines(sales, "customer_state")


def sellers(sales: DataFrame) -> DataFrame:
    return _lines(sales, "seller_id")


def deliveries(sales: DataFrame) -> DataFrame:
    """Per order, not per line."""
    placed = sales.select(
        "order_month", "order_id", "date_key", "customer_state", "delivery_days", "is_on_time"
    ).distinct()
    return placed.groupBy("order_month", "customer_state").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("delivery_days").alias("delivered"),
        F.sum("delivery_days").alias("days"),
        F.count_if("is_on_time").alias("on_time"),
    )


def buyers(sales: DataFrame) -> DataFrame:
    return sales.select("order_month", "customer_id").distinct()


def buyer_sketches(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """One sketch of people for each month and state; null where nobody is known."""
    people = customers.select("customer_id", "customer_unique_id")
    placed = sales.select("order_month", "customer_state", "customer_id").distinct()
    known = placed.join(people, "customer_id", "left")
    return known.groupBy("order_month", "customer_state").agg(
        F.hll_sketch_agg("customer_unique_id", F.lit(SKETCH_SIZE)).alias("people")
    )


def sentiments(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_month", "review_sentiment").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("delivered"),
        F.count_if("is_on_time").alias("on_time"),
        F.count("is_on_time").alias("timed"),
    )


def sales_keys(sales: DataFrame) -> DataFrame:
    return key_counts(sales, GOLD_CHECKS["fct_sales"], "order_month")


def review_keys(reviews: DataFrame) -> DataFrame:
    return key_counts(reviews, GOLD_CHECKS["fct_order_reviews"], "review_month")


SUMMARIES = {
    "sum_categories": Summary("fct_sales", categories),
    "sum_states": Summary("fct_sales", states),
    "sum_sellers": Summary("fct_sales", sellers),
    "sum_deliveries": Summary("fct_sales", deliveries),
    "sum_buyers": Summary("fct_sales", buyers),
    "sum_buyer_sketches": Summary("fct_sales", buyer_sketches, ("dim_customers",)),
    "sum_sentiments": Summary("fct_order_reviews", sentiments),
    "sum_sales_keys": Summary("fct_sales", sales_keys),
    "sum_review_keys": Summary("fct_order_reviews", review_keys),
}
#: Where the key counts of a fact are kept.
KEY_COUNTS = {"fct_sales": "sum_sales_keys", "fct_order_reviews": "sum_review_keys"}


# --- marts from summaries -------------------------------------------------------------


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _revenue() -> Column:
    return _total("revenue").cast(REVENUE).alias("revenue")


def _year_month(month: str) -> Column:
    number = F.col(month)
    return F.format_string("%04d-%02d", F.expr(f"{month} div 100").cast("int"), (number % 100).cast("int"))


def _mean(total: str, count: str, places: int) -> Column:
    return F.round(F.try_divide(F.sum(total).cast("double"), F.sum(count)), places)


def executive(sum_states: DataFrame, sum_buyers: DataFrame, dim_customers: DataFrame) -> DataFrame:
    totals = sum_states.agg(_revenue(), _total("orders").alias("orders"))
    people = dim_customers.select("customer_id", "customer_unique_id")
    customers = (
        sum_buyers.select("customer_id").distinct().join(people, "customer_id")
        .agg(F.count_distinct("customer_unique_id").alias("customers"))
    )
    mean = C.decimal_mean(F.col("revenue"), F.col("orders"), 2)
    return totals.crossJoin(F.broadcast(customers)).select(  # one row and one row
        F.col("revenue").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("total_customers"),
        mean.cast(REVENUE).alias("avg_order_value"),
    )


def _sales_by(summary: DataFrame, key: Column) -> DataFrame:
    return summary.groupBy(key).agg(
        _revenue(), F.sum("orders").alias("orders"), F.sum("items").alias("items")
    )


def sales_category(sum_categories: DataFrame) -> DataFrame:
    return _sales_by(sum_categories, F.col("category_name"))


def sales_state(sum_states: DataFrame) -> DataFrame:
    return _sales_by(sum_states, F.col("customer_state"))


def sales_month(sum_states: DataFrame) -> DataFrame:
    dated = F.when(F.col("order_month").isNotNull(), _year_month("order_month"))
    return _sales_by(sum_states, dated.alias("year_month"))


def seller_rank(sum_sellers: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    sold = sum_sellers.groupBy("seller_id").agg(
        *(F.sum(c).alias(c) for c in ("orders", "items", "on_time")), _revenue()
    )
    board = dim_sellers.select(
        "seller_id", F.col("state").alias("seller_state"), "seller_tier"
    ).join(sold, "seller_id", "left")
    board = board.select(
        "seller_id",
        "seller_state",
        "seller_tier",
        C.or_zero(F.col("orders")).alias("orders"),
        C.or_zero(F.col("items")).alias("items"),
        C.or_zero(F.col("revenue")).cast(REVENUE).alias("revenue"),
        C.percent(F.col("on_time"), F.col("items"), 1).alias("on_time_rate_pct"),
    )
    return add_ranks(board, "revenue", {"revenue_rank": (), "state_rank": ("seller_state",)})


def delivery(sum_deliveries: DataFrame) -> DataFrame:
    dated = F.when(F.col("order_month").isNotNull(), _year_month("order_month"))
    return sum_deliveries.groupBy(dated.alias("year_month"), "customer_state").agg(
        F.sum("orders").alias("orders"),
        F.sum("delivered").alias("delivered"),
        _mean("days", "delivered", 1).alias("avg_delivery_days"),
        C.percent(F.sum("on_time"), F.sum("orders"), 1).alias("on_time_rate_pct"),
    )


def satisfaction(sum_sentiments: DataFrame) -> DataFrame:
    return sum_sentiments.groupBy("review_sentiment").agg(
        F.sum("reviews").alias("reviews"),
        _mean("score", "scored", 2).alias("avg_score"),
        _mean("days", "delivered", 1).alias("avg_delivery_days"),
        C.percent(F.sum("on_time"), F.sum("timed"), 1).alias("on_time_rate_pct"),
    )


MERGED = {
    "mart_executive": (executive, ("sum_states", "sum_buyers", "dim_customers")),
    "mart_sales_category": (sales_category, ("sum_categories",)),
    "mart_sales_state": (sales_state, ("sum_states",)),
    "mart_sales_month": (sales_month, ("sum_states",)),
    "mart_seller_rank": (seller_rank, ("sum_sellers", "dim_sellers")),
    "mart_delivery": (delivery, ("sum_deliveries",)),
    "mart_satisfaction": (satisfaction, ("sum_sentiments",)),
}


def people_estimate(sum_buyer_sketches: DataFrame, *keys: str) -> DataFrame:
    """About how many different people bought, overall or by `keys`: months are merged, not added up."""
    known = sum_buyer_sketches.filter(F.col("people").isNotNull())
    merged = known.groupBy(*keys).agg(F.hll_union_agg("people").alias("people"))
    return merged.select(*keys, F.coalesce(F.hll_sketch_estimate("people"), F.lit(0)).alias("customers"))


# --- stored summaries -------------------------------------------------------------------


def with_month(fact: DataFrame, name: str) -> DataFrame:
    """A fact with the month that it is stored under."""
    return fact.withColumns({column: F.expr(text) for column, text in PARTITIONS[name].items()})


def _months(spark: SparkSession, lake: Lake, fact: str) -> dict[str, str]:
    """For each month folder of a fact, a text that changes with its files."""
    found = folders(spark, lake.path(fact))
    return {
        name.partition("=")[2]: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()
        for name, files in found.items()
        if files
    }


def changed_months(known: Mapping[str, str], found: Mapping[str, str]) -> list[str]:
    """Months that came, changed or went."""
    return sorted(m for m in known.keys() | found.keys() if known.get(m) != found.get(m))


def of_months(fact: DataFrame, column: str, months: Collection[str]) -> DataFrame:
    """The rows of some months; the folders of others aren't read."""
    dated = F.col(column).isin([int(m) for m in months if m != UNDATED])
    return fact.filter(dated | F.col(column).isNull() if UNDATED in months else dated)


def update_summary(spark: SparkSession, lake: Lake, name: str) -> list[str]:
    """Bring a stored summary up to date; returns the months that were summed up."""
    summary, path = SUMMARIES[name], lake.path(name)
    mark = lake.mark_path(name, summary.fact)
    recover_buckets(spark, path)
    found = _months(spark, lake, summary.fact)
    known = read_text(spark, mark) if exists(spark, path) else None
    if known is None:
        remove(spark, path)
    months = changed_months(dict(line.split() for line in (known or "").splitlines()), found)
    if months or known is None:
        fact = of_months(lake.read(spark, summary.fact, layout=True), summary.month, months)
        rows = summary.build(fact, *(lake.read(spark, t) for t in summary.inputs))
        if known is None:
            rows.limit(0).drop(summary.month).write.parquet(f"{path}/{summary.month}={NO_ROWS}")
        replace_folders(spark, rows, path, summary.month, months)
        write_text(spark, mark, "\n".join(f"{m} {files}" for m, files in sorted(found.items())))
    return months


def update_summaries(spark: SparkSession, lake: Lake) -> dict[str, list[str]]:
    return {name: update_summary(spark, lake, name) for name in SUMMARIES}


def read_summary(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A stored summary, with its month."""
    return spark.read.parquet(lake.path(name))


def merged_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A mart from stored summaries and dimensions."""
    build, inputs = MERGED[name]
    return build(*(read_summary(spark, lake, t) if t in SUMMARIES else lake.read(spark, t) for t in inputs))


# --- audit from stored counts ---------------------------------------------------------


def stored_key_counts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The key counts of each fact, added up over the months: a key in two months is a duplicate too."""
    stored = {fact: read_summary(spark, lake, name) for fact, name in KEY_COUNTS.items()}
    return {fact: c.groupBy("use", "value").agg(F.sum("n").alias("n")) for fact, c in stored.items()}


def audit_months(
    spark: SparkSession, lake: Lake, fact: str, months: Collection[str] | None = None
) -> DataFrame:
    """The audit of a fact month by month: (month column, measure, row_count).

    With `months` the counts of other months aren't read. Duplicates are those within a
    month, so they add up to fewer than the audit of the fact where a key is in two months.
    """
    check, name = GOLD_CHECKS[fact], KEY_COUNTS[fact]
    column = SUMMARIES[name].month
    counted = read_summary(spark, lake, name)
    if months is not None:
        counted = of_months(counted, column, months)
    parents = {parent: lake.read(spark, parent) for _, parent in check.parents}
    return audit_counts(counted, check, parents, column)
