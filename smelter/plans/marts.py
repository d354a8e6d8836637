"""Marts: the questions behind the dashboards, asked of the gold tables.

Revenue is the sum of item prices, without freight. Orders and people are
counted exactly; where an estimate will do, pass `distinct=F.approx_count_distinct`,
which shuffles one small sketch per group and task instead of every order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from smelter.functions import columns as C
from smelter.operators.ranking import add_ranks
from smelter.operators.shares import grand_total

REVENUE = "decimal(18,2)"

Distinct = Callable[[str], Column]


def _revenue(price: str = "price") -> Column:
    return F.coalesce(F.sum(price), F.lit(0)).cast(REVENUE).alias("revenue")


def executive(
    fct_sales: DataFrame, dim_customers: DataFrame, distinct: Distinct = F.count_distinct
) -> DataFrame:
    """Revenue, orders, customers and average order value, in one row.

    Lines are first summed per order, so the two distinct counts run over
    orders, not lines. A customer is a person (customer_unique_id), who may own
    several customer_ids.
    """
    per_order = fct_sales.groupBy("order_id", "customer_id").agg(_revenue())
    people = dim_customers.select("customer_id", "customer_unique_id")
    totals = per_order.join(people, "customer_id", "left").agg(
        _revenue("revenue"),
        distinct("order_id").alias("orders"),
        distinct("customer_unique_id").alias("customers"),
    )
    mean = C.decimal_mean(F.col("revenue"), F.col("orders"), 2)
    return totals.select(
        F.col("revenue").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("total_customers"),
        mean.cast(REVENUE).alias("avg_order_value"),
    )


def _sales_by(sales: DataFrame, key: str, distinct: Distinct) -> DataFrame:
    return sales.groupBy(key).agg(
        _revenue(),
        distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("items"),
    )


def sales_category(fct_sales: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    return _sales_by(fct_sales, "category_name", distinct)


def sales_state(fct_sales: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    return _sales_by(fct_sales, "customer_state", distinct)


def sales_month(
    fct_sales: DataFrame, dim_dates: DataFrame, distinct: Distinct = F.count_distinct
) -> DataFrame:
    months = dim_dates.select("date_key", "year_month")
    # sales without a date are a month of their own
    return _sales_by(fct_sales.join(months, "date_key", "left"), "year_month", distinct)


def customer_region(dim_customers: DataFrame) -> DataFrame:
    """People, accounts and orders by region and state."""
    return dim_customers.groupBy("region", "state").agg(
        F.count_distinct("customer_unique_id").alias("customers"),
        F.count(F.lit(1)).alias("accounts"),
        F.sum("total_orders").alias("orders"),
    )


def customer_repeat(dim_customers: DataFrame) -> DataFrame:
    """People by how often they bought: never, once, or again."""
    people = dim_customers.groupBy("customer_unique_id").agg(
        F.sum("total_orders").alias("bought")
    )
    kind = (
        F.when(F.col("bought") == 0, "no orders")
        .when(F.col("bought") == 1, "one-time")
        .otherwise("repeat")
    )
    kinds = people.groupBy(kind.alias("customer_kind")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("bought").alias("orders")
    )
    count = F.col("customers")
    return kinds.select("*", C.percent(count, grand_total(count), 2).alias("share_pct"))


def seller_rank(fct_sales: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Sellers with sales, punctuality, and rank by revenue overall and in their state.

    Both ranks come from one count of sellers per state and revenue. That count
    and the rows each sum the sales up; the count reads two columns for it.
    """
    sold = fct_sales.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("items"),
        _revenue(),
        F.count_if("is_on_time").alias("on_time"),
    )
    sellers = dim_sellers.select(
        "seller_id", F.col("state").alias("seller_state"), "seller_tier"
    ).join(sold, "seller_id", "left")
    board = sellers.select(
        "seller_id",
        "seller_state",
        "seller_tier",
        C.or_zero(F.col("orders")).alias("orders"),
        C.or_zero(F.col("items")).alias("items"),
        C.or_zero(F.col("revenue")).cast(REVENUE).alias("revenue"),
        C.percent(F.col("on_time"), F.col("items"), 1).alias("on_time_rate_pct"),
    )
    return add_ranks(
        board, "revenue", {"revenue_rank": (), "state_rank": ("seller_state",)}
    )


def delivery(fct_sales: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Delivery time and punctuality by month and customer state, per order."""
    placed = fct_sales.select(
        "order_id", "date_key", "customer_state", "delivery_days", "is_on_time"
    ).distinct()
    months = dim_dates.select("date_key", "year_month")
    by_month = placed.join(months, "date_key", "left").groupBy("year_month", "customer_state")
    return by_month.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("delivery_days").alias("delivered"),
        F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
        C.percent(F.count_if("is_on_time"), F.count(F.lit(1)), 1).alias("on_time_rate_pct"),
    )


def satisfaction(fct_order_reviews: DataFrame) -> DataFrame:
    """Reviews by sentiment, with score and delivery time."""
    return fct_order_reviews.groupBy("review_sentiment").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.round(F.avg("review_score"), 2).alias("avg_score"),
        F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
        C.percent(F.count_if("is_on_time"), F.count("is_on_time"), 1).alias("on_time_rate_pct"),
    )
