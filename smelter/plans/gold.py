"""Gold: eight dimensions and two facts. DataFrames in, DataFrame out.

Facts are reduced to one row per key before they meet a dimension, and a large
side is always the side that Spark can split when one of its keys is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smelter.functions import columns as C, rules
from smelter.operators.joins import join_with_nulls
from smelter.operators.shares import grand_total


def dim_customers(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    placed = stg_orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("placed"))
    return stg_customers.join(placed, "customer_id", "left").select(
        "customer_id",
        "customer_unique_id",
        "zip_code",
        "city",
        "state",
        rules.region(F.col("state")).alias("region"),
        C.or_zero(F.col("placed")).alias("total_orders"),
    )


def dim_products(stg_products: DataFrame, stg_order_items: DataFrame) -> DataFrame:
    sold = stg_order_items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("price").alias("revenue"),
        F.avg("price").alias("mean_price"),
    )
    return stg_products.join(sold, "product_id", "left").select(
        "product_id",
        "category_name",
        "category_name_pt",
        "weight_grams",
        "volume_cm3",
        rules.size_tier(F.col("weight_grams")).alias("size_tier"),
        C.or_zero(F.col("lines")).alias("times_sold"),
        C.or_zero(F.col("revenue")).alias("total_revenue"),
        C.or_zero(F.col("mean_price")).alias("avg_selling_price"),
    )


def dim_sellers(stg_sellers: DataFrame, stg_order_items: DataFrame) -> DataFrame:
    """Sellers with distinct orders and a revenue tier.

    The distinct count shuffles on (seller, order), so a seller with a third of
    all lines is spread over many tasks.
    """
    sold = stg_order_items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("price").alias("revenue")
    )
    return stg_sellers.join(sold, "seller_id", "left").select(
        "seller_id",
        "zip_code",
        "city",
        "state",
        rules.seller_region(F.col("state")).alias("region"),
        C.or_zero(F.col("orders")).alias("total_orders"),
        C.or_zero(F.col("revenue")).alias("total_revenue"),
        rules.seller_tier(F.col("revenue")).alias("seller_tier"),
    )


def dim_dates(stg_orders: DataFrame) -> DataFrame:
    """Calendar of the days on which orders were placed."""
    day = F.col("full_date")
    days = (
        stg_orders.select(F.to_date("order_purchase_at").alias("full_date"))
        .filter(day.isNotNull())
        .distinct()
    )
    return days.select(
        C.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        rules.is_weekend(day).alias("is_weekend"),
    ).orderBy("full_date")


def dim_geolocation(raw_geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position and one of its (city, state) pairs.

    Points are first summed per place, which is a plain hash aggregation before
    the shuffle; what is left to choose a pair from is one row per spelling of a
    city. The chosen pair is the smallest complete one, so it does not depend on
    the order in which rows arrive.
    """
    places = raw_geolocation.groupBy(
        F.col("geolocation_zip_code_prefix").alias("zip_code"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    ).agg(
        F.sum("geolocation_lat").alias("lat_sum"),
        F.count("geolocation_lat").alias("lat_n"),
        F.sum("geolocation_lng").alias("lng_sum"),
        F.count("geolocation_lng").alias("lng_n"),
        F.count(F.lit(1)).alias("points"),
    )
    incomplete = F.isnull("city").cast("int") + F.isnull("state").cast("int")
    pair = F.struct(incomplete.alias("incomplete"), "city", "state")
    zips = places.groupBy("zip_code").agg(
        F.min(pair).alias("pair"),
        F.try_divide(F.sum("lat_sum"), F.sum("lat_n")).alias("latitude"),
        F.try_divide(F.sum("lng_sum"), F.sum("lng_n")).alias("longitude"),
        F.sum("points").alias("data_points"),
    )
    return zips.select(
        "zip_code",
        F.initcap("pair.city").alias("city"),
        F.col("pair.state").alias("state"),
        "latitude",
        "longitude",
        rules.region(F.col("pair.state")).alias("region"),
        "data_points",
    )


def dim_payment_types(stg_order_payments: DataFrame) -> DataFrame:
    by_type = stg_order_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("payment_value").alias("value"),
        F.avg("payment_value").alias("mean_value"),
        F.avg("payment_installments").alias("mean_installments"),
    )
    share = C.percent(F.col("value"), grand_total(F.col("value")), 2)
    return by_type.select(
        "payment_type",
        rules.payment_label(F.col("payment_type")).alias("payment_type_name"),
        "transaction_count",
        "order_count",
        F.round("value", 2).alias("total_value"),
        F.round("mean_value", 2).alias("avg_transaction_value"),
        F.round("mean_installments", 1).alias("avg_installments"),
        share.alias("value_share_pct"),
    )


def dim_categories(stg_products: DataFrame, stg_order_items: DataFrame) -> DataFrame:
    """Categories with sales, tier and share of revenue.

    Joining all products to their lines and grouping would put the lines on the
    side of an outer join that cannot be split, and count two distincts over
    every line. Instead the lines meet the products in an inner join, where a
    best-selling product can be split over tasks; products without sales are
    counted from the products alone; and the two are matched per category.

    The share is taken before the row without a category is dropped, because
    its revenue belongs to the total.
    """
    category = ["category_name", "category_name_pt"]
    catalog = stg_products.groupBy(*category).agg(
        F.count_distinct("product_id").alias("product_count")
    )
    sold = (
        stg_order_items.select("product_id", "order_id", "order_line_id", "price")
        .join(stg_products.select("product_id", *category), "product_id")
        .groupBy(*category)
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count("order_line_id").alias("lines"),
            F.sum("price").alias("revenue"),
            F.avg("price").alias("mean_price"),
        )
    )
    revenue = C.or_zero(F.col("revenue"))
    total = F.coalesce(F.nullif(grand_total(F.col("revenue")), F.lit(0)), F.lit(1))
    shared = join_with_nulls(catalog, sold, category, "left").withColumn(
        "revenue_share_pct", C.percent(revenue, total, 2)
    )
    return shared.filter(F.col("category_name").isNotNull()).select(
        C.stable_id(*map(F.col, category)).alias("category_id"),
        *category,
        "product_count",
        C.or_zero(F.col("orders")).alias("order_count"),
        C.or_zero(F.col("lines")).alias("items_sold"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(C.or_zero(F.col("mean_price")), 2).alias("avg_price"),
        rules.category_tier(F.col("revenue")).alias("category_tier"),
        "revenue_share_pct",
    )


def dim_order_status(stg_orders: DataFrame) -> DataFrame:
    """Statuses with volume and punctuality.

    The on-time rate is taken over all orders of the status, delivered or not.
    """
    status = F.col("order_status")
    by_status = stg_orders.groupBy(status).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg("delivery_days").alias("mean_days"),
        F.count_if("is_on_time").alias("on_time_count"),
    )
    count = F.col("order_count")
    return by_status.select(
        status.alias("status_code"),
        rules.status_label(status).alias("status_name"),
        rules.status_category(status).alias("status_category"),
        rules.is_terminal(status).alias("is_terminal"),
        "order_count",
        F.round("mean_days", 1).alias("avg_delivery_days"),
        "on_time_count",
        C.percent(F.col("on_time_count"), count, 1).alias("on_time_rate_pct"),
        C.percent(count, grand_total(count), 2).alias("volume_share_pct"),
    )


def fct_sales(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    stg_products: DataFrame,
    stg_sellers: DataFrame,
) -> DataFrame:
    """One row per order line whose order exists.

    The customer's state is added to the orders before they meet the lines: the
    join with the customers then shuffles one row per order instead of one per
    line. The lines get their seller's state and product's category while they
    are narrow, and meet the orders last, so no shuffle of lines carries a column
    of the orders; what follows from a column of the orders or lines is computed
    after the joins. In each of the four joins the rows that may pile up on one key
    (orders of a customer, lines of an order, product or seller) are on the
    left of a left join or in an inner join, so AQE can split that key.
    """
    placed = stg_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_at",
        "delivered_at",
        "delivery_days",
        "is_on_time",
    ).join(
        stg_customers.select("customer_id", F.col("state").alias("customer_state")),
        "customer_id",
        "left",
    )
    lines = stg_order_items.select(
        "order_line_id",
        "order_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        "line_total",
    )
    return (
        lines.join(
            stg_sellers.select("seller_id", F.col("state").alias("seller_state")),
            "seller_id",
            "left",
        )
        .join(stg_products.select("product_id", "category_name"), "product_id", "left")
        .join(placed, "order_id")
        .select(
            "order_line_id",
            "order_id",
            "product_id",
            "seller_id",
            "customer_id",
            C.date_key(F.col("order_purchase_at")).alias("date_key"),
            "order_status",
            "order_purchase_at",
            "delivered_at",
            "delivery_days",
            "is_on_time",
            "price",
            "freight_value",
            "line_total",
            "category_name",
            "customer_state",
            "seller_state",
            C.is_true(F.col("customer_state") == F.col("seller_state")).alias("is_same_state"),
        )
    )


def fct_order_reviews(stg_order_reviews: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """One row per review; a review without its order keeps null order columns."""
    reviewed = stg_orders.select(
        "order_id",
        "customer_id",
        C.date_key(F.col("order_purchase_at")).alias("order_date_key"),
        "order_status",
        "delivery_days",
        "is_on_time",
    )
    return (
        stg_order_reviews.select(
            "review_id",
            "order_id",
            C.date_key(F.col("review_created_at")).alias("review_date_key"),
            "review_score",
            "review_sentiment",
        )
        .join(reviewed, "order_id", "left")
        .select(
            "review_id",
            "order_id",
            "customer_id",
            "order_date_key",
            "review_date_key",
            "review_score",
            "review_sentiment",
            "order_status",
            "delivery_days",
            "is_on_time",
        )
    )
