"""Silver: typed, renamed and cleaned tables. DataFrames in, DataFrame out.

Every transform but `products` is a narrow projection and filter: no shuffle,
and the null-key filter reaches the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smelter.functions import columns as C, rules
from smelter.schemas import MONEY
from smelter.sources.csv import EXTRACTED_AT


def _has(*names: str) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with delivery metrics; an undelivered order is never on time."""
    times = {
        "order_purchase_at": "order_purchase_timestamp",
        "order_approved_at": "order_approved_at",
        "shipped_at": "order_delivered_carrier_date",
        "delivered_at": "order_delivered_customer_date",
        "estimated_delivery_at": "order_estimated_delivery_date",
    }
    typed = raw_orders.filter(_has("order_id")).select(
        "order_id",
        "customer_id",
        "order_status",
        *(C.timestamp_of(raw_orders, old).alias(new) for new, old in times.items()),
        EXTRACTED_AT,
    )
    return typed.withColumns(
        {
            "delivery_days": F.datediff("delivered_at", "order_purchase_at"),
            "is_on_time": C.is_true(F.col("delivered_at") <= F.col("estimated_delivery_at")),
        }
    )


def order_items(raw_order_items: DataFrame) -> DataFrame:
    """Order lines with a line key and the total of price and freight."""
    price, freight = F.col("price"), F.col("freight_value")
    return raw_order_items.filter(_has("order_id", "product_id")).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.concat("order_id", F.lit("_"), F.col("order_item_id").cast("string")).alias(
            "order_line_id"
        ),
        price.cast(MONEY).alias("price"),
        freight.cast(MONEY).alias("freight_value"),
        (price + freight).cast(MONEY).alias("line_total"),
        C.timestamp_of(raw_order_items, "shipping_limit_date").alias("shipping_limit_at"),
        EXTRACTED_AT,
    )


def order_payments(raw_order_payments: DataFrame) -> DataFrame:
    return raw_order_payments.filter(_has("order_id")).select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        F.col("payment_value").cast(MONEY).alias("payment_value"),
        EXTRACTED_AT,
    )


def _place(city: str, state: str, tidy: bool) -> tuple[Column, Column]:
    """City and state; `tidy` also removes stray blanks and evens out case."""
    if tidy:
        return C.tidy_place(F.col(city)), C.tidy_code(F.col(state))
    return F.initcap(city), F.col(state)


def customers(raw_customers: DataFrame, tidy: bool = False) -> DataFrame:
    city, state = _place("customer_city", "customer_state", tidy)
    return raw_customers.filter(_has("customer_id")).select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code"),
        city.alias("city"),
        state.alias("state"),
        EXTRACTED_AT,
    )


def sellers(raw_sellers: DataFrame, tidy: bool = False) -> DataFrame:
    city, state = _place("seller_city", "seller_state", tidy)
    return raw_sellers.filter(_has("seller_id")).select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code"),
        city.alias("city"),
        state.alias("state"),
        EXTRACTED_AT,
    )


def products(raw_products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    """Products with an English category, or the original name where there is none.

    The translation is a short list, so Spark broadcasts it once it has seen
    its size; no hint forces that, and a large list would still be joined.
    """
    length, height, width = (
        C.whole_or_double(raw_products, f"product_{side}_cm")
        for side in ("length", "height", "width")
    )
    measured = raw_products.filter(_has("product_id")).select(
        "product_id",
        F.col("product_category_name").alias("category_name_pt"),
        F.col("product_weight_g").cast(MONEY).alias("weight_grams"),
        (length * height * width).alias("volume_cm3"),
        EXTRACTED_AT,
    )
    return translated(measured, raw_category_translation)


def translated(products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    """Add the English category to products, or the original name where there is none."""
    english = raw_category_translation.select(
        F.col("product_category_name").alias("category_name_pt"),
        F.col("product_category_name_english").alias("_english"),
    )
    rest = [c for c in products.columns if c not in ("product_id", "category_name_pt")]
    return products.join(english, "category_name_pt", "left").select(
        "product_id",
        "category_name_pt",
        F.coalesce("_english", "category_name_pt").alias("category_name"),
        *rest,
    )


def order_reviews(raw_order_reviews: DataFrame) -> DataFrame:
    """Reviews with a sentiment; broken rows keep a null score and time."""
    score = C.digits_to_int(F.col("review_score"))
    return raw_order_reviews.filter(_has("review_id")).select(
        "review_id",
        "order_id",
        score.alias("review_score"),
        rules.sentiment(score).alias("review_sentiment"),
        "review_comment_title",
        "review_comment_message",
        C.dated_timestamp(F.col("review_creation_date")).alias("review_created_at"),
        EXTRACTED_AT,
    )
