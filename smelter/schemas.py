"""Registry of the raw tables: file pattern, column types and natural key."""

from __future__ import annotations

from dataclasses import dataclass

# The money columns are decimal from the first read, so sums are exact and do
# not depend on the order in which tasks finish. Raw amounts are read wider than
# they are stored: silver adds first and rounds then, and fails on what is too large.
MONEY = "decimal(10,2)"
RAW_MONEY = "decimal(28,10)"


@dataclass(frozen=True)
class RawTable:
    """One raw source.

    `files` is a glob under the raw root, so one file, many shards or a
    directory of parts are all read the same way. `columns` holds the types of
    the known columns; a header column that is not listed is kept as string.
    `key` is empty when rows have no identity of their own.
    """

    name: str
    files: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    free_text: bool = False


RAW_TABLES = {
    t.name: t
    for t in (
        RawTable(
            "raw_customers",
            "*customers_dataset.csv",
            {
                "customer_id": "string",
                "customer_unique_id": "string",
                "customer_zip_code_prefix": "string",
                "customer_city": "string",
                "customer_state": "string",
            },
            ("customer_id",),
        ),
        RawTable(
            "raw_orders",
            "*orders_dataset.csv",
            {
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "timestamp",
                "order_approved_at": "timestamp",
                "order_delivered_carrier_date": "timestamp",
                "order_delivered_customer_date": "timestamp",
                "order_estimated_delivery_date": "timestamp",
            },
            ("order_id",),
        ),
        RawTable(
            "raw_order_items",
            "*order_items_dataset.csv",
            {
                "order_id": "string",
                "order_item_id": "int",
                "product_id": "string",
                "seller_id": "string",
                "shipping_limit_date": "timestamp",
                "price": RAW_MONEY,
                "freight_value": RAW_MONEY,
            },
            ("order_id", "order_item_id"),
        ),
        RawTable(
            "raw_order_payments",
            "*order_payments_dataset.csv",
            {
                "order_id": "string",
                "payment_sequential": "int",
                "payment_type": "string",
                "payment_installments": "int",
                "payment_value": RAW_MONEY,
            },
            ("order_id", "payment_sequential"),
        ),
        RawTable(
            "raw_order_reviews",
            "*order_reviews_dataset.csv",
            {
                "review_id": "string",
                "order_id": "string",
                "review_score": "string",
                "review_comment_title": "string",
                "review_comment_message": "string",
                "review_creation_date": "string",
            },
            ("review_id", "order_id"),
            free_text=True,
        ),
        RawTable(
            "raw_products",
            "*products_dataset.csv",
            {
                "product_id": "string",
                "product_category_name": "string",
                "product_weight_g": RAW_MONEY,
                "product_length_cm": "double",
                "product_height_cm": "double",
                "product_width_cm": "double",
            },
            ("product_id",),
        ),
        RawTable(
            "raw_sellers",
            "*sellers_dataset.csv",
            {
                "seller_id": "string",
                "seller_zip_code_prefix": "string",
                "seller_city": "string",
                "seller_state": "string",
            },
            ("seller_id",),
        ),
        RawTable(
            "raw_geolocation",
            "*geolocation_dataset.csv",
            {
                "geolocation_zip_code_prefix": "string",
                "geolocation_lat": "double",
                "geolocation_lng": "double",
                "geolocation_city": "string",
                "geolocation_state": "string",
            },
        ),
        RawTable(
            "raw_category_translation",
            "*product_category_name_translation.csv",
            {
                "product_category_name": "string",
                "product_category_name_english": "string",
            },
            ("product_category_name",),
        ),
    )
}

# How stored tables are split into folders: column name -> SQL expression. The
# column is part of the layout only; readers get the table without it.
PARTITIONS = {
    "fct_sales": {"order_month": "date_key div 100"},
    "fct_order_reviews": {"review_month": "review_date_key div 100"},
}
APPEND_PARTITIONS = {"_ingest_date": "to_date(_extracted_at)"}

# Columns of incremental tables that readers don't see: the folder of a key, and the
# file of a row without a whole key.
BUCKET, FILE = "_bucket", "_file"

# Columns by which the rows of a month lie in clusters, if that is asked for: column -> table and
# column that its ranges are taken from.
CLUSTERS = {
    "fct_sales": {"seller_id": "stg_order_items", "customer_id": "stg_orders"},
    "fct_order_reviews": {"order_id": "stg_order_reviews", "customer_id": "stg_orders"},
}

# Input and time column that decide about the month of a fact.
FACT_TIMES = {
    "fct_sales": ("stg_orders", "order_purchase_at"),
    "fct_order_reviews": ("stg_order_reviews", "review_created_at"),
}
