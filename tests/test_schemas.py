"""Column names, order and types of the silver and gold tables."""

from __future__ import annotations

from functools import partial

import pytest

from checks.queries import raw_table
from smelter.plans.steps import derive

SF = "/root/testdata/sf0.001"

SCHEMAS = {
    "stg_orders": (
        "order_id string, customer_id string, order_status string, order_purchase_at "
        "timestamp, order_approved_at timestamp, shipped_at timestamp, delivered_at "
        "timestamp, estimated_delivery_at timestamp, _extracted_at timestamp, delivery_days "
        "int, is_on_time boolean"
    ),
    "stg_order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "order_line_id string, price decimal(10,2), freight_value decimal(10,2), line_total "
        "decimal(10,2), shipping_limit_at timestamp, _extracted_at timestamp"
    ),
    "stg_order_payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments "
        "int, payment_value decimal(10,2), _extracted_at timestamp"
    ),
    "stg_customers": (
        "customer_id string, customer_unique_id string, zip_code string, city string, state "
        "string, _extracted_at timestamp"
    ),
    "stg_products": (
        "product_id string, category_name_pt string, category_name string, weight_grams "
        "decimal(10,2), volume_cm3 bigint, _extracted_at timestamp"
    ),
    "stg_sellers": (
        "seller_id string, zip_code string, city string, state string, _extracted_at "
        "timestamp"
    ),
    "stg_order_reviews": (
        "review_id string, order_id string, review_score int, review_sentiment string, "
        "review_comment_title string, review_comment_message string, review_created_at "
        "timestamp, _extracted_at timestamp"
    ),
    "dim_customers": (
        "customer_id string, customer_unique_id string, zip_code string, city string, state "
        "string, region string, total_orders bigint"
    ),
    "dim_products": (
        "product_id string, category_name string, category_name_pt string, weight_grams "
        "decimal(10,2), volume_cm3 bigint, size_tier string, times_sold bigint, "
        "total_revenue decimal(20,2), avg_selling_price decimal(16,6)"
    ),
    "dim_sellers": (
        "seller_id string, zip_code string, city string, state string, region string, "
        "total_orders bigint, total_revenue decimal(20,2), seller_tier string"
    ),
    "dim_dates": (
        "date_key int, full_date date, year_number int, quarter_number int, month_number "
        "int, month_name string, year_month string, week_of_year int, day_of_week_number "
        "int, day_of_week_name string, is_weekend boolean"
    ),
    "dim_geolocation": (
        "zip_code string, city string, state string, latitude double, longitude double, "
        "region string, data_points bigint"
    ),
    "dim_payment_types": (
        "payment_type string, payment_type_name string, transaction_count bigint, "
        "order_count bigint, total_value decimal(21,2), avg_transaction_value "
        "decimal(11,2), avg_installments double, value_share_pct decimal(27,2)"
    ),
    "dim_categories": (
        "category_id bigint, category_name string, category_name_pt string, product_count "
        "bigint, order_count bigint, items_sold bigint, total_revenue decimal(21,2), "
        "avg_price decimal(13,2), category_tier string, revenue_share_pct decimal(27,2)"
    ),
    "dim_order_status": (
        "status_code string, status_name string, status_category string, is_terminal "
        "boolean, order_count bigint, avg_delivery_days double, on_time_count bigint, "
        "on_time_rate_pct double, volume_share_pct double"
    ),
    "fct_sales": (
        "order_line_id string, order_id string, product_id string, seller_id string, "
        "customer_id string, date_key int, order_status string, order_purchase_at "
        "timestamp, delivered_at timestamp, delivery_days int, is_on_time boolean, price "
        "decimal(10,2), freight_value decimal(10,2), line_total decimal(10,2), "
        "category_name string, customer_state string, seller_state string, is_same_state "
        "boolean"
    ),
    "fct_order_reviews": (
        "review_id string, order_id string, customer_id string, order_date_key int, "
        "review_date_key int, review_score int, review_sentiment string, order_status "
        "string, delivery_days int, is_on_time boolean"
    ),
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_schema(spark, name):
    table = derive(name, partial(raw_table, spark, SF))
    assert ", ".join(f"{c} {t}" for c, t in table.dtypes) == SCHEMAS[name]
