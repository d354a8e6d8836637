"""Which table is built by which transform from which tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from smelter.operators.audit import Check
from smelter.plans import gold, marts, silver
from smelter.schemas import RAW_TABLES


@dataclass(frozen=True)
class Step:
    """A table: its transform, the tables it reads and the key it is upserted by."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    key: tuple[str, ...] = ()


SILVER = {
    "stg_orders": Step(silver.orders, ("raw_orders",), ("order_id",)),
    "stg_order_items": Step(
        silver.order_items, ("raw_order_items",), ("order_id", "order_item_id")
    ),
    "stg_order_payments": Step(
        silver.order_payments, ("raw_order_payments",), ("order_id", "payment_sequential")
    ),
    "stg_customers": Step(silver.customers, ("raw_customers",), ("customer_id",)),
    "stg_products": Step(
        silver.products, ("raw_products", "raw_category_translation"), ("product_id",)
    ),
    "stg_sellers": Step(silver.sellers, ("raw_sellers",), ("seller_id",)),
    "stg_order_reviews": Step(
        silver.order_reviews, ("raw_order_reviews",), ("review_id", "order_id")
    ),
}

DIMENSIONS = {
    "dim_customers": Step(
        gold.dim_customers, ("stg_customers", "stg_orders"), ("customer_id",)
    ),
    "dim_products": Step(
        gold.dim_products, ("stg_products", "stg_order_items"), ("product_id",)
    ),
    "dim_sellers": Step(gold.dim_sellers, ("stg_sellers", "stg_order_items"), ("seller_id",)),
    "dim_dates": Step(gold.dim_dates, ("stg_orders",), ("date_key",)),
    "dim_geolocation": Step(gold.dim_geolocation, ("raw_geolocation",), ("zip_code",)),
    "dim_payment_types": Step(
        gold.dim_payment_types, ("stg_order_payments",), ("payment_type",)
    ),
    "dim_categories": Step(
        gold.dim_categories,
        ("stg_products", "stg_order_items"),
        ("category_name", "category_name_pt"),
    ),
    "dim_order_status": Step(gold.dim_order_status, ("stg_orders",), ("status_code",)),
}

#: Dimensions of entities: a row depends on the entity and on the facts that name it.
ENTITIES = ("dim_customers", "dim_products", "dim_sellers")

FACTS = {
    "fct_sales": Step(
        gold.fct_sales,
        ("stg_order_items", "stg_orders", "stg_customers", "stg_products", "stg_sellers"),
        ("order_line_id",),
    ),
    "fct_order_reviews": Step(
        gold.fct_order_reviews, ("stg_order_reviews", "stg_orders"), ("review_id", "order_id")
    ),
}

GOLD = DIMENSIONS | FACTS

MARTS = {
    "mart_executive": Step(marts.executive, ("fct_sales", "dim_customers")),
    "mart_sales_category": Step(marts.sales_category, ("fct_sales",)),
    "mart_sales_state": Step(marts.sales_state, ("fct_sales",)),
    "mart_sales_month": Step(marts.sales_month, ("fct_sales", "dim_dates")),
    "mart_customer_region": Step(marts.customer_region, ("dim_customers",)),
    "mart_customer_repeat": Step(marts.customer_repeat, ("dim_customers",)),
    "mart_seller_rank": Step(marts.seller_rank, ("fct_sales", "dim_sellers")),
    "mart_delivery": Step(marts.delivery, ("fct_sales", "dim_dates")),
    "mart_satisfaction": Step(marts.satisfaction, ("fct_order_reviews",)),
}

STEPS = SILVER | GOLD | MARTS

LAYERS = {"bronze": tuple(RAW_TABLES), "silver": tuple(SILVER), "gold": tuple(GOLD)}

SILVER_CHECKS = {
    "stg_orders": Check(("order_id",), (("customer_id", "stg_customers"),)),
    "stg_order_items": Check(
        ("order_id", "order_item_id"),
        (
            ("order_id", "stg_orders"),
            ("product_id", "stg_products"),
            ("seller_id", "stg_sellers"),
        ),
    ),
    "stg_order_payments": Check(
        ("order_id", "payment_sequential"), (("order_id", "stg_orders"),)
    ),
    "stg_customers": Check(("customer_id",)),
    "stg_products": Check(("product_id",)),
    "stg_sellers": Check(("seller_id",)),
    "stg_order_reviews": Check(("review_id", "order_id"), (("order_id", "stg_orders"),)),
}

GOLD_CHECKS = {
    **{name: Check(step.key) for name, step in DIMENSIONS.items()},
    "fct_sales": Check(
        ("order_line_id",),
        (
            ("date_key", "dim_dates"),
            ("customer_id", "dim_customers"),
            ("product_id", "dim_products"),
            ("seller_id", "dim_sellers"),
        ),
    ),
    "fct_order_reviews": Check(
        ("review_id", "order_id"), (("customer_id", "dim_customers"),)
    ),
}


def derive(table: str, raw: Callable[[str], DataFrame]) -> DataFrame:
    """`table` built from the raw tables in one lazy plan, with no layer stored."""
    made: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in made:
            step = STEPS.get(name)
            made[name] = step.build(*map(get, step.inputs)) if step else raw(name)
        return made[name]

    return get(table)
