from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from smelter.plans import silver
from tests.conftest import rows

ORDERS = (
    "order_id string, customer_id string, order_status string,"
    " order_purchase_timestamp {t}, order_approved_at {t},"
    " order_delivered_carrier_date {t}, order_delivered_customer_date {t},"
    " order_estimated_delivery_date {t}, _extracted_at timestamp"
)
ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string,"
    " shipping_limit_date timestamp, price decimal(10,2), freight_value decimal(10,2),"
    " _extracted_at timestamp"
)
NOW = "2024-01-01 00:00:00"


@pytest.mark.parametrize("type_", ["timestamp", "string"])
def test_orders(table, type_):
    def order(key, bought, delivered, promised):
        return (key, "c", "delivered", bought, None, None, delivered, promised, NOW)

    raw = table(
        ORDERS.format(t=type_),
        order("late evening", "2018-01-01 23:59:00", "2018-01-03 01:00:00", "2018-01-03 01:00:00"),
        order("too late", "2018-01-01 00:00:00", "2018-01-05 00:00:01", "2018-01-05 00:00:00"),
        order("undelivered", "2018-01-01 00:00:00", None, "2018-01-05 00:00:00"),
        order("no promise", "2018-01-01 00:00:00", "2018-01-05 00:00:00", None),
        order(None, "2018-01-01 00:00:00", None, None),
    )
    got = silver.orders(raw).select("order_id", "delivery_days", "is_on_time")
    assert dict((r[0], r[1:]) for r in rows(got)) == {
        "late evening": (2, True),
        "too late": (4, False),
        "undelivered": (None, False),
        "no promise": (4, False),
    }
    assert silver.orders(raw).columns == [
        "order_id", "customer_id", "order_status", "order_purchase_at", "order_approved_at",
        "shipped_at", "delivered_at", "estimated_delivery_at", "_extracted_at",
        "delivery_days", "is_on_time",
    ]


def test_unusable_order_time_is_null(table):
    raw = table(
        ORDERS.format(t="string"), ("a", "c", "x", "", "soon", None, "2018-13-45", None, NOW)
    )
    (row,) = silver.orders(raw).collect()
    assert row.order_purchase_at is None and row.order_approved_at is None
    assert row.delivered_at is None and row.delivery_days is None and row.is_on_time is False


def test_order_items(table):
    raw = table(
        ITEMS,
        ("o1", 1, "p", "s", NOW, "10.10", "2.05", NOW),
        ("o1", None, "p", None, NOW, None, "2.05", NOW),
        ("o2", 1, None, "s", NOW, "1", "1", NOW),
        (None, 1, "p", "s", NOW, "1", "1", NOW),
    )
    got = silver.order_items(raw)
    assert rows(got.select("order_line_id", "price", "line_total")) == [
        ("o1_1", Decimal("10.10"), Decimal("12.15")),
        (None, None, None),
    ]
    assert dict(got.dtypes)["line_total"] == "decimal(10,2)"


def test_money_overflow_is_an_error(table):
    raw = table(ITEMS, ("o1", 1, "p", "s", NOW, "99999999.99", "0.01", NOW))
    with pytest.raises(PySparkException, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        silver.order_items(raw).collect()


def test_payments(table):
    schema = (
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value double, _extracted_at timestamp"
    )
    raw = table(schema, ("o", 1, "boleto", 1, 10.0, NOW), (None, 1, "boleto", 1, 1.0, NOW))
    assert rows(silver.order_payments(raw).drop("_extracted_at")) == [
        ("o", 1, "boleto", 1, Decimal("10.00"))
    ]


@pytest.mark.parametrize(
    "transform, prefix, own",
    [
        (silver.customers, "customer", "customer_id string, customer_unique_id string"),
        (silver.sellers, "seller", "seller_id string"),
    ],
)
def test_places(table, transform, prefix, own):
    schema = (
        f"{own}, {prefix}_zip_code_prefix string, {prefix}_city string,"
        f" {prefix}_state string, _extracted_at timestamp"
    )
    ids = own.count("string")
    raw = table(
        schema,
        (*["x"] * ids, "01037", " são  paulo", "sp", NOW),
        (*[None] * ids, "01037", "sao paulo", "SP", NOW),
    )
    place = ["zip_code", "city", "state"]
    assert rows(transform(raw).select(place)) == [("01037", " São  Paulo", "sp")]
    assert rows(transform(raw, tidy=True).select(place)) == [("01037", "São Paulo", "SP")]


PRODUCTS = (
    "product_id string, product_category_name string, product_weight_g decimal(10,2),"
    " product_length_cm {t}, product_height_cm {t}, product_width_cm {t}, _extracted_at timestamp"
)
WORDS = "product_category_name string, product_category_name_english string"


def test_products(table):
    raw = table(
        PRODUCTS.format(t="int"),
        ("known", "beleza", "100", 2, 3, 4, NOW),
        ("untranslated", "novo", "100", 2, 3, None, NOW),
        ("uncategorised", None, None, 2000, 2000, 2000, NOW),
        (None, "beleza", "1", 1, 1, 1, NOW),
    )
    words = table(WORDS, ("beleza", "beauty"), ("outro", "other"), (None, "nothing"))
    got = silver.products(raw, words).drop("_extracted_at", "weight_grams")
    assert rows(got, "product_id") == [
        ("known", "beleza", "beauty", 24),
        ("uncategorised", None, None, 8_000_000_000),
        ("untranslated", "novo", "novo", None),
    ]


def test_fractional_sizes_stay_double(table):
    raw = table(PRODUCTS.format(t="double"), ("p", None, None, 1.5, 2.0, 2.0, NOW))
    got = silver.products(raw, table(WORDS))
    assert rows(got.select("volume_cm3")) == [(6.0,)]


def test_repeated_translation_repeats_products(table):
    raw = table(PRODUCTS.format(t="int"), ("p", "beleza", "1", 1, 1, 1, NOW))
    words = table(WORDS, ("beleza", "beauty"), ("beleza", "health"))
    got = silver.products(raw, words).select("product_id", "category_name")
    assert rows(got, "category_name") == [("p", "beauty"), ("p", "health")]


def test_reviews(table):
    schema = (
        "review_id string, order_id string, review_score {s}, review_comment_title string,"
        " review_comment_message string, review_creation_date string, _extracted_at timestamp"
    )

    def review(key, score, time):
        return (key, "o", score, None, "text", time, NOW)

    raw = table(
        schema.format(s="string"),
        review("a", "5", "2018-01-18 00:00:00"),
        review("b", "abc", "bad"),
        review("c", "99999999999", "2018-13-45 00:00:00"),
        review(None, "5", None),
    )
    got = silver.order_reviews(raw)
    assert rows(got.select("review_id", "review_score", "review_sentiment"), "review_id") == [
        ("a", 5, "positive"), ("b", None, "unknown"), ("c", None, "unknown"),
    ]
    assert [str(r[0]) for r in got.orderBy("review_id").select("review_created_at").collect()] == [
        "2018-01-18 00:00:00", "None", "None",
    ]
    inferred = table(schema.format(s="int"), review("d", 3, None))
    assert rows(silver.order_reviews(inferred).select("review_sentiment")) == [("neutral",)]
