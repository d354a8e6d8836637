from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from smelter.plans import gold
from tests.conftest import rows

CUSTOMERS = "customer_id string, customer_unique_id string, zip_code string, city string, state string"
ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_at timestamp,"
    " delivered_at timestamp, delivery_days int, is_on_time boolean"
)
ITEMS = (
    "order_line_id string, order_id string, product_id string, seller_id string,"
    " price decimal(10,2), freight_value decimal(10,2), line_total decimal(10,2)"
)
PRODUCTS = (
    "product_id string, category_name string, category_name_pt string,"
    " weight_grams decimal(10,2), volume_cm3 bigint"
)
SELLERS = "seller_id string, zip_code string, city string, state string"


def order(key, customer="c1", status="delivered", day="2018-01-01", days=1, on_time=True):
    return (key, customer, status, day and f"{day} 10:00:00", None, days, on_time)


def item(order_id, product="p1", seller="s1", price="10.00", line=1):
    return (f"{order_id}_{line}", order_id, product, seller, price, "1.00", None)


def test_dim_customers(table):
    customers = table(CUSTOMERS, ("c1", "u", "01", "X", "SP"), ("c2", "u", "01", "X", None))
    orders = table(ORDERS, order("o1"), order("o2"), order("o3", None), order("o4", "stranger"))
    got = gold.dim_customers(customers, orders)
    assert rows(got.select("customer_id", "region", "total_orders"), "customer_id") == [
        ("c1", "Southeast", 2), ("c2", "North", 0),
    ]


def test_dim_products(table):
    products = table(PRODUCTS, ("p1", "a", "a", "499.99", 1), ("p2", None, None, None, None))
    items = table(ITEMS, item("o1"), item("o2", price="0.01"), item("o3", price=None))
    got = gold.dim_products(products, items).drop("category_name_pt", "volume_cm3", "weight_grams")
    assert rows(got, "product_id") == [
        ("p1", "a", "Small", 3, Decimal("10.01"), Decimal("5.005000")),
        ("p2", None, "Extra Large", 0, Decimal("0.00"), Decimal("0.000000")),
    ]


def test_dim_sellers(table):
    sellers = table(SELLERS, ("s1", "1", "X", "DF"), ("s2", "1", "X", "RS"))
    items = table(
        ITEMS, item("o1", price="49999.99"), item("o1", line=2, price="0.01"), item("o2", seller=None)
    )
    got = gold.dim_sellers(sellers, items).drop("zip_code", "city")
    assert rows(got, "seller_id") == [
        ("s1", "DF", "Other", 1, Decimal("50000.00"), "Gold"),
        ("s2", "RS", "South", 0, Decimal("0.00"), "Bronze"),
    ]


def test_dim_dates(table):
    orders = table(
        ORDERS,
        order("a", day="2018-12-31"),
        order("b", day="2017-01-01"),
        order("c", day="2017-01-01"),
        order("d", day=None),
    )
    got = [r[:1] + r[2:] for r in rows(gold.dim_dates(orders))]
    assert got == [
        (20170101, 2017, 1, 1, "January", "2017-01", 52, 1, "Sunday", True),
        (20181231, 2018, 4, 12, "December", "2018-12", 1, 2, "Monday", False),
    ]


GEO = (
    "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
    " geolocation_city string, geolocation_state string"
)


def test_dim_geolocation(table):
    points = table(
        GEO,
        ("01", 1.0, 2.0, "sao paulo", "SP"),
        ("01", 3.0, None, "rio", None),
        ("01", 5.0, 4.0, None, None),
        (None, None, None, "manaus", "AM"),
    )
    assert rows(gold.dim_geolocation(points), "zip_code") == [
        (None, "Manaus", "AM", None, None, "North", 1),
        ("01", "Sao Paulo", "SP", 3.0, 3.0, "Southeast", 3),
    ]


PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int,"
    " payment_value decimal(10,2)"
)


def test_dim_payment_types(table):
    payments = table(
        PAYMENTS,
        ("o1", 1, "credit_card", 3, "10.00"),
        ("o1", 2, "credit_card", 2, "10.01"),
        ("o2", 1, "boleto", None, "9.99"),
        ("o3", 1, None, 1, None),
    )
    got = rows(gold.dim_payment_types(payments), "payment_type")
    assert got == [
        (None, None, 1, 1, None, None, 1.0, None),
        ("boleto", "Boleto Bancario", 1, 1, Decimal("9.99"), Decimal("9.99"), None, Decimal("33.30")),
        ("credit_card", "Credit Card", 2, 1, Decimal("20.01"), Decimal("10.01"), 2.5, Decimal("66.70")),
    ]


def test_payments_worth_nothing(table):
    payments = table(PAYMENTS, ("o1", 1, "voucher", 1, "0.00"))
    assert gold.dim_payment_types(payments).first().value_share_pct is None


def test_dim_order_status(table):
    orders = table(
        ORDERS,
        order("a", days=1),
        order("b", days=2, on_time=False),
        order("c", days=None, on_time=False),
        order("d", status="on_hold", days=None, on_time=False),
    )
    assert rows(gold.dim_order_status(orders), "status_code") == [
        ("delivered", "Delivered", "Completed", True, 3, 1.5, 1, 33.3, 75.0),
        ("on_hold", "On_hold", "Other", False, 1, None, 0, 0.0, 25.0),
    ]


def plain_categories(products, items):
    """The category figures by definition: left join, then group."""
    by_product = defaultdict(list)
    for i in items:
        by_product[i[2]].append(i)
    groups = defaultdict(lambda: (set(), set(), [], []))
    for p in products:
        found, orders, lines, prices = groups[p[1], p[2]]
        found.add(p[0])
        for i in by_product[p[0]]:
            orders.add(i[1])
            lines.append(i[0])
            prices.append(Decimal(i[4]))
    total = sum(sum(g[3]) for g in groups.values()) or 1
    return {
        key: (
            len(g[0]),
            len(g[1]),
            len(g[2]),
            sum(g[3]),
            round(float(sum(g[3]) / total * 100), 1),
        )
        for key, g in groups.items()
        if key[0] is not None
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_dim_categories_by_definition(table, seed):
    rng = random.Random(seed)
    names = [("a", "a_pt"), ("a", "a2_pt"), ("b", "b"), (None, None), ("unsold", "unsold")]
    products = [(f"p{i}", *names[i % 4], None, None) for i in range(20)]
    products += [("p1", *names[2], None, None), ("p99", *names[4], None, None)]
    items = [
        item(f"o{rng.randrange(30)}", f"p{rng.choice([0, 0, 0, rng.randrange(25)])}",
             price=f"{rng.randrange(1000)}.{rng.randrange(100):02}", line=n)
        for n in range(200)
    ]
    got = gold.dim_categories(table(PRODUCTS, *products), table(ITEMS, *items)).collect()
    assert {
        (r.category_name, r.category_name_pt): (
            r.product_count, r.order_count, r.items_sold, r.total_revenue,
            round(float(r.revenue_share_pct), 1),
        )
        for r in got
    } == plain_categories(products, items)
    assert len({r.category_id for r in got}) == len(got)


def test_categories_without_sales(table):
    got = gold.dim_categories(table(PRODUCTS, ("p", "a", "a", None, None)), table(ITEMS))
    (row,) = got.drop("category_id").collect()
    assert tuple(row) == (
        "a", "a", 1, 0, 0, Decimal("0.00"), Decimal("0.00"), "Tier 4 (Low)", Decimal("0.00"),
    )


def test_uncategorised_revenue_counts_in_the_total(table):
    products = table(PRODUCTS, ("p1", "a", "a", None, None), ("p2", None, None, None, None))
    items = table(ITEMS, item("o1", "p1", price="25.00"), item("o2", "p2", price="75.00"))
    (row,) = gold.dim_categories(products, items).collect()
    assert row.revenue_share_pct == Decimal("25.00")


def test_fct_sales(table):
    items = table(
        ITEMS,
        item("o1"),
        item("o1", "nothing", "nobody", line=2),
        item("o2", seller=None),
        item("orphan"),
    )
    orders = table(ORDERS, order("o1"), order("o2", "stranger"), order("empty"))
    customers = table(CUSTOMERS, ("c1", "u", "1", "X", "SP"))
    products = table(PRODUCTS, ("p1", "a", "a", None, None))
    sellers = table(SELLERS, ("s1", "1", "X", "SP"))
    got = gold.fct_sales(items, orders, customers, products, sellers)
    picked = got.select(
        "order_line_id", "customer_id", "date_key", "category_name",
        "customer_state", "seller_state", "is_same_state",
    )
    assert rows(picked, "order_line_id") == [
        ("o1_1", "c1", 20180101, "a", "SP", "SP", True),
        ("o1_2", "c1", 20180101, None, "SP", None, False),
        ("o2_1", "stranger", 20180101, "a", None, None, False),
    ]


def test_fct_order_reviews(table):
    reviews = table(
        "review_id string, order_id string, review_created_at timestamp, review_score int,"
        " review_sentiment string",
        ("r1", "o1", "2018-02-03 00:00:00", 5, "positive"),
        ("r2", "orphan", None, None, "unknown"),
    )
    got = gold.fct_order_reviews(reviews, table(ORDERS, order("o1")))
    assert rows(got, "review_id") == [
        ("r1", "o1", "c1", 20180101, 20180203, 5, "positive", "delivered", 1, True),
        ("r2", "orphan", None, None, None, None, "unknown", None, None, None),
    ]
