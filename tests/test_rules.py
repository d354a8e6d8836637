from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from smelter.functions import columns as C, rules


def apply(spark, rule, type_, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_size_tiers(spark):
    weights = (499.99, 500.0, 1999.99, 2000.0, 9999.99, 10000.0, None)
    assert apply(spark, rules.size_tier, "double", *weights) == [
        "Small", "Medium", "Medium", "Large", "Large", "Extra Large", "Extra Large",
    ]


def test_seller_tiers(spark):
    revenue = (None, 9999.99, 10000.0, 49999.99, 50000.0, 99999.99, 100000.0)
    assert apply(spark, rules.seller_tier, "double", *revenue) == [
        "Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold", "Platinum",
    ]


def test_category_tiers(spark):
    revenue = (None, 9999.99, 10000.0, 100000.0, 999999.99, 1000000.0)
    assert apply(spark, rules.category_tier, "double", *revenue) == [
        "Tier 4 (Low)",
        "Tier 4 (Low)",
        "Tier 3 (Medium)",
        "Tier 2 (High)",
        "Tier 2 (High)",
        "Tier 1 (Top)",
    ]


@pytest.mark.parametrize(
    "states, name",
    [
        ("SP RJ MG ES", "Southeast"),
        ("PR SC RS", "South"),
        ("MT MS GO DF", "Central-West"),
        ("BA PE CE MA PI RN PB SE AL", "Northeast"),
        ("AM PA AC RO TO RR AP XX sp", "North"),
    ],
)
def test_regions(spark, states, name):
    states = states.split()
    assert set(apply(spark, rules.region, "string", *states)) == {name}
    coarse = name if name in ("Southeast", "South") else "Other"
    assert set(apply(spark, rules.seller_region, "string", *states)) == {coarse}


def test_unknown_region(spark):
    assert apply(spark, rules.region, "string", None) == ["North"]
    assert apply(spark, rules.seller_region, "string", None) == ["Other"]


def test_payment_labels(spark):
    types = ("credit_card", "boleto", "voucher", "debit_card", "not_defined", None)
    assert apply(spark, rules.payment_label, "string", *types) == [
        "Credit Card", "Boleto Bancario", "Voucher", "Debit Card", "Not_defined", None,
    ]


def test_statuses(spark):
    expected = {
        "delivered": ("Delivered", "Completed", True),
        "shipped": ("Shipped", "In Progress", False),
        "processing": ("Processing", "In Progress", False),
        "invoiced": ("Invoiced", "In Progress", False),
        "approved": ("Approved", "In Progress", False),
        "created": ("Created", "In Progress", False),
        "canceled": ("Canceled", "Failed", True),
        "unavailable": ("Unavailable", "Failed", True),
        "on_hold": ("On_hold", "Other", False),
        None: (None, "Other", False),
    }
    found = zip(
        apply(spark, rules.status_label, "string", *expected),
        apply(spark, rules.status_category, "string", *expected),
        apply(spark, rules.is_terminal, "string", *expected),
    )
    assert list(found) == list(expected.values())


def test_sentiment(spark):
    assert apply(spark, rules.sentiment, "int", 5, 4, 3, 2, 0, None) == [
        "positive", "positive", "neutral", "negative", "negative", "unknown",
    ]


def test_weekend(spark):
    days = ("2024-06-01", "2024-06-02", "2024-06-03", None)  # Saturday to Monday
    got = apply(spark, lambda c: rules.is_weekend(c.cast("date")), "string", *days)
    assert got == [True, True, False, False]


def test_guarded_number(spark):
    texts = ("5", "05", "abc", "", " 5", "-1", "4.0", "99999999999", None)
    assert apply(spark, C.digits_to_int, "string", *texts) == [
        5, 5, None, None, None, None, None, None, None,
    ]


def test_guarded_time(spark):
    texts = ("2018-01-18 00:00:00", "2018-01-18", "2018-13-45 00:00:00", "18/01/2018", "", None)
    got = apply(spark, lambda c: C.dated_timestamp(c).cast("string"), "string", *texts)
    assert got == ["2018-01-18 00:00:00", "2018-01-18 00:00:00", None, None, None, None]


def test_date_key(spark):
    times = ("2017-01-02 23:59:59", "2018-12-31 00:00:00", None)
    got = apply(spark, lambda c: C.date_key(c.cast("timestamp")), "string", *times)
    assert got == [20170102, 20181231, None]


def test_tidy_places(spark):
    cities = ("  rio   de janeiro ", "SAO PAULO", "", None)
    assert apply(spark, C.tidy_place, "string", *cities) == [
        "Rio De Janeiro", "Sao Paulo", "", None,
    ]
    assert apply(spark, C.tidy_code, "string", " sp ", None) == ["SP", None]


def test_percent_of_nothing_is_null(spark):
    got = apply(spark, lambda c: C.percent(F.lit(1), c, 2), "int", 3, 0, None)
    assert got == [33.33, None, None]


def test_stable_id_tells_columns_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", "bc")], "x string, y string")
    ids = [r[0] for r in df.select(C.stable_id(F.col("x"), F.col("y"))).collect()]
    assert ids[0] == ids[2] != ids[1]
    assert all(0 <= i < 2**60 for i in ids)
