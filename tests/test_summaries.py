"""Monthly summaries: what they read, and that marts merged from them equal marts over all rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import smelter.__main__ as cli
from checks.queries import raw_table
from smelter.operators.audit import audit
from smelter.plans import summaries
from smelter.plans.runner import mart
from smelter.plans.steps import GOLD_CHECKS, derive
from smelter.plans.summaries import (
    KEY_COUNTS,
    MERGED,
    SUMMARIES,
    UNDATED,
    audit_months,
    changed_months,
    merged_mart,
    people_estimate,
    read_summary,
    stored_key_counts,
    update_summaries,
    update_summary,
    with_month,
)
from smelter.sinks.parquet import replace_months, replace_table
from smelter.sources import lake as lakes
from smelter.sources.lake import Lake
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def made(spark):
    """The tables that summaries and marts are built from."""
    names = ("fct_sales", "fct_order_reviews", "dim_customers", "dim_sellers", "dim_dates")
    return {n: derive(n, lambda raw: raw_table(spark, SF, raw)) for n in names}


@pytest.fixture
def lake(spark, made, tmp_path):
    built = Lake(str(tmp_path))
    for name, df in made.items():
        if name.startswith("fct_"):
            replace_table(spark, with_month(df, name), built.path(name), (next(iter(with_month(df.limit(0), name).columns[-1:])),))
        else:
            df.write.parquet(built.path(name))
    return built


def bag(df):
    columns = sorted(df.columns)
    return rows(df.select(*(F.col(c).cast("string") for c in columns)).orderBy(*columns))


def test_merged_marts_follow_the_facts(spark, lake, made):
    first = update_summaries(spark, lake)
    months = {name: sorted(lakes.folders(spark, lake.path(s.fact))) for name, s in SUMMARIES.items()}
    assert {n: [f"{SUMMARIES[n].month}={m}" for m in found] for n, found in first.items()} == months
    assert UNDATED in first["sum_states"]
    for name in MERGED:
        assert bag(merged_mart(spark, lake, name)) == bag(mart(spark, lake, name)), name
    # some sales of one month become dearer and later, those of another go, undated ones lose a line
    sales = lake.read(spark, "fct_sales")
    month = F.expr("date_key div 100")
    new = sales.filter(F.coalesce((month >= 200101) & (month != 200102), F.col("date_key").isNull()))
    new = new.withColumn("price", F.when(month == 200101, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)"))
    new.filter(F.col("date_key").isNotNull() | (F.col("order_line_id") != F.lit("67_1"))).write.parquet(f"{lake.root}/new")
    new = spark.read.parquet(f"{lake.root}/new")
    replace_months(spark, with_month(new, "fct_sales"), lake.path("fct_sales"), "order_month", 200101)
    again = update_summaries(spark, lake)
    assert again["sum_sentiments"] == []
    assert {"200101", "200102", UNDATED} <= set(again["sum_sellers"])
    assert all(m == UNDATED or m >= "200101" for m in again["sum_sellers"])
    for name in MERGED:
        assert bag(merged_mart(spark, lake, name)) == bag(mart(spark, lake, name)), name
    assert update_summaries(spark, lake) == dict.fromkeys(SUMMARIES, [])


def test_one_changed_month_reads_and_writes_one_month(spark, lake, monkeypatch):
    update_summary(spark, lake, "sum_states")
    before = lakes.folders(spark, lake.path("sum_states"))
    path = f"{lake.path('fct_sales')}/order_month=199805"
    lines = spark.read.parquet(path)
    lines.limit(1).write.mode("append").parquet(path)
    read = []
    states = summaries.SUMMARIES["sum_states"]

    def watched(sales):
        read.extend(r[0] for r in sales.select("_metadata.file_path").distinct().collect())
        assert re.search(r"PartitionFilters: \[[^]]*order_month", sales._jdf.queryExecution().toString())
        return states.build(sales)

    monkeypatch.setitem(summaries.SUMMARIES, "sum_states", summaries.Summary("fct_sales", watched))
    assert update_summary(spark, lake, "sum_states") == ["199805"]
    assert read and all("order_month=199805" in f for f in read)
    after = lakes.folders(spark, lake.path("sum_states"))
    assert [k for k in before if after[k] != before[k]] == ["order_month=199805"]
    total = read_summary(spark, lake, "sum_states").agg({"items": "sum"}).first()[0]
    assert total == lake.read(spark, "fct_sales").count()


def test_an_update_that_dies_is_done_again(spark, lake, monkeypatch):
    update_summary(spark, lake, "sum_categories")
    before = bag(read_summary(spark, lake, "sum_categories"))
    path = f"{lake.path('fct_sales')}/order_month=199805"
    spark.read.parquet(path).limit(3).write.mode("append").parquet(path)
    with monkeypatch.context() as patch:
        patch.setattr(summaries, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            update_summary(spark, lake, "sum_categories")
    assert update_summary(spark, lake, "sum_categories") == ["199805"]
    assert bag(read_summary(spark, lake, "sum_categories")) != before
    assert bag(merged_mart(spark, lake, "mart_sales_category")) == bag(mart(spark, lake, "mart_sales_category"))


def test_audit_reads_changed_months_and_equals_the_full_one(spark, lake, monkeypatch):
    checks = {fact: GOLD_CHECKS[fact] for fact in KEY_COUNTS}
    products = derive("dim_products", lambda raw: raw_table(spark, SF, raw))
    products.orderBy("product_id").limit(20).write.parquet(lake.path("dim_products"))

    def both():
        for name in KEY_COUNTS.values():
            update_summary(spark, lake, name)
        read = lambda table: lake.read(spark, table)
        stored = bag(audit(checks, read, stored_key_counts(spark, lake)))
        assert stored == bag(audit(checks, read))
        return {(table, measure): int(n) for measure, n, table in stored}

    first = both()
    assert first["fct_sales", "orphan_product_id"] > 0
    # lines of one month come again in another one, without a key, and for a product that nobody knows
    sales = spark.read.parquet(lake.path("fct_sales"))
    some = sales.filter("order_month = 199805").drop("order_month").limit(5)
    more = some.unionByName(some.limit(1).withColumns({"order_line_id": F.lit(None).cast("string"), "product_id": F.lit("none")}))
    path = f"{lake.path('fct_sales')}/order_month=199806"
    more.write.mode("append").parquet(path)
    read = []
    build = summaries.SUMMARIES["sum_sales_keys"].build

    def watched(sales):
        read.extend(r[0] for r in sales.select("_metadata.file_path").distinct().collect())
        return build(sales)

    with monkeypatch.context() as patch:
        patch.setitem(summaries.SUMMARIES, "sum_sales_keys", summaries.Summary("fct_sales", watched))
        second = both()
    assert read and all("order_month=199806" in f for f in read)
    grown = {m: second["fct_sales", m] - first["fct_sales", m] for t, m in first if t == "fct_sales"}
    assert (grown["total_rows"], grown["duplicate_keys"], grown["null_keys"]) == (6, 5, 1) and grown["orphan_product_id"] >= 1
    # one month: its counts only, and of its own duplicates
    one = audit_months(spark, lake, "fct_sales", ["199806"])
    assert re.search(r"PartitionFilters: \[[^]]*order_month", one._jdf.queryExecution().toString())
    got = {r.measure: r.row_count for r in one.collect()}
    stored = spark.read.parquet(lake.path("fct_sales")).filter("order_month = 199806")
    n, distinct = stored.count(), stored.filter("order_line_id is not null").select("order_line_id").distinct().count()
    assert (got["total_rows"], got["null_keys"], got["duplicate_keys"]) == (n, 1, n - 1 - distinct)
    assert {r.order_month for r in audit_months(spark, lake, "fct_sales", [UNDATED]).collect()} == {None}
    totals = audit_months(spark, lake, "fct_sales").filter("measure = 'total_rows'")
    assert totals.agg(F.sum("row_count")).first()[0] == second["fct_sales", "total_rows"]


def test_sketches_merge_without_reading_lines(spark, lake, made):
    update_summary(spark, lake, "sum_buyer_sketches")
    update_summary(spark, lake, "sum_buyers")
    lakes.remove(spark, lake.path("fct_sales"))
    sketches = read_summary(spark, lake, "sum_buyer_sketches")
    people = made["dim_customers"].select("customer_id", "customer_unique_id", "state")
    buyers = read_summary(spark, lake, "sum_buyers").select("customer_id").distinct().join(people, "customer_id")
    exact = buyers.agg(F.count_distinct("customer_unique_id")).first()[0]
    about = people_estimate(sketches).first().customers
    assert exact > 50 and abs(about / exact - 1) < 0.05
    by_state = {r.customer_state: r.customers for r in people_estimate(sketches, "customer_state").collect()}
    for r in buyers.groupBy("state").agg(F.count_distinct("customer_unique_id").alias("n")).collect():
        assert abs(by_state[r.state] - r.n) <= max(1, 0.05 * r.n)
    added_up = people_estimate(sketches, "order_month").agg({"customers": "sum"}).first()[0]
    assert added_up > 1.5 * about  # people come back: months must not be added


def test_sketch_error_over_many_people(spark):
    """Three standard errors, over months that share two thirds of their people."""
    n = 30_000
    sales = spark.range(12 * n).select(
        (F.lit(202401) + (F.col("id") / n).cast("int")).alias("order_month"),
        F.lit("SP").alias("customer_state"),
        ((F.col("id") % n) + (F.col("id") / n).cast("int") * (n // 3)).cast("string").alias("customer_id"),
    )
    customers = sales.select("customer_id", F.concat(F.lit("u"), "customer_id").alias("customer_unique_id")).distinct()
    exact = n + 11 * (n // 3)
    about = people_estimate(summaries.buyer_sketches(sales, customers)).first().customers
    assert abs(about / exact - 1) < 3 * 1.04 / 2 ** (summaries.SKETCH_SIZE / 2)


def test_no_sales_and_no_people(spark, made, tmp_path):
    lake = Lake(str(tmp_path))
    empty = with_month(made["fct_sales"].limit(0), "fct_sales")
    (tmp_path / "gold").mkdir()
    empty.drop("order_month").write.parquet(f"{lake.path('fct_sales')}/order_month=1")
    lakes.make_folder(spark, lake.path("fct_sales"))
    made["dim_customers"].limit(0).write.parquet(lake.path("dim_customers"))
    for name in ("sum_states", "sum_buyers", "sum_buyer_sketches"):
        update_summary(spark, lake, name)
    assert rows(merged_mart(spark, lake, "mart_executive")) == rows(mart(spark, lake, "mart_executive"))
    assert merged_mart(spark, lake, "mart_sales_month").collect() == []
    assert people_estimate(read_summary(spark, lake, "sum_buyer_sketches")).first().customers == 0


def test_changed_months():
    assert changed_months({}, {}) == []
    assert changed_months({"1": "a", "2": "b"}, {"2": "b", "1": "c", "3": "d"}) == ["1", "3"]
    assert changed_months({"1": "a", "2": "b"}, {"1": "a"}) == ["2"]


def test_command_line_knows_summaries(spark, lake, capsys, monkeypatch):
    update_summaries(spark, lake)
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    cli.main(["--raw", "r", "--lake", lake.root, "--mart", "mart_sales_state", "--summaries"])
    assert "customer_state" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["--raw", "r", "--lake", lake.root, "--mart", "mart_customer_repeat", "--summaries"])
