"""Whole runs, from CSV files to marts, checked against SQL over the test tables."""

from __future__ import annotations

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, functions as F

from checks.adapters import RAW_VIEWS
from checks.compare import _bag, connect
from checks.oracle import ORACLE
from checks.queries import comparable
import smelter.__main__ as cli
from smelter.plans import bronze, marts, runner
from smelter.plans.runner import (
    LayerFailed,
    Options,
    audit_lake,
    export_gold,
    export_raw,
    mart,
    run_all,
    run_layer,
)
from smelter.plans.steps import GOLD, LAYERS, MARTS, SILVER
from smelter.schemas import RAW_TABLES
from smelter.sinks.jdbc import ExportMismatch
from smelter.sources.lake import Lake, tables
from smelter.streaming.append import append_new_files
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def raw_root(con, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name, spec in RAW_TABLES.items():
        file = root / spec.files.replace("*", "shop_" if "dataset" in spec.files else "")
        con.execute(f"copy ({RAW_VIEWS[name]}) to '{file}' (header, delimiter ',')")
    return str(root)


@pytest.fixture(scope="module")
def built(spark, raw_root, tmp_path_factory):
    """A lake after one full run, with the summary of the run."""
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    return SimpleNamespace(lake=lake, summary=run_all(spark, raw_root, lake).collect())


def same_as_sql(con, df: DataFrame, name: str) -> bool:
    df = comparable(df)
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    return _bag(df.columns, df.collect()) == _bag(columns, cursor.fetchall())


def test_summary(spark, built):
    assert [(r.layer, r.table) for r in built.summary] == [
        (layer, table) for layer, names in LAYERS.items() for table in names
    ]
    assert {r.status for r in built.summary} == {"ok"}
    for r in built.summary:
        assert built.lake.read(spark, r.table).count() == r.rows
    assert tables(spark, built.lake).count() == 9 + 7 + 10


@pytest.mark.parametrize("name", [*SILVER, *GOLD])
def test_stored_tables(spark, con, built, name):
    assert same_as_sql(con, built.lake.read(spark, name), name)


@pytest.mark.parametrize("name", MARTS)
def test_marts_over_stored_tables(spark, con, built, name):
    assert same_as_sql(con, mart(spark, built.lake, name), name)


def test_bronze_lineage(spark, built):
    stored = built.lake.read(spark, "raw_orders")
    assert rows(stored.select("_source_file").distinct()) == [("shop_orders_dataset.csv",)]
    assert stored.select("_extracted_at").distinct().count() == 1


def test_invariants(spark, built):
    def read(name):
        return built.lake.read(spark, name)

    items, orders = read("stg_order_items"), read("stg_orders")
    expected = items.join(orders, "order_id", "left_semi").count()
    assert read("fct_sales").count() == expected
    assert read("fct_order_reviews").count() == read("stg_order_reviews").count()
    share = read("dim_payment_types").agg(F.sum("value_share_pct")).first()[0]
    assert abs(float(share) - 100) < 0.1
    found = {(r.table_name, r.measure): r.row_count for r in audit_lake(spark, built.lake).collect()}
    for name in GOLD:
        assert found[name, "total_rows"] == read(name).count()
        if name.startswith("dim_"):
            assert found[name, "duplicate_keys"] == 0


def test_sales_are_stored_by_month(spark, built):
    stored = built.lake.read(spark, "fct_sales", layout=True)
    assert "order_month" in stored.columns
    assert "order_month" not in built.lake.read(spark, "fct_sales").columns
    plan = stored.filter("order_month = 199805")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    per_month = stored.select("order_month", F.col("_metadata.file_path").alias("f")).distinct()
    assert per_month.groupBy("order_month").count().agg(F.max("count")).first()[0] == 1


def test_upsert_runs_end_where_full_runs_end(spark, con, built, raw_root):
    for options in (
        Options(gold_upsert=True),
        Options(gold_upsert=True, facts_since=date(2001, 3, 15)),
    ):
        run_layer(spark, "gold", built.lake, options=options)
        for name in GOLD:
            assert same_as_sql(con, built.lake.read(spark, name), name)


def test_partial_facts_touch_only_later_months(spark, con, raw_root, tmp_path):
    lake = Lake(str(tmp_path))
    run_all(spark, raw_root, lake)
    facts = {"fct_sales": ("order_month", 200103), "fct_order_reviews": ("review_month", 202401)}

    def files(table, later):
        month, first = facts[table]
        stored = lake.read(spark, table, layout=True)
        recent = F.coalesce(F.col(month) >= first, F.lit(True))  # no month: rebuilt too
        picked = stored.filter(recent if later else ~recent)
        return {r[0] for r in picked.select("_metadata.file_path").distinct().collect()}

    for table, (_, first) in facts.items():
        early, late = files(table, False), files(table, True)
        assert late
        options = Options(gold_upsert=True, facts_since=date(first // 100, first % 100, 15))
        run_layer(spark, "gold", lake, options=options, tables=[table])
        assert files(table, False) == early
        assert files(table, True) and not files(table, True) & late
        assert same_as_sql(con, lake.read(spark, table), table)


def test_appended_bronze_equals_overwritten(spark, con, raw_root, tmp_path):
    lake, options = Lake(str(tmp_path)), Options(bronze_append=True)
    for _ in range(2):
        run_layer(spark, "bronze", lake, raw_root, options)
    stored = lake.read(spark, "raw_orders")
    assert stored.select("_extracted_at").distinct().count() == 2
    for layer in ("silver", "gold"):
        run_layer(spark, layer, lake, options=options)
    keyed = ("stg_orders", "stg_customers", "stg_order_payments", "dim_geolocation")
    for name in keyed:
        assert same_as_sql(con, lake.read(spark, name), name)


def test_rows_with_a_gap_in_their_key_follow_their_file(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    file = raw / "x_order_payments_dataset.csv"
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    options = Options(bronze_append=True)

    def extract(*lines):
        file.write_text(header + "\n".join(lines) + "\n")
        run_layer(spark, "bronze", lake, str(raw), options, ["raw_order_payments"])
        run_layer(spark, "silver", lake, options=options, tables=["stg_order_payments"])
        stored = lake.read(spark, "stg_order_payments")
        return rows(stored.select("order_id", "payment_sequential", "payment_type").orderBy(
            "payment_sequential", "payment_type"
        ))

    gap_a, gap_b = ("o", None, "a"), ("o", None, "b")
    assert extract("o,1,x,1,1", "o,,a,1,1", "o,,b,1,1") == [gap_a, gap_b, ("o", 1, "x")]
    assert extract("o,1,y,1,1", "o,,a,1,1", "o,,b,1,1") == [gap_a, gap_b, ("o", 1, "y")]
    assert extract("o,1,z,1,1") == [("o", 1, "z")]


def test_estimated_counts(spark, built):
    sales, people = (built.lake.read(spark, t) for t in ("fct_sales", "dim_customers"))
    exact = marts.executive(sales, people).first()
    about = marts.executive(sales, people, F.approx_count_distinct).first()
    assert about.total_revenue == exact.total_revenue
    assert abs(about.total_orders / exact.total_orders - 1) < 0.15
    assert abs(about.total_customers / exact.total_customers - 1) < 0.15


def test_streamed_bronze_takes_each_file_once(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"

    def run():
        append_new_files(spark, str(raw), lake, "raw_sellers").awaitTermination()
        stored = lake.read(spark, "raw_sellers").select("seller_id", "_source_file")
        return rows(stored, "seller_id")

    (raw / "a_sellers_dataset.csv").write_text(header + "s1,01,x,SP\n")
    assert run() == [("s1", "a_sellers_dataset.csv")]
    assert run() == [("s1", "a_sellers_dataset.csv")]
    (raw / "b_sellers_dataset.csv").write_text(header + "s2,02,y,RJ\n")
    assert run() == [("s1", "a_sellers_dataset.csv"), ("s2", "b_sellers_dataset.csv")]
    run_layer(spark, "silver", lake, options=Options(bronze_append=True), tables=["stg_sellers"])
    assert rows(lake.read(spark, "stg_sellers").select("zip_code"), "zip_code") == [
        ("01",), ("02",),
    ]


def test_one_broken_table_does_not_stop_the_others(spark, raw_root, tmp_path):
    lake = Lake(str(tmp_path))
    run_layer(spark, "bronze", lake, raw_root, tables=["raw_sellers", "raw_orders"])
    lenient = run_layer(
        spark, "silver", lake, options=Options(strict=False),
        tables=["stg_products", "stg_sellers", "stg_orders"],
    )
    got = {r.table: r for r in lenient.collect()}
    assert got["stg_products"].status == "failed" and got["stg_products"].rows == 0
    assert "PATH_NOT_FOUND" in got["stg_products"].error
    assert got["stg_sellers"].status == got["stg_orders"].status == "ok"
    with pytest.raises(LayerFailed, match="stg_products"):
        run_layer(spark, "silver", lake, tables=["stg_products", "stg_sellers"])


@pytest.fixture
def sql_store(monkeypatch, spark):
    """Stands in for a SQL store: keeps what would be sent, answers counts from it."""
    sent = {}

    def write(self, url, table, mode=None, properties=None):
        if table.endswith("dim_dates"):
            raise RuntimeError("refused")
        sent[table] = (url, properties, self._df.collect())

    def read(self, url, table, properties=None, **_):
        name = table.split(" FROM ")[1].split(")")[0]
        return spark.createDataFrame([(len(sent[name][2]) + sent.get("extra", 0),)], "n long")

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    return sent


def test_gold_export(spark, built, sql_store):
    summary = export_gold(
        spark, built.lake, "jdbc:x", {"user": "u"}, tables=["dim_sellers", "fct_sales", "dim_dates"]
    )
    sellers, sales = (built.lake.read(spark, t).count() for t in ("dim_sellers", "fct_sales"))
    assert [tuple(r) for r in summary.collect()] == [
        ("gold", "dim_sellers", sellers, "ok", None, None),
        ("gold", "fct_sales", sales, "ok", None, None),
        ("gold", "dim_dates", 0, "failed", "refused", None),
    ]
    url, properties, _ = sql_store["gold.dim_sellers"]
    assert (url, properties) == ("jdbc:x", {"user": "u"})


def test_missing_gold_table_is_skipped(spark, tmp_path, sql_store):
    summary = export_gold(spark, Lake(str(tmp_path)), "jdbc:x", tables=["dim_sellers"])
    assert [tuple(r)[:4] for r in summary.collect()] == [("gold", "dim_sellers", 0, "skipped")]


def test_raw_export_has_lineage(spark, raw_root, sql_store):
    summary = export_raw(spark, raw_root, "jdbc:x", tables=["raw_sellers"])
    assert [r.status for r in summary.collect()] == ["ok"]
    first = sql_store["bronze.raw_sellers"][2][0]
    assert first._source_file == "shop_sellers_dataset.csv" and first._extracted_at


def test_doubled_rows_in_the_store_are_noticed(spark, built, sql_store):
    sql_store["extra"] = 1
    summary = export_gold(spark, built.lake, "jdbc:x", tables=["dim_sellers"])
    (row,) = summary.collect()
    assert row.status == "failed" and "stored" in row.error
    assert issubclass(ExportMismatch, RuntimeError)


REVIEWS = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date\n"


def test_facts_since_take_in_new_moved_undated_and_vanished_rows(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    (raw / "x_orders_dataset.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\no,c,delivered,2018-01-01 00:00:00,,,,\n"
    )

    def run(options, *reviews):
        lines = (f"{r},o,5,,,{day}" for r, day in reviews)
        (raw / "x_order_reviews_dataset.csv").write_text(REVIEWS + "\n".join(lines) + "\n")
        for layer, tables in (("bronze", ["raw_orders", "raw_order_reviews"]), ("silver", ["stg_orders", "stg_order_reviews"]), ("gold", ["fct_order_reviews"])):
            run_layer(spark, layer, lake, str(raw), options, tables)
        return rows(lake.read(spark, "fct_order_reviews").select("review_id", "review_date_key"), "review_id")

    sep, octo = "2018-09-05 00:00:00", "2018-10-05 00:00:00"
    assert run(Options(), ("r0", "2018-08-01 00:00:00"), ("r1", sep), ("r3", sep), ("r4", octo)) == [
        ("r0", 20180801), ("r1", 20180905), ("r3", 20180905), ("r4", 20181005),
    ]
    since = Options(gold_upsert=True, facts_since=date(2018, 9, 20))
    # r1 loses its date, r2 is new without one, r3 moves, r4 vanishes and with it its month
    assert run(since, ("r0", "2018-08-01 00:00:00"), ("r1", "bad"), ("r2", "bad"), ("r3", "2018-11-01 00:00:00")) == [
        ("r0", 20180801), ("r1", None), ("r2", None), ("r3", 20181101),
    ]
    # a run without --since replaces all months
    assert run(Options(gold_upsert=True), ("r3", sep)) == [("r3", 20180905)]


def test_since_needs_upsert():
    with pytest.raises(ValueError, match="gold_upsert"):
        Options(facts_since=date(2018, 9, 1))


def test_upserts_with_null_keys_end_after_one(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    (raw / "x_order_payments_dataset.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no,1,,1,5\no,2,boleto,1,6\n"
    )
    run_layer(spark, "bronze", lake, str(raw), tables=["raw_order_payments"])
    run_layer(spark, "silver", lake, tables=["stg_order_payments"])
    for _ in range(3):
        run_layer(spark, "gold", lake, options=Options(gold_upsert=True), tables=["dim_payment_types"])
        assert rows(lake.read(spark, "dim_payment_types").select("payment_type"), "payment_type") == [(None,), ("boleto",)]


SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


@pytest.mark.parametrize("order", ["stream append", "append stream", "stream overwrite stream", "stream append stream append"])
def test_stream_and_runs_share_a_table(spark, tmp_path, order):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    for i, step in enumerate(order.split()):
        (raw / f"{i}_sellers_dataset.csv").write_text(SELLERS + f"s{i},01,x,SP\n")
        if step == "stream":
            append_new_files(spark, str(raw), lake, "raw_sellers").awaitTermination()
        else:
            run_layer(spark, "bronze", lake, str(raw), Options(bronze_append=step == "append"), ["raw_sellers"])
    want = [(f"s{i}",) for i in range(len(order.split()))]
    assert rows(lake.read(spark, "raw_sellers").select("seller_id").distinct(), "seller_id") == want
    run_layer(spark, "silver", lake, tables=["stg_sellers"])
    assert rows(lake.read(spark, "stg_sellers").select("seller_id"), "seller_id") == want


def test_folders_with_equal_file_names_are_different_files(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    header = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"

    def put(folder, zip_code):
        (raw / folder).mkdir(parents=True, exist_ok=True)
        (raw / folder / "part-0.csv").write_text(header + f"{zip_code},1,2,x,SP\n")

    def current():
        run_layer(spark, "bronze", lake, str(raw), Options(bronze_append=True), ["raw_geolocation"])
        got = bronze.current(spark, lake, "raw_geolocation")
        return rows(got.select("geolocation_zip_code_prefix"), "geolocation_zip_code_prefix")

    put("x_geolocation_dataset.csv", "01")
    put("y_geolocation_dataset.csv", "02")
    assert current() == [("01",), ("02",)]
    put("x_geolocation_dataset.csv", "03")
    assert current() == [("02",), ("03",)]


def test_money_is_added_before_it_is_rounded_and_never_lost(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    raw.mkdir()
    header = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"

    def run(line):
        (raw / "x_order_items_dataset.csv").write_text(header + line + "\n")
        (done,) = run_layer(spark, "bronze", lake, str(raw), tables=["raw_order_items"]).collect()
        return done.unparsed, run_layer(spark, "silver", lake, options=Options(strict=False), tables=["stg_order_items"]).first()

    unparsed, silver = run("o,1,p,s,2017-09-19 09:45:35,0.005,0.005")
    assert (unparsed, silver.status) == (0, "ok")
    assert str(lake.read(spark, "stg_order_items").first().line_total) == "0.01"
    unparsed, silver = run("o,1,p,s,2017-09-19 09:45:35,123456789.00,1")
    assert unparsed == 0 and silver.status == "failed" and "OUT_OF_RANGE" in silver.error.upper() or "CANNOT" in silver.error.upper()
    assert run("o,1,p,s,2017-09-19 09:45:35,cheap,1")[0] == 1


def test_sales_without_a_date_stay_in_all_marts(spark, built):
    sales, dates, people = (built.lake.read(spark, t) for t in ("fct_sales", "dim_dates", "dim_customers"))
    assert sales.filter("date_key is null").count() > 0
    total = marts.executive(sales, people).first().total_revenue
    for got in (marts.sales_month(sales, dates), marts.sales_state(sales), marts.sales_category(sales)):
        assert got.agg({"revenue": "sum"}).first()[0] == total
    assert marts.sales_month(sales, dates).filter("year_month is null").count() == 1
    assert marts.delivery(sales, dates).agg({"orders": "sum"}).first()[0] == sales.select("order_id").distinct().count()


def test_an_error_without_text_and_the_width_of_a_layer(spark, built, raw_root, monkeypatch):
    got = runner._attempt("gold", "t", lambda: (_ for _ in ()).throw(RuntimeError()))
    assert (got.status, got.error) == ("failed", "RuntimeError")
    cores = spark.sparkContext.defaultParallelism
    assert runner.layer_width(spark, "gold", built.lake, None, ["fct_sales"]) == cores
    monkeypatch.setattr("smelter.session.TARGET_SHUFFLE_BYTES", 1000)
    wide = runner.layer_width(spark, "gold", built.lake, None, ["fct_sales"])
    assert wide > 2 * runner.layer_width(spark, "bronze", built.lake, raw_root, ["raw_sellers"]) and wide > cores
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    monkeypatch.setattr(runner, "_attempt_all", lambda *a: seen.append(spark.conf.get("spark.sql.shuffle.partitions")))
    run_layer(spark, "gold", built.lake, tables=["fct_sales"])
    run_layer(spark, "gold", built.lake, tables=["fct_sales"], options=Options(shuffle_partitions=17))
    assert seen == [str(wide), "17"] and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_failed_tables_end_the_command_with_an_error(spark, built, monkeypatch):
    failed = spark.createDataFrame([("gold", "dim_dates", 0, "failed", "x", None)], runner.SUMMARY)
    monkeypatch.setattr(cli, "run_all", lambda *a: failed.filter("false"))
    monkeypatch.setattr(cli, "export_gold", lambda *a: failed)
    with pytest.raises(SystemExit, match="1 tables failed"):
        cli.main(["--raw", "r", "--lake", built.lake.root, "--jdbc-url", "jdbc:x"])
