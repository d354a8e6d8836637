"""Schema drift: what appended extracts may change, and that bronze and silver read all of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from smelter.plans import bronze
from smelter.plans.runner import LayerFailed, Options, run_layer
from smelter.sources.drift import SchemaDrift, conformed, fits, versions, widened
from smelter.sources.lake import Lake
from tests.conftest import rows


def schema(text):
    return T.StructType.fromDDL(text)


WIDENED = [
    ("int", "bigint"), ("int", "double"), ("smallint", "int"), ("float", "double"),
    ("int", "decimal(12,2)"), ("bigint", "decimal(20,0)"), ("decimal(5,2)", "decimal(12,4)"),
]


@pytest.mark.parametrize("old, new", WIDENED)
def test_older_files_are_read_in_the_wider_type(spark, tmp_path, old, new):
    lake = Lake(str(tmp_path))
    for kind, value in ((old, "123"), (new, "45"), (old, "6")):
        df = spark.sql(f"select '{kind}' as k, cast('{value}' as {kind}) as v")
        conformed(spark, lake, "raw_x", df).write.mode("append").parquet(lake.path("raw_x"))
    got = lake.read(spark, "raw_x")
    assert got.schema["v"].dataType.simpleString() == new and len(versions(spark, lake, "raw_x")) == 2
    assert sorted(float(r.v) for r in got.collect()) == [6.0, 45.0, 123.0]


@pytest.mark.parametrize(
    "old, new", [("int", "string"), ("bigint", "double"), ("decimal(10,2)", "double"), ("bigint", "decimal(12,0)"), ("decimal(10,2)", "decimal(11,4)"), ("string", "date")]
)
def test_other_changes_are_refused(spark, tmp_path, old, new):
    before, after = schema(f"a {old}").fields[0].dataType, schema(f"a {new}").fields[0].dataType
    assert not fits(before, after)
    if not fits(after, before):
        with pytest.raises(SchemaDrift, match="column a changes"):
            widened(schema(f"a {old}"), schema(f"a {new}"))


def test_columns_come_and_go():
    both = widened(schema("a int, b string"), schema("c date, A bigint"))
    assert both.simpleString() == "struct<a:bigint,b:string,c:date>"
    # a narrower type fits into the stored one
    assert widened(schema("a bigint"), schema("a int")) == schema("a bigint")


HEADER = "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm"
APPEND = Options(bronze_append=True, infer=True, workers=1)


@pytest.fixture
def take_in(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def run(n, header, *lines):
        raw = tmp_path / f"raw{n}"
        raw.mkdir()
        (raw / "x_products_dataset.csv").write_text("\n".join((header, *lines)) + "\n")
        (raw / "product_category_name_translation.csv").write_text("product_category_name,product_category_name_english\nc1,one\n")
        run_layer(spark, "bronze", lake, str(raw), APPEND, ["raw_products", "raw_category_translation"])

    return lake, run


def silver(spark, lake):
    run_layer(spark, "silver", lake, None, APPEND, ["stg_products"])
    return rows(lake.read(spark, "stg_products").select("product_id", "category_name", F.col("weight_grams").cast("double")), "product_id")


def test_drift_through_silver(spark, take_in):
    lake, run = take_in
    run(1, HEADER, "p1,c1,500,1,2,3", "p2,c1,600,1,2,3")
    assert len(versions(spark, lake, "raw_products")) == 1
    run(2, HEADER + ",color", "p2,c1,650.5,1,2,3,red", "p3,c9,700,1,2,3,blue")
    assert [v["product_weight_g"].dataType.simpleString() for v in versions(spark, lake, "raw_products")] == ["int", "double"]
    run(3, HEADER, "p4,c1,800,1,2,3")
    assert len(versions(spark, lake, "raw_products")) == 2
    stored = lake.read(spark, "raw_products")
    assert rows(stored.select("product_id", "product_weight_g", "color"), "product_id", "product_weight_g") == [
        ("p1", 500.0, None), ("p2", 600.0, None), ("p2", 650.5, "red"), ("p3", 700.0, "blue"), ("p4", 800.0, None),
    ]
    first_day = next(iter(bronze.days(spark, lake, "raw_products")))
    assert bronze.since(spark, lake, "raw_products", first_day).count() == 5
    want = [("p1", 500.0), ("p2", 650.5), ("p3", 700.0), ("p4", 800.0)]
    assert [(p, w) for p, _, w in silver(spark, lake)] == want
    # a text where there were numbers is refused, and nothing is stored
    with pytest.raises(LayerFailed, match="product_weight_g changes from double to string"):
        run(4, HEADER, "p5,c1,heavy,1,2,3")
    assert len(versions(spark, lake, "raw_products")) == 2 and lake.read(spark, "raw_products").count() == 5
    # an overwrite starts anew
    raw = f"{lake.root}/../raw4"
    run_layer(spark, "bronze", lake, raw, Options(infer=True, workers=1), ["raw_products"])
    assert versions(spark, lake, "raw_products") == []
    assert rows(lake.read(spark, "raw_products").select("product_weight_g")) == [("heavy",)]
