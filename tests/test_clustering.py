"""Clustered facts: what the statistics of their row groups leave to read."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.queries import raw_table
from smelter.operators.clustering import bounds, cluster_key, interleaved, range_number
from smelter.plans import runner
from smelter.plans.runner import Options
from smelter.plans.steps import SILVER, derive
from smelter.sinks.parquet import write_table
from smelter.sources.lake import Lake
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
#: Share of the row groups that a filter on one value of either column may still read.
SHARE = 0.4


def groups(folder, column, value):
    """Row groups of a folder, and those whose statistics admit the value."""
    found = []
    for file in sorted(Path(folder).glob("**/*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        found += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    return len(found), sum(s is None or not s.has_min_max or s.min <= value <= s.max for s in found)


@pytest.fixture
def sales(spark):
    number = F.xxhash64("id")
    return spark.range(40_000).select(
        F.lit(201801).alias("order_month"),
        F.md5((F.pmod(number, F.lit(300))).cast("string")).alias("seller_id"),
        F.md5((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000))).cast("string")).alias("customer_id"),
        F.md5(F.col("id").cast("string")).alias("order_id"),
    )


def test_a_filter_on_either_column_skips_row_groups(spark, sales, tmp_path, conf):
    conf({"parquet.block.size": str(64 * 1024), "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    key = cluster_key({"seller_id": sales, "customer_id": sales})
    assert write_table(sales, str(tmp_path / "c"), partition_by=("order_month",), order=key) == 40_000
    write_table(sales, str(tmp_path / "p"), partition_by=("order_month",))
    assert rows(spark.read.parquet(str(tmp_path / "c")).groupBy().agg(F.count(F.lit(1)), F.sum(F.hash("order_id")))) == rows(
        sales.groupBy().agg(F.count(F.lit(1)), F.sum(F.hash("order_id")))
    )
    for column in ("seller_id", "customer_id"):
        shares = {"c": [], "p": []}
        for r in sales.select(column).distinct().orderBy(F.reverse(column)).limit(9).collect():
            for kind, each in shares.items():
                total, read = groups(tmp_path / kind, column, r[0])
                assert total >= 8 and read >= 1
                each.append(read / total)
        mean = {kind: sum(each) / len(each) for kind, each in shares.items()}
        assert mean["c"] <= SHARE and mean["p"] >= 0.8


def test_clustered_facts_hold_the_same_rows(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for name in SILVER:
        derive(name, lambda raw: raw_table(spark, SF, raw)).write.parquet(lake.path(name))
    for fact in ("fct_sales", "fct_order_reviews"):
        runner.run_layer(spark, "gold", lake, tables=[fact])
        plain = sorted(map(str, lake.read(spark, fact).collect()))
        runner.run_layer(spark, "gold", lake, options=Options(cluster=True), tables=[fact])
        assert sorted(map(str, lake.read(spark, fact).collect())) == plain


def test_ranges_and_bits(table):
    df = table("k int, s string", *((i, f"{i:03}") for i in range(160)), (None, None))
    assert len(bounds(df, "s")) == 15 and bounds(df.limit(0), "s") == []
    cuts = bounds(df, "k")
    sizes = df.filter("k is not null").groupBy(range_number(F.col("k"), cuts).alias("r")).count()
    assert rows(sizes, "r") == [(r, 10) for r in range(16)]
    assert rows(df.filter("k is null").select(range_number(F.col("k"), cuts))) == [(0,)]
    numbers = table("a int, b int", (0, 0), (1, 0), (0, 1), (2, 0), (3, 3), (15, 15))
    assert [r[0] for r in rows(numbers.select(interleaved([F.col("a"), F.col("b")])))] == [0, 2, 1, 8, 15, 255]
    same = table("k int", *([(7,)] * 50))
    assert bounds(same, "k") == [7]
