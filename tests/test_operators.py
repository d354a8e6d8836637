from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from smelter.operators import ranking
from smelter.operators.audit import Check, audit
from smelter.operators.joins import join_with_nulls
from smelter.operators.merge import latest_per_file, latest_per_key, upsert, upsert_table
from smelter.sinks.parquet import recover, replace_table, write_table
from smelter.sources import lake
from tests.conftest import rows


def plain_rank(values):
    return [1 + sum(other > v for other in values) for v in values]


@pytest.mark.parametrize("seed, top", [(1, 100), (2, 10_000_00), (3, 10_000_000_00)])
def test_rank_by_definition(spark, seed, top):
    """Many ties, several bands, and groups that include null."""
    rng = random.Random(seed)
    data = [
        (i, rng.choice(["x", "y", None]), rng.choice([0, rng.randrange(top)]) / 100)
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "i int, g string, a double").withColumn(
        "a", F.col("a").cast("decimal(18,2)")
    )
    got = ranking.add_ranks(df, "a", {"overall": (), "in_group": ("g",)})
    by_row = {r.i: r for r in got.collect()}
    assert len(by_row) == got.count() == len(data)
    assert [by_row[i].overall for i, _, _ in data] == plain_rank([a for _, _, a in data])
    for group in ("x", "y", None):
        members = [(i, a) for i, g, a in data if g == group]
        assert [by_row[i].in_group for i, _ in members] == plain_rank([a for _, a in members])


def test_bands_are_bounded(spark):
    df = spark.range(5000).select((F.col("id") * 7).cast("decimal(18,2)").alias("a"))
    banded = df.groupBy(F.floor(F.col("a") / ranking.BAND_WIDTH)).count()
    assert banded.agg(F.max("count")).first()[0] <= ranking.BAND_WIDTH * 100
    assert banded.count() > 1


def test_join_with_nulls(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert rows(join_with_nulls(left, right, ["k"], "left"), "x") == [
        (None, 1, 10), ("a", 2, 20), ("b", 3, None),
    ]


BATCHES = "k string, v string, _extracted_at timestamp, _source_file string"


def test_latest_per_key(table):
    df = table(
        BATCHES,
        ("a", "old", "2024-01-01 00:00:00", "f"),
        ("a", None, "2024-01-02 00:00:00", "f"),
        ("b", "same 1", "2024-01-01 00:00:00", "f"),
        ("b", "same 2", "2024-01-01 00:00:00", "f"),
    )
    got = latest_per_key(df, ["k"])
    assert got.columns == df.columns
    assert rows(got.select("k", "v"), "k") == [("a", None), ("b", "same 2")]


def test_latest_per_file_keeps_equal_rows(table):
    df = table(
        BATCHES,
        ("x", "1", "2024-01-01 00:00:00", "f"),
        ("x", "1", "2024-01-02 00:00:00", "f"),
        ("x", "1", "2024-01-02 00:00:00", "f"),
        ("y", "1", "2024-01-01 00:00:00", "g"),
    )
    assert rows(latest_per_file(df).select("k"), "k") == [("x",), ("x",), ("y",)]


def test_newest_row_of_a_hot_key_needs_no_large_group(spark, table):
    """All rows of the key are reduced in their own task before the shuffle."""
    plan = latest_per_key(table(BATCHES), ["k"])._jdf.queryExecution().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([(20, "b"), (30, "c")], "v int, k string")
    merged = upsert(old, new, ["k"])
    expected = [(None, 3), ("a", 1), ("b", 20), ("c", 30)]
    assert rows(merged, "k") == expected
    assert rows(upsert(merged, new, ["k"]), "k") == expected


def test_upsert_table_reads_and_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path)
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    for _ in range(2):
        assert upsert_table(spark, path, new, ["k"]) == 3
        assert rows(spark.read.parquet(path), "k") == [("a", 1), ("b", 20), ("c", 30)]
    assert not lake.exists(spark, f"{path}__new") and not lake.exists(spark, f"{path}__old")


def test_failed_replacement_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    broken = spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        replace_table(spark, broken, path)
    assert spark.read.parquet(path).count() == 3


def test_interrupted_swap_is_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    lake.rename(spark, path, f"{path}__old")
    recover(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_write_counts_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(1000), path) == 1000
    assert write_table(spark.range(0), path) == 0
    assert write_table(spark.range(5), path) == write_table(spark.range(5), path, "append") == 5
    assert spark.read.parquet(path).count() == 10


def test_dynamic_overwrite_replaces_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "m int, v int")
    write_table(first, path, partition_by=["m"])
    second = spark.createDataFrame([(2, 21), (3, 30)], "m int, v int")
    for _ in range(2):
        write_table(second, path, partition_by=["m"], dynamic=True)
        stored = spark.read.parquet(path).select("m", "v")
        assert rows(stored, "v") == [(1, 10), (1, 11), (2, 21), (3, 30)]


def test_audit(spark):
    tables = {
        "parent": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string"),
        "child": spark.createDataFrame(
            [("a", 1), ("z", 2), ("z", 2), (None, None)], "k string, n int"
        ),
        "pairs": spark.createDataFrame(
            [("a", 1), ("a", 1), ("a", 2), ("z", None)], "k string, what int"
        ),
        "empty": spark.createDataFrame([], "k string"),
    }
    checks = {
        "parent": Check(("k",)),
        "child": Check(("n",), (("k", "parent"),)),
        "pairs": Check(("k", "what"), (("k", "parent"),)),
        "empty": Check(("k",), (("k", "parent"),)),
    }
    got = {(r[0], r[1]): r[2] for r in audit(checks, tables.__getitem__).collect()}
    assert got == {
        ("parent", "total_rows"): 4,
        ("parent", "null_keys"): 1,
        ("parent", "duplicate_keys"): 1,
        ("child", "total_rows"): 4,
        ("child", "null_keys"): 1,
        ("child", "duplicate_keys"): 1,
        ("child", "orphan_k"): 2,
        ("pairs", "total_rows"): 4,
        ("pairs", "null_keys"): 1,
        ("pairs", "duplicate_keys"): 1,
        ("pairs", "orphan_k"): 1,
        ("empty", "total_rows"): 0,
        ("empty", "orphan_k"): 0,
        ("empty", "null_keys"): 0,
        ("empty", "duplicate_keys"): 0,
    }


def test_rank_keeps_decimal_amounts(spark):
    df = spark.createDataFrame([(Decimal("1.50"),), (Decimal("2.50"),)], "a decimal(18,2)")
    assert rows(ranking.add_ranks(df, "a", {"r": ()}), "a") == [
        (Decimal("1.50"), 2), (Decimal("2.50"), 1),
    ]
