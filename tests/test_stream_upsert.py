"""The stream into silver ends where batch runs over the same extracts end."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from smelter.operators.incremental import newest_rows
from smelter.plans import bronze, incremental
from smelter.plans.runner import Options, run_layer
from smelter.plans.steps import SILVER
from smelter.sources import lake as lakes
from smelter.sources.lake import Lake
from smelter.streaming.append import append_new_files
from smelter.streaming.upsert import came_with, upsert_batch, upsert_from_stream
from tests.conftest import rows

HEADER = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
TABLE, RAW = "stg_order_payments", "raw_order_payments"


class Flow:
    def __init__(self, spark, root):
        self.spark, self.raw, self.lake = spark, root / "raw", Lake(str(root / "lake"))
        self.raw.mkdir()

    def put(self, name, *lines):
        (self.raw / f"{name}_order_payments_dataset.csv").write_text(HEADER + "\n".join(lines) + "\n")

    def to_bronze(self):
        append_new_files(self.spark, str(self.raw), self.lake, RAW).awaitTermination()

    def to_silver(self):
        upsert_from_stream(self.spark, self.lake, TABLE).awaitTermination()

    def stored(self):
        found = self.lake.read(self.spark, TABLE).drop("_extracted_at")
        return rows(found.select(*(F.col(c).cast("string") for c in sorted(found.columns))), *sorted(found.columns))

    def wanted(self):
        state = SILVER[TABLE].build(bronze.current(self.spark, self.lake, RAW)).drop("_extracted_at")
        return rows(state.select(*(F.col(c).cast("string") for c in sorted(state.columns))), *sorted(state.columns))


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


def test_files_replays_and_other_runs_end_where_batches_end(flow, spark, monkeypatch):
    flow.put("a", "o1,1,boleto,1,5", "o2,1,boleto,1,5", "o3,,voucher,1,1", *(f"p{i},1,boleto,1,1" for i in range(30)))
    flow.to_bronze()
    flow.to_silver()
    assert flow.stored() == flow.wanted() and len(flow.stored()) == 33
    before = lakes.folders(spark, flow.lake.path(TABLE))

    flow.put("b", "o1,1,credit_card,2,9", "o4,1,boleto,1,2", ",1,boleto,1,2", "o5,,x,1,3")
    flow.to_bronze()
    flow.to_silver()
    assert flow.stored() == flow.wanted() and len(flow.stored()) == 35
    after = lakes.folders(spark, flow.lake.path(TABLE))
    assert any(after[k] == before[k] for k in before if k != "_bucket=-1")  # folders that weren't touched

    # nothing new, and a batch that comes again
    flow.to_silver()
    assert lakes.folders(spark, flow.lake.path(TABLE)) == after
    batch = spark.read.parquet(flow.lake.stream_path(RAW))
    upsert_batch(spark, flow.lake, TABLE, batch, 0)
    assert lakes.folders(spark, flow.lake.path(TABLE)) == after
    # the whole stream taken in again, as if its memory were lost
    lakes.remove(spark, flow.lake.progress_path(TABLE))
    flow.to_silver()
    assert flow.stored() == flow.wanted()

    # a run appends a newer state; a batch of the stream that is older must not undo it
    newer = flow.raw.parent / "newer"
    newer.mkdir()
    (newer / "z_order_payments_dataset.csv").write_text(HEADER + "o1,1,voucher,1,1\no2,1,voucher,1,1\n")
    run_layer(spark, "bronze", flow.lake, str(newer), Options(bronze_append=True), [RAW])
    incremental.store_silver(spark, flow.lake, TABLE)
    assert flow.stored() == flow.wanted()
    upsert_batch(spark, flow.lake, TABLE, batch, 99)
    assert flow.stored() == flow.wanted()
    assert [r for r in flow.stored() if r[0] == "o1"][0][3] == "voucher"


def test_a_batch_dies_after_its_write(flow, spark, monkeypatch):
    flow.put("a", "o1,1,boleto,1,5")
    flow.to_bronze()
    flow.to_silver()
    flow.put("b", "o1,1,credit_card,2,9", "o2,1,boleto,1,2")
    flow.to_bronze()
    with monkeypatch.context() as patch:
        patch.setattr("smelter.streaming.upsert.write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(Exception, match="died"):
            flow.to_silver()
    flow.to_silver()
    assert flow.stored() == flow.wanted() and len(flow.stored()) == 2


def test_newest_rows_of_a_batch(table):
    schema = "k int, l int, v string, _extracted_at timestamp, _source_file string"
    day = "2024-01-0{} 00:00:00".format
    extracts = table(
        schema, (1, 1, "old", day(1), "f"), (1, 1, "new", day(3), "g"), (2, 2, "other", day(2), "f"),
        (1, None, "gap", day(1), "f"), (1, None, "gap2", day(2), "f"), (9, None, "else", day(2), "h"),
    )
    batch = extracts.filter("v in ('old', 'gap')")
    came = came_with(batch, extracts, ("k", "l"))
    assert rows(came.newest.select("k", "l", "v"), "v") == [(1, None, "gap2"), (1, 1, "new")]
    assert rows(came.keys) == [(1, 1)] and rows(came.files) == [("f",)]
    assert newest_rows(extracts, ("k", "l")).count() == 4
