"""Exact dedup by an exchange of Golomb-coded fingerprints.

Each input partition sends the sorted, compressed fingerprints of its texts to their
owners. An owner sees which fingerprints several senders hold and answers each list
with a bitmap. Only rows whose bit is set ("suspects") are then compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import Scratch, durable, sent_whole_if_small
from smelter.llm.words import LOWER

#: Rows that a partition sends as one set of lists.
CHUNK = 65536
UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENT = "chunk long, owner int, n int, code binary, docs array<struct<doc_id:long,sha:binary,at:int,twice:boolean>>"


def encode(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit values as Golomb-Rice code of their gaps.

    One byte tells how many low bits of a gap are stored as they are; the rest of each
    gap is unary. The unary parts come first, then the low bits, both packed.
    """
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(gaps.astype(np.float64).mean())
    low = int(np.clip(np.floor(np.log2(max(mean, 1.0) * 0.6931)), 0, 63)) if mean > 1 else 0
    ends = np.cumsum((gaps >> np.uint64(low)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    bits = (gaps[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    head = np.packbits(unary).tobytes()
    return bytes([low]) + len(head).to_bytes(4, "little") + head + np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def decode(code: bytes, n: int) -> np.ndarray:
    """The n values that `encode` was given."""
    low, split = code[0], 5 + int.from_bytes(code[1:5], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code[5:split], np.uint8)))[:n]
    gaps = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps <<= np.uint64(low)
    if low:
        bits = np.unpackbits(np.frombuffer(code[split:], np.uint8))[: n * low].reshape(n, low)
        gaps |= (bits.astype(np.uint64) << np.arange(low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def lists_of(chunk: int, docs: list[tuple], owners: int, keep_bits: int) -> Iterator[dict]:
    """One list for each owner, and with it the rows it stands for."""
    prints = np.array([int.from_bytes(sha[:8], "big") for _, sha in docs], np.uint64)
    prints &= np.uint64(((1 << keep_bits) - 1) << (64 - keep_bits))
    distinct, at, counts = np.unique(prints, return_inverse=True, return_counts=True)
    # an owner has a range of fingerprints, so what is sorted here is sorted there
    owner = ((distinct >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    bounds = np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64))
    by_print = np.argsort(at, kind="stable")
    rows = np.searchsorted(at[by_print], bounds)
    for o in range(owners):
        lo, hi = bounds[o], bounds[o + 1]
        if lo == hi:
            continue
        yield {
            "chunk": chunk,
            "owner": o,
            "n": int(hi - lo),
            "code": encode(distinct[lo:hi]),
            "docs": [
                {"doc_id": docs[i][0], "sha": docs[i][1], "at": int(at[i] - lo), "twice": bool(counts[at[i]] > 1)}
                for i in by_print[rows[o] : rows[o + 1]]
            ],
        }


def sender(owners: int, keep_bits: int):
    schema = pa.schema(
        [
            ("chunk", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("code", pa.binary()),
            ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("sha", pa.binary()), ("at", pa.int32()), ("twice", pa.bool_())]))),
        ]
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        docs: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                held = text.as_py() or b""
                docs.append((doc_id, hashlib.sha256(held.translate(LOWER)).digest()))
                if len(docs) == CHUNK:
                    yield pa.RecordBatch.from_pylist(list(lists_of(chunk, docs, owners, keep_bits)), schema)
                    docs, chunk = [], chunk + 1
        if docs:
            yield pa.RecordBatch.from_pylist(list(lists_of(chunk, docs, owners, keep_bits)), schema)

    return send


def answer(lists: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each list, a bitmap of the fingerprints that another list has too."""
    decoded = [decode(code, n) for code, n in zip(lists["code"], lists["n"])]
    values, at, counts = np.unique(np.concatenate(decoded), return_inverse=True, return_counts=True)
    shared = np.split(counts[at] > 1, np.cumsum([len(d) for d in decoded])[:-1])
    return pd.DataFrame(
        {"chunk": lists["chunk"], "owner": lists["owner"], "bitmap": [np.packbits(s).tobytes() for s in shared]}
    )


def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its digest, and whether its text may occur again."""
    for batch in batches:
        ids, shas, suspects = [], [], []
        for bitmap, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bits = np.unpackbits(np.frombuffer(bitmap, np.uint8))
            for d in docs:
                ids.append(d["doc_id"])
                shas.append(d["sha"].hex())
                suspects.append(d["twice"] or bool(bits[d["at"]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(shas, pa.string()), pa.array(suspects, pa.bool_())],
            ["doc_id", "text_sha256", "suspect"],
        )


def exact_duplicates(docs: DataFrame, keep_bits: int = 64) -> DataFrame:
    """One row for each row of `docs`: doc_id, text_sha256, keep_id, group_size, kept.

    Texts are equal when they are after lower-casing A-Z; a null text counts as
    empty. Of equal texts the row with the largest doc_id stays (a null doc_id is
    smaller than any); of repeated rows with that doc_id, one. Other columns are
    ignored; an empty table gives no rows. `keep_bits` shortens the fingerprints, to
    test that false suspects change nothing. Two different texts with one SHA-256
    would be an error, which the byte comparison raises.
    """
    spark = docs.sparkSession
    owners = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(spark) as scratch:
        sent = scratch.write(slim.mapInArrow(sender(owners, keep_bits), SENT), "sent")
        bitmaps = sent.select("chunk", "owner", "n", "code").groupBy("owner")
        bitmaps = bitmaps.applyInPandas(answer, "chunk long, owner int, bitmap binary")
        received = sent.select("chunk", "owner", "docs").join(bitmaps, ["chunk", "owner"]).select("bitmap", "docs")
        rows = scratch.write(received.mapInArrow(receive, "doc_id long, text_sha256 string, suspect boolean"), "rows")
        wanted = durable(rows.filter("suspect").select(F.col("doc_id").alias("wanted_id")).distinct())
        texts = slim.join(sent_whole_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
        lowered = F.translate(F.coalesce("text", F.lit("")), UPPER_CASE, LOWER_CASE)
        # equal bytes meet in one group; copies in a task become one row before the shuffle
        compared = texts.select("doc_id", lowered.alias("lowered")).groupBy("lowered").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        by_digest = compared.withColumn("sha", F.sha2("lowered", 256)).groupBy("sha").agg(
            F.count(F.lit(1)).alias("texts"),
            F.first("keep_id").alias("keep_id"),
            F.first("group_size").alias("group_size"),
        )
        sure = by_digest.withColumn(
            "keep_id",
            F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one SHA-256"))).otherwise(F.col("keep_id")),
        )
        sole = rows.filter("not suspect").select(
            "doc_id", "text_sha256", F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        )
        again = Window.partitionBy("text_sha256", "doc_id").orderBy("doc_id")
        grouped = (
            rows.filter("suspect")
            .withColumn("again", F.row_number().over(again))
            .join(sure, F.col("text_sha256") == F.col("sha"))
            .select(
                "doc_id", "text_sha256", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)).alias("kept"),
            )
        )
        return durable(sole.unionByName(grouped))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that `exact_duplicates` keeps."""
    found = exact_duplicates(docs)
    lowered = F.sha2(F.translate(F.coalesce(F.col("d.text"), F.lit("")), UPPER_CASE, LOWER_CASE), 256)
    per_row = found.filter(F.col("group_size") > 1).groupBy("doc_id", "text_sha256")
    per_row = per_row.agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))

    def meets(right: str):
        # no key of the join, so that only rows with a matching doc_id are hashed
        same_text = F.instr(F.col(f"{right}.text_sha256"), lowered) == 1
        return F.col("d.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & same_text

    gone = sent_whole_if_small(durable(per_row.filter("not kept or rows > 1")))
    left = docs.alias("d").join(gone.alias("g"), meets("g"), "left_anti")
    # of rows that are repeated whole, one comes back
    tied = per_row.filter("kept and rows > 1").withColumn("one", F.xxhash64("doc_id", "text_sha256"))
    if tied.isEmpty():
        return left
    back = docs.alias("d").join(tied.alias("t"), meets("t")).dropDuplicates(["one"]).select("d.*")
    return left.unionByName(back)
