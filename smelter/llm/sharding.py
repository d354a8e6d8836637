"""Sharding by jump consistent hashing: a stable key and the shard count decide, no ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import durable, numbered, part_of

SHARDS = 24


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key (Lamping and Veach 2014), for all keys at once.

    A key jumps ahead while its next place is below `shards`; the last place it
    stood on is its shard. Going from n to n+1 shards, a key keeps its shard or
    jumps to the new one.
    """
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    while (moving := np.flatnonzero(ahead < shards)).size:
        shard[moving] = ahead[moving]
        key[moving] = key[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        scale = float(1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[moving] = np.minimum((shard[moving] + 1) * scale, shards).astype(np.int64)
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a hashed key column."""

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(jump(values.to_numpy(np.int64), shards))

    return place(key)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of `docs` with its shard and its slot there: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the text's UTF-8 bytes plus 8, `text_crc32` unsigned; a null text has
    size 8 and the checksum of an empty one. `shard` depends on doc_id and the shard
    count alone; `grown_shard` is the one with a shard more. `slot` numbers a shard's
    rows without gaps from 0. Rows with a null doc_id share one shard; repeated rows
    each get their own slot. Other columns are ignored, an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    hashed = slim.withColumn("key", F.xxhash64("doc_id"))
    placed = hashed.select(
        "doc_id", "size", "text_crc32",
        shard_of(F.col("key"), shards).alias("shard"),
        shard_of(F.col("key"), shards + 1).alias("grown_shard"),
        part_of(F.col("doc_id"), F.col("size"), F.col("text_crc32")).alias("part"),
    )
    slotted = numbered(durable(placed), ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
