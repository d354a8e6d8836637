"""Links within buckets of an index, without pairing what is connected already.

What differs between joins is given by a subclass: which nodes may be linked by their
sizes and summaries, and how pairs are verified. A summary has a bit for whether the
number of elements with some hash is odd; two nodes that differ in d elements differ in
at most d bits. It is looked at while buckets are joined, so that few pairs come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import Scratch, in_tasks
from smelter.llm.components import components

#: A bucket with at most so many nodes is compared throughout; in a larger one nodes that are connected already are not.
SMALL_BUCKET = 32
#: A bit for each hash of so many bits (8 MB) tells which signatures two nodes have. Another signature with such
#: a bit is shuffled in vain; the more bits are set, the more of them are, until all are.
REPEATED_BITS = 26


def bits_of(hashes: DataFrame, width: int) -> np.ndarray:
    """A bit for each value of the first `width` bits of the hashes, a column of longs.

    One row for each 32768 bits comes to the driver, however many hashes there are.
    """
    at = hashes.select(F.shiftrightunsigned(hashes.columns[0], 64 - width).alias("at"))
    parts = at.groupBy(F.floor(F.col("at") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    out = np.zeros(max(1 << width, 32768) // 8, np.uint8)
    for part, bits in parts.collect():
        out[part * 4096 : (part + 1) * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def has_bit(hashes: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Whether the bit of each hash, an unsigned long, is set."""
    at = hashes >> np.uint64(64 - width)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def repeated_heads(bits: np.ndarray, width: int):
    """Each signature of a node whose bit is set."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column(1)
            signatures = heads.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            nodes = np.repeat(batch.column(0).to_numpy(), heads.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            kept = has_bit(signatures.view(np.uint64), bits, width)
            yield pa.RecordBatch.from_arrays([pa.array(signatures[kept]), pa.array(nodes[kept])], ["signature", "node"])

    return explode


class BucketJoin:
    """The steps of one join; tables that several steps read lie in the scratch folder."""

    #: SQL over a_n, b_n, a_bits and b_bits: the nodes that may be linked.
    close = "true"

    def __init__(self, scratch: Scratch):
        self.scratch = scratch

    def verified(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        """The links a, b among the pairs, stored."""
        raise NotImplementedError

    def buckets(self, nodes: DataFrame) -> DataFrame:
        """signature, node, members, n, bits: the nodes of each signature that several have; of signatures with the same nodes one is left."""
        counts = nodes.select(F.explode("heads").alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("members"))
        bits = bits_of(counts.filter("members > 1").select("signature"), REPEATED_BITS)
        index = nodes.select("node", "heads").mapInArrow(repeated_heads(bits, REPEATED_BITS), "signature long, node long")
        index = self.scratch.write(index, "index")
        # two hashes of 64 bits stand for the nodes of a signature
        one, other = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
        groups = index.groupBy("signature").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(one).alias("one"), F.bit_xor(other).alias("other"))
        few = partial(in_tasks, rows=index.count())
        left = few(groups.filter("members > 1")).groupBy("members", "one", "other").agg(F.min("signature").alias("signature"))
        met = few(index.join(few(left.select("signature", "members")), "signature"))
        return few(met.join(nodes.select("node", "n", "bits"), "node"))

    def links(self, nodes: DataFrame) -> DataFrame:
        """Links that connect all nodes which a chain of similar pairs connects.

        `nodes` has node, n, bits and heads, the signatures of the node.
        """
        buckets = self.scratch.write(self.buckets(nodes), "buckets")
        few = partial(in_tasks, rows=(rows := buckets.count()))
        small, large = buckets.filter(f"members <= {SMALL_BUCKET}"), buckets.filter(f"members > {SMALL_BUCKET}")
        within = paired(small, small, f"a < b and {self.close}")
        # in a large bucket all are compared with one; the order of nodes is the same in all buckets
        first = large.groupBy("signature").agg(F.min(F.struct(F.xxhash64("node"), "node", "n", "bits")).alias("first"))
        hubs = first.select("signature", "first.node", "first.n", "first.bits")
        with_hub = paired(hubs, large, f"a <> b and {self.close}")
        # a node meets at most half of a small bucket, on average, or its hub
        few_pairs = partial(in_tasks, rows=rows * max(1, SMALL_BUCKET // 2))
        found = self.verified(few_pairs(few_pairs(within.unionByName(with_hub)).distinct()), nodes, "first")
        # what is left are buckets with nodes that aren't connected yet
        labels = components(found, self.scratch)
        labelled = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labelled = self.scratch.write(few(labelled.select("signature", "node", "n", "bits", "label")), "labelled")
        per_label = labelled.groupBy("signature", "label").agg(F.count(F.lit(1)).alias("members"))
        main = per_label.groupBy("signature").agg(F.max_by("label", F.struct("members", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
        open_ = self.scratch.write(few(labelled.join(main.filter("labels > 1"), "signature")), "open")
        # a pair is taken from one of the buckets that it shares
        open_ = open_.join(open_.groupBy("node").agg(F.collect_list("signature").alias("shared")), "node")
        apart = f"a_label <> b_label and (b_label = b_main or a < b) and {self.close}"
        rest = paired(open_.filter("label <> main"), open_, f"{apart} and array_min(array_intersect(a_shared, b_shared)) = signature")
        rest = self.scratch.write(rest.distinct(), "rest")
        # each node's link with its label connects what the links found connect
        found = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        if rest.isEmpty():
            return found
        return found.unionByName(self.verified(rest, nodes, "rest"))


def hamming(longs: int) -> str:
    """SQL for the bits in which a_bits and b_bits differ."""
    return "(" + " + ".join(f"bit_count(a_bits[{i}] ^ b_bits[{i}])" for i in range(longs)) + ")"


def paired(one: DataFrame, other: DataFrame, condition: str) -> DataFrame:
    """Pairs a, b of rows with one signature. In the condition, columns have the prefix a_ or b_; `node` is a and b itself."""

    def prefixed(df: DataFrame, by: str) -> DataFrame:
        names = {c: by if c == "node" else f"{by}_{c}" for c in df.columns if c != "signature"}
        return df.select("signature", *(F.col(c).alias(n) for c, n in names.items()))

    return prefixed(one, "a").join(prefixed(other, "b"), "signature").filter(condition).select("a", "b")
