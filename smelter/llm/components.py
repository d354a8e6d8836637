"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import Scratch, durable, in_tasks


def stars(edges: DataFrame, rows: int) -> bool:
    """Whether each a has one b only, which is no a itself, among at most so many edges."""
    ends = (F.struct(F.col(c).alias("node"), F.lit(hung).alias("hung")) for c, hung in (("a", 1), ("b", 0)))
    per_node = edges.select(F.inline(F.array(*ends))).groupBy("node").agg(F.sum("hung").alias("hung"), F.count(F.lit(1)).alias("n"))
    return in_tasks(per_node, 2 * rows).agg(F.count_if((F.col("hung") > 0) & (F.col("n") > 1))).first()[0] == 0


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, label: each linked node and the smallest node that it reaches. `links` has columns a and b, of type long.

    Each round hangs a node's neighbours under the smallest of them (Kiveris et al.
    2014), which takes a number of rounds that grows with the logarithm of the longest
    path; there is none for links that are stars already. `links` should be stored, as
    they are counted first: no round makes more of them. Only links travel, no node's
    neighbours are gathered in one place. With `scratch`, what the rounds leave lies
    there: as tables, which are read in as many tasks as their size asks for.
    """
    kept = scratch.keep if scratch else durable
    low, high = F.least("a", "b"), F.greatest("a", "b")
    few = partial(in_tasks, rows=(rows := links.count()))
    edges = kept(few(links.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct()))
    while not stars(edges, rows):
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = in_tasks(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), 2 * rows)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = kept(few(few(large.filter("a <> b")).distinct()))
        least = few(large.groupBy("a").agg(F.min("b").alias("least")))
        met = large.join(least, "a")
        small = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
        edges = kept(few(few(small.filter("a <> b")).distinct()))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
