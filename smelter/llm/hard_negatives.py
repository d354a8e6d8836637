"""Hard negatives: rows of other labels that score a little below an anchor's positives.

The candidates are cut into blocks of bounded size, each with a cover tree of its own.
Anchors are the stated query set; they meet the trees in blocks, on a grid whose cells
are dealt out by a join. A task keeps the best rows found so far for the anchors it has
seen, so a later tree is searched only where it can still improve them; a shuffle merges
what the tasks have found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import Scratch, durable
from smelter.llm.cover_tree import NO_ID, NONE, Tree, build, descend, from_bytes, take_best, to_bytes
from smelter.llm.vectors import matrix, whole_vectors

EVERY, SHIFTED = 50, 7
POSITIVES, NEGATIVES = 5, 3
#: Rows in a tree, and anchors that descend together.
TREE_ROWS, ANCHOR_ROWS = 2048, 512
#: Blocks of anchors whose best rows a task keeps before it sends them on.
HELD = 256
#: A score times 95 is a 64-bit number for vectors whose squared length is below this.
LONGEST = float(1 << 56)
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Queries:
    """Anchors; `above` and `below` bound the scores that each of their windows takes."""

    vectors: np.ndarray
    marks: np.ndarray
    labels: np.ndarray
    above: np.ndarray
    below: np.ndarray


def prepared(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(mark, vec_id, label, x) of the rows that take part, and the length of x."""
    rows, dims = whole_vectors(embeddings, "vec_id", "label")
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    changed = F.when(vec_id % SHIFTED == 0, (label + 1) % 10).otherwise(label)
    square = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v)
    usable = rows.filter(vec_id.isNotNull() & label.isNotNull() & (square < LONGEST))
    return usable.select(F.monotonically_increasing_id().alias("mark"), vec_id.alias("vec_id"), changed.alias("label"), "x"), dims


def in_blocks(rows: DataFrame, dims: int, most: int, make: Callable[..., bytes], more: str = "") -> DataFrame:
    """(block, data): `make` of the rows of each partition, `most` at a time; `more` is one more column that it gets."""
    columns = ["mark", "vec_id", "label", "x", *([more] if more else [])]

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        made, base = 0, TaskContext.get().partitionId() << 32

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            mark, vec_id, label = (whole.column(c).to_numpy(zero_copy_only=False) for c in ("mark", "vec_id", "label"))
            data = make(matrix(whole.column("x"), dims), vec_id, mark, label, *([whole.column(more).to_pylist()] if more else []))
            return pa.RecordBatch.from_pydict({"block": pa.array([base + made], pa.int64()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, most - sum(b.num_rows for b in held))
                held.append(taken)
                batch = batch.slice(taken.num_rows)
                if sum(b.num_rows for b in held) == most:
                    yield block(held)
                    held, made = [], made + 1
        if held:
            yield block(held)

    return rows.select(*columns).mapInArrow(blocks, "block long, data binary")


def tree_of(rows: np.ndarray, ids: np.ndarray, marks: np.ndarray, labels: np.ndarray) -> bytes:
    return to_bytes(build(rows, ids, marks, labels))


def queries_of(rows: np.ndarray, ids: np.ndarray, marks: np.ndarray, labels: np.ndarray, scores: list[list[int]] | None = None) -> bytes:
    """Anchors, each with a window for each of the scores of its positives."""
    above, below = np.ones((len(rows), POSITIVES), np.int64), np.zeros((len(rows), POSITIVES), np.int64)
    for i, each in enumerate(scores or ()):
        for k, score in enumerate(each):
            above[i, k], below[i, k] = -((-50 * score) // 100), 95 * score // 100
    return to_bytes(Queries(rows, marks, labels, above, below))


@dataclass
class Best:
    """The best rows found so far for a block of anchors, for each of its windows."""

    queries: Queries
    scores: np.ndarray
    ids: np.ndarray


def find_positives(tree: Tree, best: Best) -> None:
    """Rows of the anchor's own label but itself, whatever their score."""
    asked = best.queries

    def wanted(who: np.ndarray, node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mine = (asked.labels[who] == tree.label[node]) | ~tree.pure[node]
        return mine & (high >= best.scores[who, 0, -1])

    def verify(who: np.ndarray, start: int, stop: int, scores: np.ndarray) -> None:
        fits = (asked.labels[who, None] == tree.labels[start:stop]) & (asked.marks[who, None] != tree.marks[start:stop])
        best.scores[who, 0], best.ids[who, 0] = take_best(np.where(fits, scores, NONE), tree.ids[start:stop], best.scores[who, 0], best.ids[who, 0])

    descend(tree, asked.vectors, wanted, verify)


def find_negatives(tree: Tree, best: Best) -> None:
    """Rows of other labels whose score lies in the window of a positive."""
    asked = best.queries

    def wanted(who: np.ndarray, node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = np.maximum(asked.above[who], best.scores[who, :, -1])
        inside = (asked.above[who] <= asked.below[who]) & (high[:, None] >= least) & (low[:, None] <= asked.below[who])
        return inside.any(axis=1) & ~((asked.labels[who] == tree.label[node]) & tree.pure[node])

    def verify(who: np.ndarray, start: int, stop: int, scores: np.ndarray) -> None:
        other = asked.labels[who, None] != tree.labels[start:stop]
        for k in range(asked.above.shape[1]):
            fits = other & (scores >= asked.above[who, k, None]) & (scores <= asked.below[who, k, None])
            if fits.any():
                best.scores[who, k], best.ids[who, k] = take_best(np.where(fits, scores, NONE), tree.ids[start:stop], best.scores[who, k], best.ids[who, k])

    descend(tree, asked.vectors, wanted, verify)


def searched(trees: DataFrame, anchors: DataFrame, find: Callable[[Tree, Best], None], windows: int, most: int) -> DataFrame:
    """(mark, window, id, score): for each anchor and window the best `most` rows of each task; the highest are among them.

    Trees fall into groups and so do blocks of anchors; each tree is sent once for
    each group of anchors and each block of anchors once for each group of trees. The
    groups are as many as the cores need, and split between the two sides so that
    what is sent is least. Nothing is collected and no side is broadcast by order.
    """
    spark = trees.sparkSession
    n_trees, n_blocks = trees.count(), anchors.count()
    cells = 3 * spark.sparkContext.defaultParallelism
    by_tree = max(1, min(n_trees, math.ceil(math.sqrt(cells * max(1, n_trees * TREE_ROWS) / max(1, n_blocks * ANCHOR_ROWS)))))
    by_block = max(1, min(n_blocks, math.ceil(cells / by_tree)))
    left = trees.select("data", F.pmod(F.xxhash64("block"), F.lit(by_tree)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(by_block - 1))).alias("h"))
    right = anchors.select(F.col("block").alias("asked"), F.col("data").alias("queries"), F.pmod(F.xxhash64("block"), F.lit(by_block)).alias("h"), F.explode(F.sequence(F.lit(0), F.lit(by_tree - 1))).alias("g"))
    columns = [F.col("g").cast("int").alias("g"), F.col("h").cast("int").alias("h")]
    wide = max(1, by_tree * by_block)
    left = left.select("data", *columns).repartition(wide, "g", "h")
    right = right.select("asked", "queries", *columns).repartition(wide, "g", "h")

    def cells_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}

        def found() -> Iterator[pa.RecordBatch]:
            for best in held.values():
                n = len(best.queries.marks)
                there = best.scores.ravel() != NONE
                marks = np.repeat(best.queries.marks, windows * most)[there]
                at = np.tile(np.repeat(np.arange(windows, dtype=np.int32), most), n)[there]
                yield pa.RecordBatch.from_pydict({"mark": marks, "window": at, "id": best.ids.ravel()[there], "score": best.scores.ravel()[there]})
            held.clear()

        for batch in batches:
            for data, asked, queries in zip(*(batch.column(c) for c in ("data", "asked", "queries"))):
                name = asked.as_py()
                if name not in held:
                    if len(held) == HELD:
                        yield from found()
                    made = from_bytes(Queries, queries.as_py())
                    shape = (len(made.marks), windows, most)
                    held[name] = Best(made, np.full(shape, NONE, np.int64), np.full(shape, NO_ID, np.int64))
                find(from_bytes(Tree, data.as_py()), held[name])
        yield from found()

    met = left.join(right, ["g", "h"]).select("data", "asked", "queries")
    return met.mapInArrow(cells_of, "mark long, window int, id long, score long")


def highest(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Add `rank`, from 1 by falling score and growing id, and keep the first `most`."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, tree_rows: int = TREE_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, by the contract of the query.

    `whole_vectors` says which vectors are usable and makes them whole numbers; rows
    without vec_id or label, or whose squared length reaches LONGEST, take no part
    either. Repeated rows count each for itself: a copy of an anchor is another row
    and may be its positive, and an anchor that is there twice is answered twice.
    Other columns are ignored. Where nothing fits there are no rows.
    """
    spark = embeddings.sparkSession
    rows, dims = prepared(embeddings)
    if not dims:
        return spark.createDataFrame([], FOUND)
    with Scratch(spark) as scratch:
        return durable(mined(scratch, rows, dims, tree_rows, anchor_rows))


def mined(scratch: Scratch, rows: DataFrame, dims: int, tree_rows: int, anchor_rows: int) -> DataFrame:
    rows = scratch.write(rows, "rows")
    anchors = scratch.write(rows.filter(F.col("vec_id") % EVERY == 0), "anchors")
    # in label order, so that most trees have few labels
    trees = scratch.write(in_blocks(rows.sortWithinPartitions("label"), dims, tree_rows, tree_of), "trees")
    asked = scratch.write(in_blocks(anchors, dims, anchor_rows, queries_of), "asked")
    found = searched(trees, asked, find_positives, 1, POSITIVES)
    positives = scratch.write(highest(found, ["mark"], POSITIVES).select("mark", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    scores = positives.groupBy("mark").agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("scores"))  # five at most
    windows = scores.select("mark", F.posexplode("scores").alias("window", "positive_score"))
    again = in_blocks(anchors.join(scores, "mark"), dims, anchor_rows, queries_of, "scores")
    found = searched(trees, scratch.write(again, "windows"), find_negatives, POSITIVES, NEGATIVES)
    best = highest(found, ["mark", "window"], NEGATIVES)
    named = anchors.select("mark", F.col("vec_id").alias("anchor_id"))
    result = best.join(windows, ["mark", "window"]).join(positives, ["mark", "positive_score"]).join(named, "mark")
    return result.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
