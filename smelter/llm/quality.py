"""Quality rules: fixed limits first, then an isolation forest over the rules' statistics.

The forest is grown on clean labelled rows inside the box of all labelled rows. A random
split often leaves a side of the box without clean rows; documents that fall there leave
the tree after few splits. The limit on the mean path is set from labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.words import blocks, each_words, shingles_of

#: Labelled rows that the forest and its limit are fitted on, at most.
LABELLED = 4000
TREES, PER_TREE, DEPTH = 100, 256, 16
#: Share of clean labelled rows that the limit may reject.
CLEAN_LOSS = 0.003
#: Share of the other labelled rows that the limit needs to reject; it is no higher than that takes.
CAUGHT = 0.98
SYMBOLS, WHITE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
UPPER, MARKS = bytes(range(65, 91)), b"!\"'()+,-./:;=?@[\\]^_`{}~"
FOLLOWING = bytes(range(0x80, 0xC0))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
RULES = ", ".join(f"{c} long" for c in COUNTS)


def repeated(words: np.ndarray) -> int:
    """Words in a run of three that the text has at least twice."""
    if len(words) < 4:
        return 0
    _, at, counts = np.unique(shingles_of(words, 3), return_inverse=True, return_counts=True)
    twice = counts[at] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(twice)] |= twice
    return int(covered.sum())


def measure(texts: Iterable[str | None]) -> pd.DataFrame:
    """The counts that the rules look at, for each text; a null text has none of anything."""
    rows = []
    # encoded a block at a time, since a batch may hold many texts
    for text, words in ((t, w) for group in blocks((t or "").encode() for t in texts) for t, w in zip(group, each_words(group))):
        lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
        rows.append(
            (
                len(words), len(text.translate(None, WHITE + FOLLOWING)), len(text) - len(text.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)), repeated(words), len(lines),
                *(len(text) - len(text.translate(None, kind)) for kind in (UPPER, MARKS)),
            )
        )
    return pd.DataFrame(rows, columns=COUNTS, dtype="int64")


def base_failed(counts: pd.DataFrame) -> np.ndarray:
    return ((counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])).to_numpy()


def statistics(counts: pd.DataFrame) -> np.ndarray:
    """What the forest sees: shares, so that a text's length doesn't count by itself."""
    c = {name: counts[name].to_numpy(float) for name in COUNTS}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack(
        [
            c["word_chars"] / words, np.log1p(50 * c["n_symbols"] / words), c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_marks"] / words,
        ],
        axis=1,
    )


@dataclass
class Forest:
    """Trees as tables: split feature (-1: leaf), value, left child (right is the next), and path length of leaves."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    limit: float = 0.0

    def paths(self, rows: np.ndarray) -> np.ndarray:
        """The mean path length of each row."""
        total = np.zeros(len(rows))
        for feature, value, left, path in zip(self.feature, self.value, self.left, self.path):
            at = np.zeros(len(rows), np.int64)
            while (inner := np.flatnonzero(feature[at] >= 0)).size:
                node = at[inner]
                at[inner] = left[node] + (rows[inner, feature[node]] >= value[node])
            total += path[at]
        return total / max(1, len(self.feature))


def leaf_path(n: int) -> float:
    """The mean further path among n rows that were not split any more."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> tuple:
    """One tree; it splits the box between `low` and `high` until a part has at most one row."""
    feature, value, left, path = [-1], [0.0], [0], [0.0]
    todo = [(0, rows, low, high, 0)]
    while todo:
        node, here, low, high, depth = todo.pop()
        wide = np.flatnonzero(high > low)
        if len(here) < 2 or depth == DEPTH or not len(wide):
            path[node] = depth + leaf_path(len(here))
            continue
        f = int(rng.choice(wide))
        v = float(rng.uniform(low[f], high[f]))
        feature[node], value[node], left[node] = f, v, len(feature)
        for side, bound in ((here[:, f] < v, (low, np.where(np.arange(len(high)) == f, v, high))), (here[:, f] >= v, (np.where(np.arange(len(low)) == f, v, low), high))):
            todo.append((len(feature), here[side], *bound, depth + 1))
            feature.append(-1), value.append(0.0), left.append(0), path.append(0.0)
    return tuple(map(np.array, (feature, value, left, path)))


def fit(labelled: pd.DataFrame, seed: int = 3) -> Forest:
    """Forest and limit from measured rows with a column `quality` (1: clean, 0: not).

    Without rows of both kinds that pass the fixed limits, nothing more is rejected.
    """
    rows = labelled[~base_failed(labelled)]
    points, clean = statistics(rows), rows["quality"].to_numpy() == 1
    if clean.all() or not clean.any():
        return Forest(*([],) * 4, limit=-1.0)
    rng = np.random.default_rng(seed)
    low, high = points.min(axis=0), points.max(axis=0)
    good = points[clean]
    trees = [grow(good[rng.choice(len(good), min(PER_TREE, len(good)), replace=False)], low, high, rng) for _ in range(TREES)]
    forest = Forest(*map(list, zip(*trees)))
    rest = points[~clean]
    forest.limit = float(min(np.quantile(forest.paths(good), CLEAN_LOSS), np.quantile(forest.paths(rest), CAUGHT)))
    return forest


def judge(text: Column, forest: Forest | None = None) -> Column:
    """The counts of a text as a struct; with a forest also path, base_failed and kept."""

    @F.pandas_udf(RULES if forest is None else f"{RULES}, path double, base_failed boolean, kept boolean")
    def judged(texts: pd.Series) -> pd.DataFrame:
        counts = measure(texts)
        if forest is None:
            return counts
        failed, path = base_failed(counts), forest.paths(statistics(counts))
        return counts.assign(path=path, base_failed=failed, kept=~failed & (path >= forest.limit))

    return judged(text)


def calibrate(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Forest:
    """A forest from at most `most` labelled rows of `docs`, the ones with the smallest hashes of doc_id."""
    usable = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # no other columns, whose names could clash
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    drawn = usable.join(docs.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    met = docs.join(F.broadcast(drawn), "doc_id")
    # of repeated ids with different texts always the same one
    rows = met.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    rows = rows.select("doc_id", "quality", F.col("first.text").alias("text"))
    measured = rows.select("doc_id", "quality", judge(F.col("text")).alias("m")).select("doc_id", "quality", "m.*")
    return fit(measured.toPandas().sort_values("doc_id", ignore_index=True))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, the counts, path, base_failed, kept.

    A null or empty text has counts of 0 and fails. Repeated rows get equal verdicts.
    Without labels of both kinds only the fixed limits reject. Other columns are
    ignored; an empty table gives no rows.
    """
    forest = calibrate(docs, labels)
    return docs.select("doc_id", judge(F.col("text").cast("string"), forest).alias("m")).select("doc_id", "m.*")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that `assess` keeps."""
    forest = calibrate(docs, labels)
    judged = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), judge(F.col("text").cast("string"), forest).alias("found"))
    return judged.filter("found.kept").select("row.*")
