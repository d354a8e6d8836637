"""Dedup of lines by a segment-partition edit join.

Two lines at edit distance d or less: cut one into d + 1 segments, and at least one
segment stands unchanged in the other, near its own place (Li et al. 2011). So lines are
indexed by their segments and look up substrings of themselves, for each length that the
other line may have; what meets is verified with bit-parallel edit distance in a band.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.bucket_join import BucketJoin, hamming
from smelter.llm.common import Scratch, durable, in_tasks, sent_whole_if_small
from smelter.llm.components import components
from smelter.llm.words import FACTOR, mix, powers

#: Edits between lines that count as the same; lines shorter than SHORTEST must be equal.
EDITS, SHORTEST = 2, 20
#: Verified pairs that one line meets in one place.
PER_PLACE = 512
WHITE = " \t\n\x0b\x0c\r"
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
LINES = "doc_id long, mark long, at int, lid binary, n long, heads array<long>, bits array<long>"
#: 64-bit words of a line's summary.
LONGS = 2
#: Characters of new lines that are hashed together.
STRETCH = 1 << 18


def edit_distance(a: str, b: str, most: int) -> int:
    """The edit distance of a and b, or most + 1 if it is larger.

    The bits of two words tell along a diagonal band of 2 * most + 1 cells whether the
    distance rises or falls from one cell to the next (Hyyrö 2003); one step for each
    character of b. Equal beginnings and ends are skipped.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    start = 0
    while start < len(a) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a:
        return len(b)
    m, band = len(a), 2 * most + 1
    full = (1 << band) - 1
    # for each character where it stands in the band, as of the step named beside
    masks: dict[str, tuple[int, int]] = {}
    for i, c in enumerate(a[:most]):
        masks[c] = masks.get(c, (0, 0))[0] | 1 << i + most, 0
    # bit k of column j is row j - most + k; the score is that of the band's last row, or of the last of all
    up, down, score = full ^ ((1 << most) - 1), 0, min(most, m)
    for j, c in enumerate(b):
        shift = j - most
        if j + most < m:
            mask, since = masks.get(a[j + most], (0, j))
            masks[a[j + most]] = mask >> j - since | 1 << band - 1, j
        mask, since = masks.get(c, (0, j))
        match = mask >> j - since
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        rises = down | (full & ~(diagonal | up))
        falls = diagonal & up
        if j + most < m:
            score += not diagonal >> (band - 1)
        else:
            last = m - 1 - shift
            score += (rises >> last & 1) - (falls >> last & 1)
        shifted = diagonal >> 1
        up = (falls | (full & ~(shifted | rises))) & full
        down = shifted & rises
    return score if score <= most else most + 1


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of the segments of a line: as equal as can be, the shorter ones first."""
    size, longer = divmod(length, edits + 1)
    sizes = [size + (i > edits - longer) for i in range(edits + 1)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def windows(length: int, edits: int, known: dict = {}) -> np.ndarray:  # noqa: B006
    """Signature number, start and end of all substrings by which a line of the length is found.

    These are its own segments, and for each shorter length that the other line may
    have the substrings at which that line's segments may stand: segment i moves by at
    most i edits from the left and edits - i from the right.
    """
    if (length, edits) not in known:
        if len(known) > 20_000:
            known.clear()
        rows = set()
        for other in range(max(1, length - edits), length + 1):
            for i, (start, size) in enumerate(segments(other, edits)):
                gap = length - other
                for shift in range(-i, edits + gap + 1):
                    if abs(shift) <= i and abs(shift - gap) <= edits - i and 0 <= start + shift <= length - size:
                        rows.add((other * (edits + 1) + i, start + shift, start + shift + size))
        known[length, edits] = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return known[length, edits]


def signatures(lines: list[str], edits: int) -> list[np.ndarray]:
    """For each line a hash for each of its windows: which segment of what length it may be, and its characters."""
    if not lines:
        return []
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    # sums of characters times powers give the hash of a substring as a difference, wherever it stands
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers(len(codes)), dtype=np.uint64)])
    sizes = [len(line) for line in lines]
    found = [windows(size, edits) for size in sizes]
    counts = [len(f) for f in found]
    every = np.concatenate(found)
    moved = np.repeat(np.cumsum([0, *sizes[:-1]]), counts)
    start, end = every[:, 1] + moved, every[:, 2] + moved
    inside = (sums[end] - sums[start]) * powers(len(codes), INVERSE)[start]
    hashes = mix(inside + mix(every[:, 0].astype(np.uint64) + np.uint64(1)))
    return np.split(hashes, np.cumsum(counts[:-1]))


def summaries(lines: list[str]) -> list[np.ndarray]:
    """For each line the bits that tell of which characters it has an odd number."""
    if not lines:
        return []
    width = 64 * LONGS
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) % width
    line = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    odd = np.bincount(line * width + codes, minlength=len(lines) * width) & 1
    return list(np.packbits(odd.astype(np.uint8).reshape(len(lines), width), axis=1).view(np.int64))


def identity(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def lines_of(text: str | None) -> Iterator[tuple[int, str]]:
    """Place and trimmed text of each line with a word."""
    for at, line in enumerate((text or "").split("\n")):
        if line := line.strip(WHITE):
            yield at, line


def splitter(edits: int, shortest: int):
    """Each line's place, identity and length; its signatures just once in a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("at", pa.int32()), ("lid", pa.binary()), ("n", pa.int64()), ("heads", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def pack(rows: list, new: list) -> pa.RecordBatch:
        lines = [line for _, line in new]
        at = [i for i, _ in new]

        def lists(values: list[np.ndarray]) -> pa.Array:
            """The values as a list in the rows of new lines, null in the others."""
            sizes = np.zeros(len(rows), np.int64)
            sizes[at] = [len(v) for v in values]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.append(sizes == 0, False))
            return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *values])))

        heads = lists([s.view(np.int64) for s in signatures(lines, edits)])
        columns = zip(*rows) if rows else [[]] * 5
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays([*arrays, heads, lists(summaries(lines))], schema=schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows, new, size = [], [], 0
            for doc_id, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for at, line in lines_of(text.as_py()):
                    lid = identity(line)
                    if len(line) >= shortest and lid not in seen:
                        seen.add(lid)
                        new.append((len(rows), line))
                        size += len(line)
                    rows.append((doc_id, mark, at, lid, len(line)))
                    if size > STRETCH:
                        yield pack(rows, new)
                        rows, new, size = [], [], 0
            yield pack(rows, new)

    return split


def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that were asked for, by their place and identity, just once in a task."""
    seen: set[int] = set()
    for batch in batches:
        nodes, lines = [], []
        for text, asked in zip(batch.column(0), batch.column(1).to_pylist()):
            wanted = {}
            for a in asked:
                if a["node"] not in seen:
                    seen.add(a["node"])
                    wanted.setdefault(a["at"], []).append(a)
            for at, line in lines_of(text.as_py()):
                for a in wanted.get(at, ()):
                    if a["lid"] == identity(line):
                        nodes.append(a["node"])
                        lines.append(line)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(lines, pa.string())], ["node", "line"])


def comparer(edits: int):
    """Links among rows in the order of held line: first the line itself, then those to compare it with."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, ""
        for batch in batches:
            a, b = [], []
            for h, place, role, x, line in zip(*(c.to_pylist() for c in batch.columns)):
                if role == 0:
                    held_key, held = (h, place), line
                elif held_key == (h, place) and edit_distance(held, line, edits) <= edits:
                    a.append(h), b.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return compare


class LineJoin(BucketJoin):
    """Lines, verified by edit distance."""

    def __init__(self, docs: DataFrame, scratch: Scratch, edits: int):
        super().__init__(scratch)
        self.docs, self.edits = docs, edits
        # an edit takes a character, puts one in, or does both
        self.close = f"abs(a_n - b_n) <= {edits} and {hamming(LONGS)} <= {2 * edits}"

    def verified(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        pairs = self.scratch.write(pairs, f"{name}_pairs")
        asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        asked = nodes.select("node", "lid", "rep_id", "rep_mark", "at").join(asked, "node", "left_semi")
        # a text is found by doc_id and a hash, so that rows without doc_id don't meet; the list has lines of one text
        few = partial(in_tasks, rows=2 * pairs.count())
        asked = few(asked.groupBy("rep_id", "rep_mark").agg(F.collect_list(F.struct("node", "lid", "at")).alias("asked")))
        asked = self.scratch.write(asked, f"{name}_asked")
        same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("mark") == F.col("rep_mark"))
        texts = self.docs.join(sent_whole_if_small(asked, "size(asked)"), same).select("text", "asked")
        lines = self.scratch.write(few(texts.mapInArrow(fetch, "node long, line string").dropDuplicates(["node"])), f"{name}_lines")
        # a line is held once in each place that its partners are dealt to
        held = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_PLACE).cast("int").alias("places"))
        place = F.pmod(F.xxhash64("b"), "places").cast("int").alias("place")
        passing = few(pairs.join(held, "a")).select("a", place, F.lit(1).alias("role"), F.col("b").alias("node"))
        held = held.select("a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.lit(0).alias("role"), F.col("a").alias("node"))
        rows = few(few(held.unionByName(passing)).join(lines, "node")).select("a", "place", "role", F.col("node").alias("b"), "line")
        rows = rows.repartition("a", "place").sortWithinPartitions("a", "place", "role")
        return self.scratch.write(few(rows.mapInArrow(comparer(self.edits), "a long, b long")), f"{name}_links")


def similar_lines(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """One row for each line with a word: doc_id, line, class_doc, class_line, kept.

    `line` counts the text's lines from 0. White space around a line doesn't count. Lines
    are linked when they are equal, or when both have at least `shortest` characters and
    an edit distance of at most `edits`. A class has all lines that links connect; its
    first line, by doc_id and line, is (class_doc, class_line) and is kept, the others
    are not. Null and empty texts have no lines; of repeated rows the first line of each
    is kept. A null doc_id comes last. Other columns are ignored; an empty table gives
    no rows. A hash of 128 bits stands for a line, one of 64 for a substring.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumn("mark", F.xxhash64("text"))
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.write(slim.mapInArrow(splitter(edits, shortest), LINES), "lines")
        texts = found.filter("heads is not null").dropDuplicates(["lid"]).withColumnsRenamed({"doc_id": "rep_id", "mark": "rep_mark"})
        few = partial(in_tasks, rows=found.count())
        nodes = scratch.write(few(texts.withColumn("node", F.monotonically_increasing_id())), "nodes")
        labels = components(LineJoin(slim, scratch, edits).links(nodes), scratch)
        # each line's first place, and that of the class for those that are linked
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at"))
        firsts = found.groupBy("lid").agg(first.alias("first"))
        linked = few(nodes.select("lid", "node").join(labels, "node").select("lid", "label"))
        by_line = few(firsts.join(linked, "lid", "left"))
        smallest = few(by_line.filter("label is not null").groupBy("label").agg(F.min("first").alias("class_first")))
        by_line = few(by_line.join(smallest, "label", "left")).select("lid", F.coalesce("class_first", "first").alias("first"))
        return durable(
            few(found.select("doc_id", "at", "lid").join(by_line, "lid").select(
                "doc_id", F.col("at").alias("line"), F.col("first.doc_id").alias("class_doc"), F.col("first.at").alias("class_line"),
                (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("at") == F.col("first.at"))).alias("kept"),
            ))
        )


def line_report(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """One row for each doc_id of `docs`: doc_id, n_lines, n_dropped, dropped.

    `dropped` lists the lines that are not kept, in their order, with the class each
    belongs to. A doc_id without lines has none; one of repeated rows counts all of them.
    """
    lines = similar_lines(docs, edits, shortest)
    gone = F.when(~F.col("kept"), F.struct("line", "class_doc", "class_line"))
    per_doc = lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(gone).alias("n_dropped"), F.sort_array(F.collect_list(gone)).alias("dropped")
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).distinct()
    met = ids.join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    nothing = F.array().cast("array<struct<line:int,class_doc:long,class_line:int>>")
    return met.select(
        F.col("id").alias("doc_id"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", nothing).alias("dropped"),
    )


def drop_lines(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """The rows of `docs` with their texts freed from lines that are not kept."""
    gone = line_report(docs, edits, shortest).select(F.col("doc_id").alias("id_"), F.col("dropped.line").alias("gone_"))
    met = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.id_")), "left")
    text = F.array_join(F.filter(F.split("d.text", "\n"), lambda _, i: ~F.array_contains("g.gone_", i)), "\n")
    text = F.when(F.size("g.gone_") > 0, text).otherwise(F.col("d.text"))
    return met.select(*(text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
