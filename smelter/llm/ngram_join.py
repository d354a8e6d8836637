"""Self-join of documents on the Jaccard similarity of their word n-grams.

Filtering by prefix: two sets that are similar enough share something among the first
elements of each, in any order of all elements. Elements are put in order rare ones
first. A rare element is indexed by itself. Frequent ones come in classes, and pairs of
them within a class are indexed, with the prefix extended so far that the elements in
which two similar sets differ can't spoil all its pairs (Wang et al. 2016).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.bucket_join import BucketJoin, bits_of, hamming, has_bit
from smelter.llm.common import Scratch, durable, sent_whole_if_small, small_batches
from smelter.llm.components import components
from smelter.llm.words import LOWER, blocks, mix, shingles_of, slices, word_hashes

#: An element is frequent if it is among the first ones of so many sets. A bit for each hash of FREQUENT_BITS
#: bits keeps them; another element with such a hash counts as frequent too, which costs time, but no link.
FREQUENT, FREQUENT_BITS = 4, 26
#: Sets below this size use no pairs; above, a class of frequent elements has about so many of a set.
PAIRED_SIZE, PER_CLASS = 16, 4
#: 64-bit words of the summary by which most pairs are ruled out, and the pairs that a held set is compared with in one place.
LONGS, PER_PLACE = 8, 512
SETS = "doc_id long, n long, sid binary, bits array<long>, heads array<long>, mark binary"


def rank() -> Column:
    """The order in which the rows of a group are kept: by doc_id, null last, then by a hash of the text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")


def allowed_missing(n: int, num: int, den: int) -> int:
    """The elements of a set of size n that a similar set may lack."""
    return n - -(-num * n // den)


def size_classes(n: int, num: int, den: int) -> range:
    """The size classes of all sets that may be similar to one of size n: powers of two."""
    return range((-(-num * n // den)).bit_length() - 1, (den * n // num).bit_length())


def signatures(elements: np.ndarray, frequent: np.ndarray, num: int, den: int) -> np.ndarray:
    """What a set is indexed by: its elements in ascending order, and which of them are frequent.

    Let m be the elements that a similar set may lack. A rare element in the prefix
    counts 1, c frequent ones of a class count c - 1, as that many must be missing to
    spoil all pairs. The prefix ends when m + 1 is reached. Classes depend on the size
    class; a set is indexed in those of all sets that may be similar, so that two
    similar sets share one. There are fewer classes than a third of the elements, so
    m + 1 is always reached.
    """
    n = len(elements)
    needed = allowed_missing(n, num, den) + 1
    rare = elements[~frequent][:needed]
    if len(rare) == needed:
        return rare
    common = elements[frequent]
    found = [rare]
    for size_class in size_classes(n, num, den):
        left = needed - len(rare)
        if 1 << size_class < PAIRED_SIZE:
            found.append(common[:left])
            continue
        classes = (1 << size_class) // PER_CLASS
        of = mix(common + np.uint64(1)) % np.uint64(classes)
        order = np.argsort(of, kind="stable")
        starts = np.flatnonzero(np.diff(of[order], prepend=np.uint64(classes)))
        for start, end in zip(starts, [*starts[1:], len(order)]):
            taken = common[order[start : min(end, start + left + 1)]]
            first, second = np.triu_indices(len(taken), 1)
            found.append(mix(taken[first] * np.uint64(3) + taken[second] * np.uint64(5) + np.uint64(size_class)))
            left -= len(taken) - 1
            if left <= 0:
                break
    return np.unique(np.concatenate(found))


def sets_of(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, as ascending hashes."""
    for group in blocks(t.translate(LOWER) for t in texts):
        hashes, bounds = word_hashes(group)
        for i in range(len(group)):
            yield np.unique(shingles_of(hashes[bounds[i] : bounds[i + 1]], k))


def identity(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def texts_in(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def indexer(k: int, num: int, den: int, frequent: np.ndarray | None):
    """Each document with its set's size, identity, summary and heads.

    The heads are what a set is indexed by, or, while nothing is known of frequent
    elements, its first elements: a quarter more than would do if none were frequent.
    A set that a task has seen has none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.binary()), ("bits", pa.list_(pa.int64())), ("heads", pa.list_(pa.int64())), ("mark", pa.binary())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in (part for whole in batches for part in slices(whole, 1)):
            columns = [batch.column(0), [], [], [], []]
            for elements in sets_of(texts_in(batch, 1), k):
                sid, n = identity(elements), len(elements)
                heads = None
                if n and sid not in seen:
                    seen.add(sid)
                    if frequent is None:
                        needed = allowed_missing(n, num, den) + 1
                        heads = elements[: needed + needed // 4]
                    else:
                        heads = signatures(elements, has_bit(elements, frequent, FREQUENT_BITS), num, den)
                odd = np.bincount((elements % np.uint64(64 * LONGS)).astype(np.int64), minlength=64 * LONGS) & 1
                bits = np.packbits(odd.astype(np.uint8)).view(np.int64)
                for column, value in zip(columns[1:], (n, sid, bits, None if heads is None else heads.view(np.int64))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([columns[0], *(pa.array(c, f.type) for c, f in zip(columns[1:], list(schema)[1:])), batch.column(2)], schema=schema)

    return index


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, each with the place that asks for it; a row that a task has seen (of a repeated document) is left out."""
    seen: set[tuple] = set()
    for batch in (part for whole in batches for part in slices(whole, 0)):
        new, packed, last = [], [], None
        asked = zip(*(c.to_pylist() for c in batch.columns[1:]))
        for i, row in enumerate(asked):
            if row in seen:
                continue
            seen.add(row)
            if row[-1] != last:
                last, text = row[-1], zlib.compress(batch.column(0)[i].as_py().encode("utf-8", "surrogatepass"), 1)
            new.append(i), packed.append(text)
        kept = batch.take(pa.array(new, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns[1:], pa.array(packed, pa.binary())], ["a", "place", "role", "node", "packed"])


def compare(k: int, num: int, den: int):
    """Links among rows in the order of held text: first the text itself, then those to compare it with."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.uint64)
        for batch in (part for whole in batches for part in slices(whole, 4)):
            a, b = [], []
            *keys, packed = (c.to_pylist() for c in batch.columns)
            for h, place, role, x, elements in zip(*keys, sets_of((zlib.decompress(p) for p in packed), k)):
                if role == 0:
                    held_key, held = (h, place), elements
                elif held_key == (h, place) and len(held):
                    at = np.searchsorted(held, elements)
                    common = int(np.count_nonzero(held[np.minimum(at, len(held) - 1)] == elements))
                    if den * common >= num * (len(held) + len(elements) - common):
                        a.append(h), b.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


class SetJoin(BucketJoin):
    """Sets of n-grams, verified by counting what they share."""

    def __init__(self, docs: DataFrame, scratch: Scratch, k: int, num: int, den: int):
        super().__init__(scratch)
        self.docs, self.k, self.num, self.den = docs, k, num, den
        # similar sets differ in at most (den - num) / (den + num) of both sizes
        self.close = (
            f"{num} * a_n <= {den} * b_n and {num} * b_n <= {den} * a_n"
            f" and {hamming(LONGS)} * {den + num} <= {den - num} * (a_n + b_n)"
        )

    def frequent(self, members: DataFrame) -> np.ndarray:
        """The bits of the frequent elements."""
        counts = members.select(F.explode("heads").alias("element")).groupBy("element").count().filter(f"count >= {FREQUENT}")
        return bits_of(counts.select("element"), FREQUENT_BITS)

    def nodes(self) -> tuple[DataFrame, DataFrame]:
        """Each document's set, and each distinct set once, with a number, its smallest doc_id, summary and signatures."""
        members = self.scratch.write(self.docs.mapInArrow(indexer(self.k, self.num, self.den, None), SETS), "members")
        indexed = self.docs.mapInArrow(indexer(self.k, self.num, self.den, self.frequent(members)), SETS)
        with_heads = indexed.filter("heads is not null").select("sid", "bits", "heads")
        ids = members.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep_id"), F.min(rank()).alias("best"), F.first("n").alias("n"))
        nodes = with_heads.dropDuplicates(["sid"]).join(ids, "sid").withColumn("node", F.monotonically_increasing_id())
        return members.select("doc_id", "n", "sid", "mark"), self.scratch.write(nodes, "nodes")

    def verified(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        """The links among the pairs; a is held while its partners b pass by.

        A node's text is that of its first row, found by doc_id and a hash of the text, so
        that rows without doc_id don't meet. It travels once for each pair, compressed.
        """
        pairs = self.scratch.write(pairs, f"{name}_pairs")
        places = F.ceil(F.col("partners") / PER_PLACE)
        counted = pairs.join(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners")), "a")
        placed = counted.select("a", F.pmod(F.xxhash64("b"), places).cast("int").alias("place"), F.lit(1).alias("role"), F.col("b").alias("node"))
        placed = self.scratch.write(placed, f"{name}_placed")
        held = placed.select("a", "place").distinct().select("a", "place", F.lit(0).alias("role"), F.col("a").alias("node"))
        rows = nodes.select("node", F.col("best.doc_id").alias("rep_id"), F.col("best.mark").alias("rep_mark"))
        asked = self.scratch.write(held.unionByName(placed).join(rows, "node"), f"{name}_asked")
        same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("mark") == F.col("rep_mark"))
        texts = self.docs.join(sent_whole_if_small(asked), same).select("text", "a", "place", "role", "node")
        texts = texts.mapInArrow(pack, "a long, place int, role int, node long, packed binary")
        texts = texts.repartition("a", "place").sortWithinPartitions("a", "place", "role")
        return self.scratch.write(texts.mapInArrow(compare(self.k, self.num, self.den), "a long, b long"), f"{name}_links")


def linked(docs: DataFrame, scratch: Scratch, k: int, num: int, den: int) -> DataFrame:
    """One row for each row of `docs`: doc_id, mark (a hash of the text), n, component_id, and the row that its group keeps."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    join = SetJoin(slim.withColumn("mark", F.unhex(F.md5("text"))), scratch, k, num, den)
    members, nodes = join.nodes()
    labels = components(join.links(nodes), scratch)
    known = nodes.select("node", "sid", "rep_id", "best").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = known.groupBy("label").agg(F.min("rep_id").alias("component_id"), F.min("best").alias("kept"))
    by_set = known.join(smallest, "label").select("sid", "component_id", "kept")
    return members.join(by_set, "sid", "left").select("doc_id", "mark", "n", "component_id", "kept")


def similar_documents(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id.

    A text's set has its distinct runs of k words, A-Z in lower case; of fewer words,
    all of them as one; a null text or one without words has an empty set and is
    linked with nothing. Two rows are linked when den * |intersection| >= num * |union|.
    `component_id` is the smallest doc_id that a row reaches by links, itself included;
    a null doc_id is larger than any. Equal sets are one node of the join, so copies
    are never paired. Other columns are ignored; an empty table gives no rows. Hashes
    stand for the words and sets, of 64 and 128 bits.
    """
    with small_batches(docs.sparkSession), Scratch(docs.sparkSession) as scratch:
        found = linked(docs, scratch, k, num, den)
        return durable(found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def drop_similar(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of `docs`, with all their columns, that their group of linked rows keeps.

    It keeps the smallest doc_id, null last, and of different texts under it one, by a hash
    of the text; rows equal in doc_id and text stay or go together. Rows without words stay.
    """
    with small_batches(docs.sparkSession), Scratch(docs.sparkSession) as scratch:
        found = linked(docs, scratch, k, num, den).filter("kept is not null").filter(~rank().eqNullSafe(F.col("kept")))
        gone = durable(found.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct())
    gone = sent_whole_if_small(gone)
    same_text = F.unhex(F.md5(docs["text"].cast("string"))) == gone["gone_mark"]
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & same_text, "left_anti")
