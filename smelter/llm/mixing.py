"""Mixing sources to target weights with a low-discrepancy schedule.

The points of the golden-ratio sequence are mapped through the cumulative target
weights, so that each stretch of the schedule holds the sources in proportion. The
k-th slot of a source takes the k-th block of that source's shuffled words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import durable, numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
#: Words in a block.
BLOCK = 1024
#: The fraction of the golden ratio, in units of 2^-53: multiples keep their whole precision.
GOLDEN = 5566755282872655
SOURCE = ["no_source", "source_name"]


def mark() -> Column:
    """Tells rows with one doc_id apart."""
    return F.xxhash64(F.col("source").cast("string"), F.col("text").cast("string"))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source (as a flag for null and a name), size in words, and the row's place in the shuffle."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_name"),
        size.cast("long").alias("size"),
        key.alias("shuffle"),
        F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("part"),
        mark().alias("mark"),
    )


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row for each source: source_size, target, taken_words, blocks, slots.

    The weights repeat over the sources by code point, null last. All targets rise in
    proportion to weight until they sum to `share` of all words; one that reaches
    `most` times its source's size stays there. With sources in order of size by
    weight, those that stay are a beginning of that order.
    """
    sizes = rows.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(*SOURCE)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    listed = sizes.withColumn("weight", weight.cast("long"))
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), *SOURCE)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = listed.withColumn("level", level)
    full = most * F.col("source_size") <= F.col("level") * F.col("weight")
    first_open = F.min(F.when(~full, F.struct(F.col("source_size") / F.col("weight"), *SOURCE, "level"))).over(everything)
    target = F.when(full | first_open.isNull(), (most * F.col("source_size")).cast("double")).otherwise(first_open["level"] * F.col("weight"))
    size, words = F.col("source_size"), F.col("taken_words")
    return (
        levels.withColumn("target", target)
        .withColumn("taken_words", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("blocks", -F.floor(-size / BLOCK))
        .withColumn(
            "slots",
            F.when(size == 0, F.lit(0)).otherwise(F.floor(words / size) * F.col("blocks") - F.floor(-(words % size) / BLOCK)).cast("long"),
        )
        .select(*SOURCE, "source_size", "target", "taken_words", "blocks", "slots")
    )


def schedule(spark, plan: DataFrame) -> DataFrame:
    """slot, source, turn and the source's numbers: who has each slot, and which of its turns that is.

    Slot i has the point frac(i * golden ratio); the source whose share of the weights
    holds it gets the slot. A source takes as many turns as its target has blocks:
    turns beyond that are void, missing ones (a few for each source, as the sequence
    has low discrepancy) come after the end.
    """
    total = Window.partitionBy()
    upto = Window.orderBy(*SOURCE).rowsBetween(Window.unboundedPreceding, 0)
    shares = plan.filter("slots > 0").withColumn("all_slots", F.sum("slots").over(total)).withColumn("high", F.sum("slots").over(upto))
    shares = durable(shares.withColumn("low", F.col("high") - F.col("slots")))
    n = shares.agg(F.coalesce(F.max("all_slots"), F.lit(0))).first()[0]
    unit = 1 << 53
    # i * GOLDEN modulo 2^53, from two halves of i so that no product overflows
    high, low = F.shiftright("id", 20), F.col("id").bitwiseAND((1 << 20) - 1)
    step = (GOLDEN << 20) % unit

    def times(x: Column, factor: int) -> Column:
        upper, lower = factor >> 27, factor & ((1 << 27) - 1)
        return ((x * upper) % (1 << 26) * (1 << 27) + x * lower) % unit

    point = ((times(high, step) + times(low, GOLDEN)) % unit).cast("double") / float(unit)
    points = spark.range(n).select(F.col("id").alias("slot"), F.floor(point * n).alias("at"), F.pmod(F.xxhash64("id"), F.lit(4096)).cast("int").alias("part"))
    # equal steps of the weights; each maps to one source, so the match is an equality
    span = max(1, -(-n // 65536))
    cells = shares.select(*SOURCE, "low", "high", F.explode(F.sequence(F.floor(F.col("low") / span), F.floor((F.col("high") - 1) / span))).alias("cell"))
    drawn = points.withColumn("cell", F.floor(F.col("at") / span)).join(cells, "cell").filter("at >= low and at < high")
    drawn = drawn.select("slot", "no_source", "source_name", F.floor(F.col("slot") / max(1, -(-n // 4096))).cast("int").alias("part"))
    numbers = shares.select(*SOURCE, "slots", "source_size", "taken_words", "blocks")
    ranked = numbered(durable(drawn), SOURCE, ["slot"], "turn", extra=numbers).drop("part")
    have = ranked.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("have"))
    wanted = numbers.join(have, SOURCE, "left").withColumn("have", F.coalesce("have", F.lit(0)))
    missing = F.explode(F.sequence("have", F.col("slots") - 1))
    late = wanted.filter("have < slots").withColumn("turn", missing).withColumn("slot", F.lit(n)).drop("have")
    return ranked.unionByName(late).filter("turn < slots")


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Every row of `docs` with what the mix takes of it: doc_id, source, size, source_size, target, start, taken, first_pass, second_pass, first_slot, second_slot.

    `start` counts the words of the source before the row in shuffled order; the
    passes tell how many words are taken in the first and second round over the
    source, always from the row's beginning, and in which slot of the schedule the
    block lies that holds the first of them (null if none is taken). A null text has size 0, a null source is
    a source of its own, and rows without words take part with 0. The shuffle depends
    on doc_id and seed only, so reruns agree; repeated rows may change places.
    Other columns are ignored; an empty table gives no rows. One task holds the list
    of sources, so there should be no more than millions of them.
    """
    rows = durable(sized(docs, seed))
    plan = durable(targets(rows))
    numbers = plan.select(*SOURCE, "source_size", "target")
    placed = durable(numbered(rows, SOURCE, ["shuffle", "doc_id", "size"], "start", "size", numbers))
    slots = schedule(docs.sparkSession, plan)
    block, turn_words = F.col("turn") % F.col("blocks"), F.least(F.lit(BLOCK), F.col("source_size") - F.col("turn") % F.col("blocks") * BLOCK)
    begun = F.floor(F.col("turn") / F.col("blocks")) * F.col("source_size") + block * BLOCK
    slots = slots.select(
        *SOURCE, block.alias("block"), F.floor(F.col("turn") / F.col("blocks")).cast("int").alias("pass"),
        F.least(turn_words, F.col("taken_words") - begun).alias("words"), "slot",
    )
    taken = slots.groupBy(*SOURCE, "block").agg(
        *(F.max(F.when(F.col("pass") == k, F.col(c))).alias(f"{c}_{k}") for c in ("words", "slot") for k in (0, 1))
    )
    row = ["doc_id", *SOURCE, "size", "source_size", "target", "start", "mark"]
    pieces = placed.filter("size > 0").select(
        *row,
        F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK))).alias("block"),
    )
    low = F.greatest(F.col("start"), F.col("block") * BLOCK) - F.col("block") * BLOCK
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK) - F.col("block") * BLOCK

    def words_of(k: int) -> Column:
        return F.greatest(F.lit(0), F.least(high, F.coalesce(f"words_{k}", F.lit(0))) - low)

    joined = pieces.join(taken, [*SOURCE, "block"], "left")
    # a source's blocks get their slots in order, so the smallest slot is that of the row's first block
    per_row = joined.groupBy(*row).agg(
        F.sum(words_of(0)).alias("first_pass"), F.sum(words_of(1)).alias("second_pass"),
        F.min(F.when(words_of(0) > 0, F.col("slot_0"))).alias("first_slot"), F.min(F.when(words_of(1) > 0, F.col("slot_1"))).alias("second_slot"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    empty = placed.filter("size = 0").select(
        *row, zero.alias("first_pass"), zero.alias("second_pass"), none.alias("first_slot"), none.alias("second_slot")
    )
    return per_row.unionByName(empty).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source_name")).alias("source"), "size", "source_size", "target", "start",
        (F.col("first_pass") + F.col("second_pass")).alias("taken"), "first_pass", "second_pass", "first_slot", "second_slot", "mark",
    )


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as rows of `docs`, in the order of the schedule: one for each pass that takes of a row, cut where the mix ends.

    A row stands where the slot of its first block is, rows of one block by their
    start. So each stretch of the result holds the sources in about the proportion of
    their targets. Rows that the mix takes nothing of are left out. Repeated rows each
    have their own part.
    """
    same = Window.partitionBy("id", "mark")
    passes = mix(docs, seed).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), "mark", "size", "start",
        F.array(F.struct(F.col("first_pass").alias("words"), F.col("first_slot").alias("slot")), F.struct(F.col("second_pass").alias("words"), F.col("second_slot").alias("slot"))).alias("taken"),
    )
    passes = passes.withColumn("nth", F.row_number().over(same.orderBy("start")))
    # a row travels as one value, so that none of its columns can clash with those used here
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), mark().alias("mark"), whole)
    rows = rows.withColumn("nth", F.row_number().over(same.orderBy("id")))
    # the numbers of repeated rows are compared after the join, which so keeps the windows' partitioning
    met = rows.alias("d").join(
        passes.alias("t"),
        (F.col("d.id") == F.col("t.id")) & (F.col("d.mark") == F.col("t.mark")) & (F.col("d.nth") - F.col("t.nth") == 0),
    )
    each = met.select("row", "size", "start", F.explode("taken").alias("part")).select("row", "size", "start", "part.words", "part.slot").filter("words > 0")
    each = each.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start")
    # words with the white space before them; no pattern that Java would match by recursion
    pieces = F.regexp_extract_all("row.text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") >= F.col("size"), F.col("row.text")).otherwise(cut)
    return each.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
