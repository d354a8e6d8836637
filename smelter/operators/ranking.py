"""Exact ranks that never sort everything in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from smelter.operators.joins import join_with_nulls

# A band this wide holds at most 100 * BAND_WIDTH different amounts of cents,
# which bounds the rows of one sort task.
BAND_WIDTH = 10_000


def ranks_of_amounts(
    counted: DataFrame, amount: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """rank() of each amount, largest first, within `by` or over all rows.

    `counted` has `_n` rows for each amount, a non-null decimal with two digits,
    and perhaps for more columns. An amount's rank is one plus the number of rows
    with a larger amount, and that number is put together from two counts: rows
    in higher bands, and rows above within the band.

    1. A window inside each band counts the rows above. A band is bounded, see
       above, however many rows share it.
    2. A window over the bands counts the rows in higher bands. It sees one row
       per band, at most the largest amount divided by the band width.
    """
    by = list(by)
    band = F.floor(F.col(amount) / BAND_WIDTH).cast("bigint").alias("_band")
    amounts = counted.groupBy(*by, amount).agg(F.sum("_n").alias("_n")).select("*", band)

    def rows_before(window) -> Column:
        return F.coalesce(
            F.sum("_n").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        )

    inside = amounts.select(
        *by,
        "_band",
        amount,
        rows_before(W.partitionBy(*by, "_band").orderBy(F.desc(amount))).alias("_inside"),
    )
    bands = amounts.groupBy(*by, "_band").agg(F.sum("_n").alias("_n"))
    above = bands.select(
        *by,
        "_band",
        rows_before(W.partitionBy(*by).orderBy(F.desc("_band"))).alias("_above"),
    )
    rank = (F.col("_inside") + F.col("_above") + 1).alias(name)
    return join_with_nulls(inside, above, [*by, "_band"]).select(*by, amount, rank)


def add_ranks(
    df: DataFrame, amount: str, ranks: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Add one rank column per entry of `ranks`, which maps its name to its groups.

    Rows are counted per amount and groups once, partly before the shuffle, so any
    number of ties becomes one row.
    """
    groups = list(dict.fromkeys(c for by in ranks.values() for c in by))
    counted = df.groupBy(*groups, amount).agg(F.count(F.lit(1)).alias("_n"))
    ranked = df
    for name, by in ranks.items():
        lookup = ranks_of_amounts(counted, amount, name, by)
        ranked = join_with_nulls(ranked, lookup, [*by, amount])
    return ranked
