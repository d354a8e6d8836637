"""Rows that are alike in several columns next to each other, so that file statistics prune by each of them.

Each column is cut into ranges of about equally many rows. The bits of the range numbers
are interleaved to one number, and rows are sorted by it: rows of a small stretch of that
order lie in few ranges of every column, which a sort by the columns one after the other
only achieves for the first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Ranges of a column: 2 ^ BITS.
BITS = 4
#: Values that the bounds of a column are taken from, at most; the bounds decide where rows lie, never what they are.
SAMPLE = 4096


def bounds(df: DataFrame, column: str, most: int = SAMPLE, bits: int = BITS) -> list:
    """Values that cut a column into up to 2 ^ bits ranges, from a bounded draw of its rows."""
    drawn = df.filter(F.col(column).isNotNull()).select(column).orderBy(F.rand(17)).limit(most)
    values = sorted(r[0] for r in drawn.collect())
    cuts = 1 << bits
    return sorted({values[len(values) * k // cuts] for k in range(1, cuts)}) if values else []


def range_number(column: Column, cuts: Sequence) -> Column:
    """How many of the bounds the value reaches; nulls are in the first range."""
    reached = (F.coalesce(column >= F.lit(b), F.lit(False)).cast("int") for b in cuts)
    return reduce(lambda a, b: a + b, reached, F.lit(0))


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, the highest bit of each first."""
    total = F.lit(0)
    for bit in reversed(range(bits)):
        for number in numbers:
            total = total * 2 + F.shiftright(number, bit).bitwiseAND(1)
    return total


def cluster_key(sources: Mapping[str, DataFrame]) -> Column:
    """The number by which rows are sorted to lie in clusters of some columns.

    Each column's ranges are taken from a table that has it.
    """
    return interleaved([range_number(F.col(c), bounds(df, c)) for c, df in sources.items()])
