"""Newest rows from what has arrived lately, and their merge into what is stored.

What has arrived is all extracts from some day on. Nothing newer exists, so the newest
row of a key among them is the newest there is, and taking them in again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from smelter.operators.merge import latest_per_file, latest_per_key, source_of
from smelter.schemas import FILE
from smelter.sources.csv import EXTRACTED_AT


def has_gap(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))


def newest_rows(extracts: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest state that extracts hold.

    Rows that share a key are versions of one another and the newest is kept. A
    row with a gap in its key is no version of anything; it stays for as long as
    the newest extract of its file has it.
    """
    if not key:
        return latest_per_file(extracts)
    gap = has_gap(key)
    return latest_per_key(extracts.filter(~gap), key).unionByName(
        latest_per_file(extracts.filter(gap), extracts)
    )


def with_origin(raw: DataFrame, key: Sequence[str]) -> DataFrame:
    """Put the file of a row with a gap in its key next to its time.

    The time is the one column that every transform hands on as it is.
    """
    file = F.when(has_gap(key), source_of(raw))
    origin = F.struct(F.col(EXTRACTED_AT).alias("at"), file.alias("file"))
    return raw.withColumn(EXTRACTED_AT, origin)


def from_origin(built: DataFrame) -> DataFrame:
    """Time and file as columns of their own again."""
    origin = F.col(EXTRACTED_AT)
    return built.withColumns({EXTRACTED_AT: origin["at"], FILE: origin["file"]})


@dataclass(frozen=True)
class Arrived:
    """What has arrived of a raw table: its newest rows, and which keys and files it replaces."""

    newest: DataFrame
    keys: DataFrame
    files: DataFrame


def arrived(extracts: DataFrame, key: Sequence[str]) -> Arrived:
    return Arrived(
        newest_rows(extracts, key),
        extracts.filter(~has_gap(key)).select(*key).distinct(),
        extracts.select(source_of(extracts).alias(FILE)).distinct(),
    )


def replaced(stored: DataFrame, keys: DataFrame, files: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows that give way: those of a key that came again, and without a whole key those of such a file."""
    by_key = stored.filter(F.col(FILE).isNull()).join(keys, list(key), "left_semi")
    by_file = stored.join(files, stored[FILE] == files[FILE], "left_semi")
    return by_key.unionByName(by_file)


def merged(
    stored: DataFrame, built: DataFrame, keys: DataFrame, files: DataFrame, key: Sequence[str]
) -> DataFrame:
    """`built`, and the stored rows that don't give way.

    A key or file that has come again without a usable row thereby loses its rows.
    """
    whole = stored.filter(F.col(FILE).isNull()).join(keys, list(key), "left_anti")
    gaps = stored.filter(F.col(FILE).isNotNull())
    gaps = gaps.join(files, gaps[FILE] == files[FILE], "left_anti")
    return whole.unionByName(gaps).unionByName(built)


def rebuilt(
    stored: DataFrame, updates: DataFrame, keys: DataFrame, key: Sequence[str]
) -> DataFrame:
    """`stored` with the rows of `keys` taken from `updates`, which has all that are left of them."""
    return stored.join(keys, list(key), "left_anti").unionByName(updates)
