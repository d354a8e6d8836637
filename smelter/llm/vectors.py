"""Embeddings as vectors of whole numbers, and the way from Arrow to numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries from this size on count as non-finite: 256 times them isn't a whole number that a double holds exactly.
LARGEST = float(1 << 44)


def whole_vectors(rows: DataFrame, *keep: str) -> tuple[DataFrame, int]:
    """The columns `keep` and `x`, the vector floor(256 * entry); and the length of x.

    Rows are left out whose vector is null or empty, holds an entry that is null, not
    finite or at least LARGEST in size, or hasn't the length that most of the others
    have (of equally frequent ones, the larger). Without rows the length is 0.
    """
    entries = F.col("embedding").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    # one expression, so that no other column can clash with the names used here
    fine = rows.select(*keep, F.when(~bad & (F.size(entries) > 0), F.transform(entries, lambda c: F.floor(256 * c))).alias("x"))
    fine = fine.filter(F.col("x").isNotNull())
    usual = fine.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    dims = usual["length"] if usual else 0
    return fine.filter(F.size("x") == dims), dims


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The lists of an Arrow column as rows of 64-bit whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
