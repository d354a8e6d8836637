"""Join variants."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def join_with_nulls(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi join in which a null key matches a null key.

    Output: the columns of `left`, then those of `right` that are no keys.
    Still planned as a hash or sort-merge join.
    """
    lookup = right.select(
        *(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)),
        *(c for c in right.columns if c not in keys),
    )
    same: list[Column] = [
        F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)
    ]
    joined = left.join(lookup, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*(f"_key_{i}" for i in range(len(keys))))
