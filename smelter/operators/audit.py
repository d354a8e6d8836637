"""Row, null-key, duplicate-key and orphan-key counts of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """What should hold for a table: its key, and the tables its columns refer to."""

    key: tuple[str, ...]
    parents: tuple[tuple[str, str], ...] = ()  # (column, parent table keyed by it)


def _text(columns: Sequence[str]) -> Column:
    """The values as one text, null if any of them is; lengths keep them apart."""
    parts = [F.col(c).cast("string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*(x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)))


def key_counts(df: DataFrame, check: Check, *by: str) -> DataFrame:
    """How often each key and reference stands in a table: (*by, use, value, n).

    The table is read once, however many columns are checked: each row gives its
    key (use 0) and its references (use 1, 2, ...), and equal ones are counted
    together, partly before the shuffle, so a value that repeats without end
    costs nothing extra. Counts of parts of a table add up to those of the table.
    """
    uses = [_text(check.key), *(_text([column]) for column, _ in check.parents)]
    listed = F.array(
        *(F.struct(F.lit(i).alias("use"), u.alias("value")) for i, u in enumerate(uses))
    )
    return df.select(*by, F.inline(listed)).groupBy(*by, "use", "value").agg(F.count(F.lit(1)).alias("n"))


def audit_counts(counted: DataFrame, check: Check, parents: Mapping[str, DataFrame], *by: str) -> DataFrame:
    """One row per measure: (*by, measure, row_count), for each part that `by` names.

    The counts are already spread by value when they meet the keys of the parents.
    """
    if check.parents:
        keys = [
            parents[parent].select(F.lit(i).alias("use"), _text([column]).alias("value"))
            for i, (column, parent) in enumerate(check.parents, start=1)
        ]
        known = reduce(DataFrame.unionByName, keys).distinct().withColumn("known", F.lit(True))
        counted = counted.join(known, ["use", "value"], "left")

    n, use, given = F.col("n"), F.col("use"), F.col("value").isNotNull()
    measures = {
        "total_rows": F.when(use == 0, n),
        "null_keys": F.when((use == 0) & ~given, n),
        "duplicate_keys": F.when((use == 0) & given, n - 1),
    }
    for i, (column, _) in enumerate(check.parents, start=1):
        orphan = (use == i) & given & F.col("known").isNull()
        measures[f"orphan_{column}"] = F.when(orphan, n)
    totals = counted.groupBy(*by).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in measures.items())
    )
    rows = (F.struct(F.lit(m).alias("measure"), F.col(m).alias("row_count")) for m in measures)
    return totals.select(*by, F.inline(F.array(*rows)))


def audit_table(df: DataFrame, check: Check, parents: Mapping[str, DataFrame]) -> DataFrame:
    """One row per measure: (measure, row_count)."""
    return audit_counts(key_counts(df, check), check, parents)


def audit(
    checks: Mapping[str, Check], read: Callable[[str], DataFrame], counts: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per table and measure: (table_name, measure, row_count).

    Tables whose key counts are given aren't read, except as parents of others.
    """
    counts = counts or {}
    parts = []
    for table, check in checks.items():
        parents = {parent: read(parent) for _, parent in check.parents}
        counted = counts[table] if table in counts else key_counts(read(table), check)
        measured = audit_counts(counted, check, parents)
        parts.append(measured.select(F.lit(table).alias("table_name"), "measure", "row_count"))
    return reduce(DataFrame.unionByName, parts)
