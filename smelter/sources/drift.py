"""Schemas of appended extracts: what may change from one to the next, and the schema they share.

A bronze table that extracts are appended to has a stored schema, one version for each
change. Columns may come and go, types may widen without loss; any other change is
refused before a row is written. Files keep the types they were written with: Spark's
reader widens them to the newest schema.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from smelter.schemas import APPEND_PARTITIONS
from smelter.sources.lake import Lake, exists, names, read_text, write_text

#: Digits that a decimal needs before the point to hold all whole numbers of a type.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
#: Types without loss in another: whole numbers in longer ones, up to 32 bits in doubles.
WIDER = {
    T.ByteType(): (T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    T.ShortType(): (T.IntegerType(), T.LongType(), T.DoubleType()),
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}


class SchemaDrift(ValueError):
    """An extract has a column whose type neither widens the stored one nor fits into it."""


def fits(narrow: T.DataType, wide: T.DataType) -> bool:
    """Whether all values of one type are values of the other, and a file's reader can widen them."""
    if narrow == wide or wide in WIDER.get(narrow, ()):
        return True
    if not isinstance(wide, T.DecimalType):
        return False
    whole = wide.precision - wide.scale
    if isinstance(narrow, T.DecimalType):
        return narrow.scale <= wide.scale and narrow.precision - narrow.scale <= whole
    return narrow in WHOLE and WHOLE[narrow] <= whole


def widened(stored: T.StructType, came: T.StructType) -> T.StructType:
    """The schema that holds both, in the stored order with new columns last; names differ by more than case."""
    known = {f.name.lower(): f for f in stored}
    fields = {}
    for field in came:
        old = known.get(field.name.lower())
        if old is None or fits(old.dataType, field.dataType):
            name = field.name if old is None else old.name
            fields[name] = T.StructField(name, field.dataType)
        elif not fits(field.dataType, old.dataType):
            types = f"{old.dataType.simpleString()} to {field.dataType.simpleString()}"
            raise SchemaDrift(f"column {field.name} changes from {types}")
    kept = [fields.pop(f.name, T.StructField(f.name, f.dataType)) for f in stored]
    return T.StructType([*kept, *fields.values()])


def versions(spark: SparkSession, lake: Lake, table: str) -> list[T.StructType]:
    """All stored schemas of a table, the newest last."""
    path = lake.schema_path(table)
    numbers = sorted(int(n) for n in names(spark, path) if n.isdigit())
    texts = (read_text(spark, f"{path}/{n}") for n in numbers)
    return [T.StructType.fromJson(json.loads(text)) for text in texts]


def conformed(spark: SparkSession, lake: Lake, table: str, df: DataFrame) -> DataFrame:
    """An extract in the schema of its table, which takes in what is new in the extract.

    The new version is stored before any row is written; readers can use it at once, as
    older files are widened and lack only columns that are null then.
    """
    known = versions(spark, lake, table)
    came = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if known:
        before = known[-1]
    elif exists(spark, lake.path(table)):  # appended to before schemas were kept
        whole = spark.read.option("mergeSchema", True).parquet(lake.path(table))
        before = whole.drop(*APPEND_PARTITIONS).schema
    else:
        before = came
    after = widened(before, came)
    if not known or after != known[-1]:
        write_text(spark, f"{lake.schema_path(table)}/{len(known) + 1}", after.json())
    given = {c.lower(): c for c in df.columns}
    return df.select(
        *(
            (F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in after
        )
    )
