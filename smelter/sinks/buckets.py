"""Tables laid out in folders by the hash of their key, of which an upsert replaces a few.

A folder is replaced as a whole: its new rows are written next to the table, and once
all of them are there the folders are swapped one by one. A run that dies before that
point leaves the table as it was; `recover_buckets` finishes a swap that was cut short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smelter.schemas import BUCKET
from smelter.sinks.parquet import recover, replace_table, write_table
from smelter.sources import lake

#: Bytes that a folder should hold when the table is laid out, and the bounds of their number.
BUCKET_BYTES = 128 * 1024 * 1024
FEWEST, MOST = 8, 8192
#: The folder of an empty file with the columns, so that a table without rows can be read.
NO_ROWS = -1
READY = "_READY"


def bucket_of(columns: Sequence[Column], n: int) -> Column:
    """Folder of a key; a null is like any other value."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def buckets_for(size: int) -> int:
    return min(max(-(-size // BUCKET_BYTES), FEWEST), MOST)


def _marker(n: int) -> str:
    return f"_buckets-{n}"


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """In how many folders the table was laid out; None if it isn't, or isn't there."""
    for name in lake.names(spark, path):
        if name.startswith(_marker("")):
            return int(name.removeprefix(_marker("")))
    return None


def _staging(path: str) -> tuple[str, str]:
    return f"{path}__swap", f"{path}__gone"


def write_buckets(spark: SparkSession, df: DataFrame, path: str, bucket: Column, n: int) -> int:
    """Replace the whole table by `df`, laid out in `n` folders."""
    recover_buckets(spark, path)
    laid_out = df.withColumn(BUCKET, bucket)

    def finish(staged: str) -> None:
        df.limit(0).write.parquet(f"{staged}/{BUCKET}={NO_ROWS}")
        lake.write_text(spark, f"{staged}/{_marker(n)}", "")

    return replace_table(spark, laid_out, path, (BUCKET,), finish)


def read_buckets(spark: SparkSession, path: str, buckets: Sequence[int]) -> DataFrame:
    """The rows of some folders; the others aren't listed in the scan."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col(BUCKET).isin([*buckets, NO_ROWS])).drop(BUCKET)


def replace_buckets(
    spark: SparkSession, df: DataFrame, path: str, bucket: Column, buckets: Sequence[int]
) -> int:
    """Replace the folders `buckets` by the rows of `df`, all of which belong there."""
    return replace_folders(spark, df.withColumn(BUCKET, bucket), path, BUCKET, buckets)


def replace_folders(
    spark: SparkSession, df: DataFrame, path: str, column: str, values: Sequence[int | str]
) -> int:
    """Replace the folders of some values of `column` by the rows of `df`, all of which belong there.

    `df` may read the table itself. A folder for which it has no rows becomes empty.
    """
    swap, _ = _staging(path)
    recover_buckets(spark, path)
    rows = write_table(df, swap, partition_by=(column,))
    for value in values:
        lake.make_folder(spark, f"{swap}/{column}={value}")
    lake.write_text(spark, f"{swap}/{READY}", "")
    recover_buckets(spark, path)
    return rows


def recover_buckets(spark: SparkSession, path: str) -> None:
    """Finish the swap of a complete new version; forget one that was never completed."""
    recover(spark, path)
    swap, gone = _staging(path)
    found = lake.names(spark, swap)
    if READY in found:
        lake.make_folder(spark, gone)
        for name in found:
            if "=" not in name:
                continue
            if lake.exists(spark, f"{path}/{name}"):
                lake.rename(spark, f"{path}/{name}", f"{gone}/{name}")
            lake.rename(spark, f"{swap}/{name}", f"{path}/{name}")
    lake.remove(spark, swap)
    lake.remove(spark, gone)
