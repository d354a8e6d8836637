"""Small Column builders shared by the transforms. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def timestamp_of(df: DataFrame, name: str) -> Column:
    """`name` as a timestamp; text that is no timestamp becomes null.

    A column that already holds a timestamp is only cast, which costs nothing,
    instead of being printed and parsed again.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def digits_to_int(column: Column) -> Column:
    """Int for text made of digits only; anything else, or too large, is null."""
    text = column.cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def dated_timestamp(column: Column) -> Column:
    """Timestamp for text that starts with YYYY-MM-DD; anything else is null."""
    text = column.cast("string")
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_timestamp(text))


def whole_or_double(df: DataFrame, name: str) -> Column:
    """A measure ready for multiplication: whole numbers as bigint, so that one
    absurd row cannot overflow int and fail the job."""
    if isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(name).cast("bigint")
    return F.col(name)


def date_key(column: Column) -> Column:
    """yyyyMMdd as int, by arithmetic rather than by formatting a string."""
    day = column.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_true(predicate: Column) -> Column:
    """Boolean flag in which an unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """part / whole * 100, rounded half up; null instead of an error when whole is 0."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def decimal_mean(total: Column, count: Column, digits: int) -> Column:
    """Mean of a money column from its sum and count, rounded half up.

    Lets a mean be assembled from partial sums, which avg() itself does not allow.
    """
    exact = F.try_divide(total.cast("decimal(28,2)"), count.cast("decimal(19,0)"))
    return F.round(exact.cast("decimal(24,6)"), digits)


def tidy_place(column: Column) -> Column:
    """City name without stray blanks, each word capitalised."""
    return F.initcap(F.regexp_replace(F.trim(column), r"\s+", " "))


def tidy_code(column: Column) -> Column:
    """State code without stray blanks, upper case."""
    return F.upper(F.trim(column))


def stable_id(*columns: Column) -> Column:
    """Positive bigint derived from the values alone: the first 60 bits of their md5.

    The same values get the same id in every run, whatever other rows there
    are, and no task has to see all rows to number them.
    """
    digest = F.md5(F.concat_ws("\u001f", *columns))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
