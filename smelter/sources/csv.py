"""Raw CSV scan with declared types, and the lineage stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from smelter.schemas import RawTable

EXTRACTED_AT = "_extracted_at"
SOURCE_FILE = "_source_file"
SOURCE_PATH = "_source_path"
# The text of a line in which a value did not fit its type; null for all others.
UNPARSED = "_unparsed"


def raw_location(raw_root: str, table: RawTable) -> str:
    return f"{raw_root.rstrip('/')}/{table.files}"


def csv_options(table: RawTable, multiline: bool = False) -> dict[str, object]:
    """Reader options.

    `multiline` reads quoted line breaks and doubled quotes correctly, but then
    a file cannot be split, so it is only switched on for free-text tables and
    wants many files rather than one big one.
    """
    options: dict[str, object] = {"header": True, "columnNameOfCorruptRecord": UNPARSED}
    if multiline and table.free_text:
        options.update(multiLine=True, escape='"')
    return options


def header_schema(
    spark: SparkSession, location: str, table: RawTable, multiline: bool = False
) -> T.StructType:
    """Schema in the order of the file's header.

    Only the first line is read. Known columns get their declared type, others
    stay string: no pass over the data, and no value is lost to a guessed type.
    A line with a value that is none of its type keeps its text in one more column.
    """
    names = spark.read.options(**csv_options(table, multiline)).csv(location).columns
    fields = [f"`{n}` {table.columns.get(n, 'string')}" for n in names]
    fields.append(f"{UNPARSED} string")
    return T.StructType.fromDDL(", ".join(fields))


def read_csv(
    spark: SparkSession,
    location: str,
    table: RawTable,
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Scan one raw table.

    With `infer`, Spark guesses types from the data, at the price of an extra
    pass. Without it every file's header is checked against the schema, so a
    shard with other columns fails instead of filling the wrong ones.
    """
    reader = spark.read.options(**csv_options(table, multiline))
    if infer:
        return reader.option("inferSchema", True).csv(location)
    schema = header_schema(spark, location, table, multiline)
    return reader.schema(schema).option("enforceSchema", False).csv(location)


def file_name() -> Column:
    """Name of the file each row was read from."""
    return F.col("_metadata.file_name")


def file_path() -> Column:
    """Path of that file, which tells apart files of one name."""
    return F.col("_metadata.file_path")


def stamp_lineage(df: DataFrame, source: Column, path: Column | None = None) -> DataFrame:
    whole = [] if path is None else [path.alias(SOURCE_PATH)]
    return df.select(
        "*", F.current_timestamp().alias(EXTRACTED_AT), source.alias(SOURCE_FILE), *whole
    )
