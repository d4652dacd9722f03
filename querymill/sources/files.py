"""Scans of Parquet, CSV and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from querymill.sources.csv_ranges import RANGE_BYTES, scan_csv_ranges

# The formats a scoring input may be declared as.
INPUT_FORMATS = {
    "parquet": "parquet",
    "csv": "csv",
    "application/x-parquet": "parquet",
    "text/csv": "csv",
}

# Quoted as in RFC 4180, blanks kept: what the CSV sink writes is read back unchanged.
CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "charToEscapeQuoteEscaping": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# For files of our own: NULL is written as this marker, and a text that begins with a
# backslash with one more, so no text is taken for it. The line end is stated, as a
# guessed one swallows NUL characters after line breaks.
OWN_CSV = {"nullValue": "\\N", "lineSep": "\n"}


def reader_options(fmt: str, multiline: bool = True, own_csv: bool = False) -> dict[str, str]:
    """Options of a reader with a schema, for scans and streams alike."""
    options = {"mode": "FAILFAST"} if fmt in ("csv", "json") else {}
    if fmt == "csv":
        options |= CSV_DIALECT | {"multiLine": str(multiline).lower(), "enforceSchema": "false"}
        if own_csv:
            options |= OWN_CSV
    return options


def reader_for(
    spark: SparkSession,
    fmt: str,
    schema: StructType | None = None,
    multiline: bool = True,
    own_csv: bool = False,
) -> DataFrameReader:
    """Reader for one format; text that does not parse stops the query.

    ``own_csv`` is for CSV files the version sink wrote; what it reads has to go through
    ``without_backslash``. In other CSV files an empty field is a NULL, quoted or not.
    """
    reader = spark.read.format(fmt).options(**reader_options(fmt, multiline, own_csv))
    if fmt == "csv":
        reader = reader.option("inferSchema", schema is None)
    return reader if schema is None else reader.schema(schema)


def _text_columns(df: DataFrame, names: Sequence[str] | None) -> list[str]:
    wanted = df.columns if names is None else names
    return [f.name for f in df.schema if f.name in wanted and f.dataType == StringType()]


def with_backslash(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Texts that begin with a backslash get one more, so that a marker can begin with one."""
    quoted = {n: F.col(f"`{n}`") for n in _text_columns(df, names)}
    return df.withColumns(
        {
            n: F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c)
            for n, c in quoted.items()
        }
    )


def without_backslash(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Undo ``with_backslash``."""
    quoted = {n: F.col(f"`{n}`") for n in _text_columns(df, names)}
    return df.withColumns(
        {
            n: F.when(c.startswith("\\"), F.substr(c, F.lit(2))).otherwise(c)
            for n, c in quoted.items()
        }
    )


def scan_partitioned(
    spark: SparkSession, path: str, schema: StructType, partition_cols: Sequence[str]
) -> DataFrame:
    """What ``write_partitioned`` wrote, with empty texts apart from NULLs among the
    partition values. A filter on a partition column still prunes directories."""
    return without_backslash(scan_parquet(spark, path, schema=schema), partition_cols)


def scan_parquet(
    spark: SparkSession, *paths: str, schema: StructType | None = None
) -> DataFrame:
    """Parquet files, with partition columns taken from directory names.

    With a schema no file is opened to learn it, an empty directory reads as no
    rows, and partition values keep the declared types.
    """
    return reader_for(spark, "parquet", schema).load(list(paths))


def _load_csv(
    spark: SparkSession,
    paths: list[str],
    schema: StructType | str | None,
    multiline: bool,
    own_csv: bool,
    recursive: bool,
    range_bytes: int,
) -> DataFrame:
    reader = reader_for(spark, "csv", schema, multiline, own_csv)
    plain = reader.option("recursiveFileLookup", recursive).load(paths)
    if schema is None or not multiline:
        return plain
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Columns from directory names are Spark's scan's alone.
    if plain.columns != schema.fieldNames():
        return plain
    options = CSV_DIALECT | (OWN_CSV if own_csv else {})
    return scan_csv_ranges(
        plain,
        paths,
        schema,
        options,
        recursive=recursive,
        own=own_csv,
        range_bytes=range_bytes,
    )


def scan_csv(
    spark: SparkSession,
    *paths: str,
    schema: StructType | None = None,
    multiline: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """CSV files with a header line.

    Without a schema the types are inferred, which reads the input once more. A
    header that does not fit the schema, or a malformed row, stops the query.
    Quoted fields may hold line breaks. With a schema, files of more than ``range_bytes``
    are cut into ranges all the same, for which they are read twice (see
    ``csv_ranges``); without one each file is read by one task. ``multiline=False`` is for
    files known to have no line breaks in fields: one pass, no Python.
    """
    return _load_csv(spark, list(paths), schema, multiline, False, False, range_bytes)


def scan_json(
    spark: SparkSession, *paths: str, schema: StructType | None = None
) -> DataFrame:
    """JSON files with one object per line."""
    return reader_for(spark, "json", schema).load(list(paths))


def scan_prefix(
    spark: SparkSession,
    prefix: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    *,
    multiline: bool = True,
    own_csv: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """All files of one format at any depth under ``prefix``.

    ``multiline`` and ``range_bytes`` as in ``scan_csv``. ``own_csv`` is for CSV files that
    the version sink wrote.
    """
    if fmt == "csv":
        rows = _load_csv(spark, [prefix], schema, multiline, own_csv, True, range_bytes)
        return without_backslash(rows) if own_csv else rows
    reader = reader_for(spark, fmt, schema, multiline, own_csv)
    return reader.option("recursiveFileLookup", True).load(prefix)


def scan_declared(
    spark: SparkSession,
    prefix: str,
    declared: str = "application/x-parquet",
    schema: StructType | None = None,
    *,
    multiline: bool = True,
    own_csv: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Everything under ``prefix`` in the declared format, Parquet or CSV.

    Any other format is refused before a file is looked at. ``multiline``, ``own_csv`` and
    ``range_bytes`` as in ``scan_prefix``.
    """
    if declared not in INPUT_FORMATS:
        raise ValueError(f"expected one of {sorted(INPUT_FORMATS)}, got {declared!r}")
    return scan_prefix(
        spark,
        prefix,
        INPUT_FORMATS[declared],
        schema,
        multiline=multiline,
        own_csv=own_csv,
        range_bytes=range_bytes,
    )
