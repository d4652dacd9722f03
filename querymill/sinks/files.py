"""Parquet sinks: partitioned files, tables, predictions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from querymill.functions.dates import DEFAULT_ZONE
from querymill.operators.layout import distribute
from querymill.session import fresh_path
from querymill.sources.files import with_backslash

# The formats predictions may be asked for.
OUTPUT_FORMATS = ("parquet", "application/x-parquet")


def _partition_texts(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Empty partition texts as a lone backslash, which readers undo: the directory of
    an empty text would be that of NULL."""
    marked = with_backslash(df, partition_cols)
    texts = [f.name for f in df.schema if f.name in partition_cols and f.dataType == StringType()]
    return marked.withColumns(
        {n: F.when(F.col(f"`{n}`") == "", "\\").otherwise(F.col(f"`{n}`")) for n in texts}
    )


def _writer(
    df: DataFrame, partition_cols: Sequence[str], max_records_per_file: int | None
) -> DataFrameWriter:
    writer = _partition_texts(df, partition_cols).write.format("parquet")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer


def write_parquet(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    *,
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Write Parquet as the rows lie, without a shuffle.

    Overwriting replaces everything under ``path``; with ``dynamic=True`` only
    the partitions that occur in ``df``. Never overwrite what ``df`` reads.
    """
    (
        _writer(df, partition_cols, max_records_per_file)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .mode(mode)
        .save(path)
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    *,
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Shuffle by the partition columns, then write by the same columns.

    Each partition directory gets a few files of a good size and not one file
    from every task.
    """
    write_parquet(
        distribute(df, partition_cols),
        path,
        partition_cols,
        max_records_per_file=max_records_per_file,
        mode=mode,
        dynamic=dynamic,
    )


def unload(
    df: DataFrame,
    partition_cols: Sequence[str],
    *,
    location: str | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Write to ``location``, which must be new, and return it.

    Without one, to a new path under the shared folder, which goes with the
    application's scratch. Read with ``scan_partitioned``.
    """
    path = fresh_path(df.sparkSession, "unload") if location is None else location
    write_partitioned(
        df,
        path,
        partition_cols,
        max_records_per_file=max_records_per_file,
        mode="errorifexists",
    )
    return path


def create_table_as(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str],
    max_records_per_file: int | None = None,
    *,
    location: str | None = None,
) -> None:
    """Create a partitioned table from a query result.

    The table must not exist. Its files go to ``location``, or to the warehouse like
    those of any other table. Empty partition texts: see ``sources.files``.
    """
    writer = _writer(distribute(df, partition_cols), partition_cols, max_records_per_file)
    writer = writer.mode("errorifexists")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def write_predictions(df: DataFrame, path: str, accept: str = "application/x-parquet") -> None:
    """Write scored rows as Parquet; any other format is refused."""
    if accept not in OUTPUT_FORMATS:
        raise ValueError(f"expected one of {list(OUTPUT_FORMATS)}, got {accept!r}")
    write_parquet(df, path, mode="errorifexists")


def dated_path(
    root: str, name: str = "parsed", run_date: date | None = None, zone: str = DEFAULT_ZONE
) -> str:
    """``<root>/<run date>/<name>``; the run date is yesterday in ``zone`` by default."""
    if run_date is None:
        run_date = datetime.now(ZoneInfo(zone)).date() - timedelta(days=1)
    return f"{root.rstrip('/')}/{run_date.isoformat()}/{name}"
