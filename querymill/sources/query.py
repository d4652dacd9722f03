"""Datasets defined by a SQL query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from querymill.sinks.files import create_table_as, unload
from querymill.sources.files import scan_partitioned, without_backslash


def query_dataset(
    spark: SparkSession,
    query: str,
    partition_cols: Sequence[str],
    *,
    as_table: str | None = None,
    location: str | None = None,
    max_records_per_file: int | None = None,
) -> DataFrame:
    """Run any SELECT over the session's tables and views, store it, read it back.

    The result goes to Parquet partitioned by ``partition_cols``: plain files, or the
    table ``as_table``. They lie at ``location``, which must be new; without one, files
    go to scratch and a table's to the warehouse. Partition columns come last in what
    is read back.
    """
    result = spark.sql(query)
    missing = [c for c in partition_cols if c not in result.columns]
    if missing:
        raise ValueError(f"the query has no column {', '.join(missing)}")
    if as_table is not None:
        create_table_as(
            result, as_table, partition_cols, max_records_per_file, location=location
        )
        return without_backslash(spark.table(as_table), partition_cols)
    path = unload(
        result, partition_cols, location=location, max_records_per_file=max_records_per_file
    )
    return scan_partitioned(spark, path, result.schema, partition_cols)
