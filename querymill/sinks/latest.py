"""The latest row per key, kept up to date from batches of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from querymill.operators.limits import latest_per_key
from querymill.session import materialize
from querymill.sinks.files import write_parquet
from querymill.sources.files import scan_parquet

BUCKET = "_bucket"
MAX_BUCKETS = 4096


def merge_latest(
    path: str,
    new: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    n_buckets: int = 64,
) -> int:
    """Bring the table at ``path`` up to date with ``new``; returns the buckets rewritten.

    The table holds the row with the greatest ``order_by`` values of each key, over all
    batches so far, in ``n_buckets`` directories by the hash of the key. Only directories
    whose keys occur in ``new`` are read and replaced; the others' files stay. The first call
    makes the table, and later ones give the same schema and number of buckets. Late rows
    are fine, as the order decides, and so is a batch that is merged twice. A NULL key is a key
    like any other. Give enough ``order_by`` columns to leave no ties.

    New rows are cut to one per key before they meet the old ones, so a hot key costs a row
    for each task. The merged rows are written aside before any directory is replaced. One
    call at a time may merge into a table.
    """
    if not 1 <= n_buckets <= MAX_BUCKETS:
        raise ValueError(f"n_buckets must be 1 to {MAX_BUCKETS}")
    if BUCKET in new.columns:
        raise ValueError(f"a column is called {BUCKET}")
    spark = new.sparkSession
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n_buckets)).cast("int")
    fresh = materialize(latest_per_key(new, keys, order_by).withColumn(BUCKET, bucket), "fresh")
    # At most n_buckets numbers.
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    if not touched:
        if not _exists(spark, path):
            write_parquet(fresh, path, [BUCKET])
        return 0
    rows = fresh
    if _exists(spark, path):
        known = read_bucketed(spark, path, new.schema).where(F.col(BUCKET).isin(touched))
        rows = latest_per_key(known.unionByName(fresh), [*keys, BUCKET], order_by)
    merged = materialize(rows, "merged")
    write_parquet(merged.repartition(BUCKET), path, [BUCKET], dynamic=True)
    return len(touched)


def read_bucketed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return scan_parquet(spark, path, schema=StructType([*schema, StructField(BUCKET, IntegerType())]))


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The latest row of each key; ``schema`` is that of the batches."""
    return read_bucketed(spark, path, schema).drop(BUCKET)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
