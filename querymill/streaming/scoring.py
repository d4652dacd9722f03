"""Batch scoring of a prefix that files keep arriving under."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from querymill.operators.classifier import predict
from querymill.sources.files import (
    INPUT_FORMATS,
    reader_options,
    scan_parquet,
    without_backslash,
)


def score_arrivals(
    spark: SparkSession,
    model: PipelineModel,
    input_prefix: str,
    output_path: str,
    checkpoint: str,
    schema: StructType,
    *,
    declared: str = "application/x-parquet",
    key_cols: Sequence[str] = (),
    label: str = "species",
    multiline: bool = True,
    own_csv: bool = False,
    files_per_batch: int = 1000,
) -> int:
    """Score the files under a prefix that earlier calls have not scored; returns the number
    of batches this took.

    ``checkpoint`` remembers which files are done, so call again with the same one. Each
    batch replaces ``<output_path>/batch=<number>``. A batch that died half-way keeps its
    number and its files, and a second attempt leaves nothing of the first: each row is
    scored once. A batch without rows leaves no folder. Files must appear whole (written
    elsewhere and moved, as Spark's own writers do) and stay as they are. Formats as in
    ``scan_declared``; ``files_per_batch`` bounds what one batch takes. Read with
    ``read_scores``.
    """
    if declared not in INPUT_FORMATS:
        raise ValueError(f"expected one of {sorted(INPUT_FORMATS)}, got {declared!r}")
    fmt = INPUT_FORMATS[declared]
    arriving = (
        spark.readStream.format(fmt)
        .options(**reader_options(fmt, multiline, own_csv))
        .schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(input_prefix)
    )
    if own_csv and fmt == "csv":
        arriving = without_backslash(arriving)

    def score(rows: DataFrame, number: int) -> None:
        # Partitioned by its own number, and only that partition is replaced.
        numbered = predict(model, rows, key_cols, label).withColumn("batch", F.lit(number))
        (
            numbered.write.partitionBy("batch")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(output_path)
        )

    query = (
        arriving.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] > 0 for progress in query.recentProgress)


def read_scores(spark: SparkSession, output_path: str, schema: StructType) -> DataFrame:
    """All scores so far, with the number of their batch. ``schema`` is that of the scores."""
    numbered = StructType([*schema.fields, StructField("batch", IntegerType())])
    return scan_parquet(spark, output_path, schema=numbered)
