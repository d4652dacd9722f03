"""Versioned sinks: every write makes a new version, no version is rewritten."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from querymill.sources.files import CSV_DIALECT, OWN_CSV, with_backslash
from querymill.sources.versions import version_path

# Full precision, where Spark's defaults keep milliseconds.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def new_version(at: datetime | None = None) -> str:
    """Name of a version made now: sorts by time, safe as a directory name."""
    at = datetime.now(timezone.utc) if at is None else at
    return f"{at:%Y-%m-%dT%H.%M.%S}.{at.microsecond // 1000:03d}Z"


def _target(root: str, version: str | None) -> tuple[str, str]:
    version = new_version() if version is None else version
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", version):
        raise ValueError(f"not a version name: {version!r}")
    return version, version_path(root, version)


def write_version(
    df: DataFrame,
    root: str,
    fmt: str = "parquet",
    version: str | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Write ``df`` as a new version in Parquet, CSV or JSON; returns its name.

    A version that exists already is an error.
    """
    version, path = _target(root, version)
    rows = with_backslash(df) if fmt == "csv" else df
    writer = rows.write.mode("errorifexists").format(fmt)
    if fmt in ("csv", "json"):
        writer = writer.options(**TIME_FORMATS)
    if fmt == "csv":
        writer = writer.options(**CSV_DIALECT, **OWN_CSV)
    elif fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
    _mark_finished(df.sparkSession, path)
    return version


def save_model_version(
    model: PipelineModel, root: str, version: str | None = None
) -> str:
    """Save a fitted model as a new version; returns its name.

    A model is saved in several parts, so its marker is set after the last one.
    """
    version, path = _target(root, version)
    model.save(path)
    _mark_finished(SparkSession.active(), path)
    return version


def _mark_finished(spark: SparkSession, path: str) -> None:
    """Set the marker, unless the committer has."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(marker):
        files.create(marker, False).close()
