"""Versioned datasets: ``<root>/version=<v>/``, one directory per version."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from querymill.sources.files import reader_for, without_backslash


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def committed_versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the finished versions, oldest first.

    Lists one directory level. A version counts once its ``_SUCCESS`` marker is
    there, so a write that died half-way is never read.
    """
    markers = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        version_path(root, "*") + "/_SUCCESS"
    )
    files = markers.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(
        found.getPath().getParent().getName().removeprefix("version=")
        for found in files.globStatus(markers) or []
    )


def latest_version(spark: SparkSession, root: str) -> str:
    versions = committed_versions(spark, root)
    if not versions:
        raise ValueError(f"no finished version under {root}")
    return versions[-1]


def load_versions(
    spark: SparkSession,
    root: str,
    versions: list[str] | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
    *,
    multiline: bool = True,
) -> DataFrame:
    """Versions of a dataset as one lazy DataFrame with a ``version`` column.

    All finished ones, unless ``versions`` names some. A filter on ``version``
    prunes directories. Without a schema each version is read with its own (that of one
    of its files); a column that a version lacks is NULL in its rows, and a column with
    different types stops the query. ``multiline=False``: see ``scan_csv``.
    """
    versions = committed_versions(spark, root) if versions is None else versions
    if not versions:
        raise ValueError(f"no finished version under {root}")
    paths = [version_path(root, v) for v in versions]
    if schema is not None:
        by_schema = [(schema, paths)]
    else:
        by_schema = []
        for path in paths:
            own = reader_for(spark, fmt, multiline=multiline, own_csv=True).load(path).schema
            same = [group for known, group in by_schema if known == own]
            if same:
                same[0].append(path)
            else:
                by_schema.append((own, [path]))
        _check_types([own for own, _ in by_schema])
    # The last version's columns come first.
    frames = []
    for own, group in reversed(by_schema):
        with_version = StructType(list(own.fields)).add("version", StringType())
        reader = reader_for(spark, fmt, with_version, multiline, own_csv=True)
        rows = reader.option("basePath", root).load(group)
        frames.append(without_backslash(rows, own.names) if fmt == "csv" else rows)
    together = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)
    return together.select([F.col(f"`{c}`") for c in together.columns if c != "version"] + ["version"])


def _check_types(schemas: list[StructType]) -> None:
    known: dict[str, DataType] = {}
    for schema in schemas:
        for field in schema:
            if known.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"versions differ in the type of {field.name}")


def load_latest(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    *,
    multiline: bool = True,
) -> DataFrame:
    """The latest version only; no other version's files are listed or read."""
    latest = latest_version(spark, root)
    return load_versions(spark, root, [latest], fmt, schema, multiline=multiline)


def version_from_path(path: Column | None = None) -> Column:
    """Version of a file in the layout ``<root>/<version>/<file>``."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def model_versions(
    spark: SparkSession, root: str
) -> dict[str, Callable[[], PipelineModel]]:
    """All versions of a fitted model: name to a function that loads it."""
    return {
        v: partial(PipelineModel.load, version_path(root, v))
        for v in committed_versions(spark, root)
    }


def load_latest_model(spark: SparkSession, root: str) -> PipelineModel:
    return PipelineModel.load(version_path(root, latest_version(spark, root)))
