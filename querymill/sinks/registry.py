"""Appends to the model registry's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querymill.functions.paths import basename
from querymill.operators.registry import (
    GROUPS,
    PACKAGES,
    approvals,
    current_packages,
    insert_if_absent,
)
from querymill.sinks.versions import new_version, write_version
from querymill.sources.files import scan_parquet
from querymill.sources.registry import (
    covered_path,
    groups_path,
    packages_path,
    read_groups,
    read_packages,
    states_path,
    uncovered_files,
)
from querymill.sources.versions import committed_versions, version_path


def create_registry(spark: SparkSession, root: str) -> None:
    """Make the registry's tables, empty; nothing happens where they exist."""
    for path, schema in ((groups_path(root), GROUPS), (packages_path(root), PACKAGES)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def register_groups(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Append the groups that are not registered yet."""
    fresh = insert_if_absent(new, read_groups(spark, root), ["model_group"])
    fresh.write.mode("append").parquet(groups_path(root))


def append_packages(root: str, rows: DataFrame) -> None:
    """Append package rows: new packages or new states of known ones."""
    fitted = rows.select(*[F.col(f.name).cast(f.dataType) for f in PACKAGES.fields])
    fitted.write.mode("append").parquet(packages_path(root))


def approve(
    spark: SparkSession, root: str, arns: DataFrame, at: Column | None = None
) -> None:
    """Append approvals; an identifier that is not registered is an error."""
    packages = read_packages(spark, root)
    known = packages.select("model_package_arn").distinct()
    asked = arns.select("model_package_arn").distinct()
    unknown = asked.join(known, "model_package_arn", "left_anti").limit(1).collect()
    if unknown:
        raise ValueError(f"not registered: {unknown[0]['model_package_arn']}")
    append_packages(root, approvals(packages, arns, at))


def compact_packages(spark: SparkSession, root: str) -> str | None:
    """Store each package's current state, so that readers need not go through all history
    again (see ``read_recent``); returns the version, or None where nothing is new.

    It adds up the states stored last and the files appended since; history stays as it is.
    Rows that others append meanwhile are in files that this version does not list, and
    readers take these up. The list of files is written before the states: a compaction that
    died half-way has no finished states, and is not seen. Late rows are fine, as the latest
    state counts whatever was stored first.
    """
    versions = committed_versions(spark, states_path(root))
    last = versions[-1] if versions else None
    recent = uncovered_files(spark, root, last)
    if not recent:
        return None
    stored = [] if last is None else [version_path(states_path(root), last)]
    # Both tables from the one list of files, whatever is appended from here on.
    states = current_packages(scan_parquet(spark, *stored, *recent, schema=PACKAGES))
    names = spark.createDataFrame([(p,) for p in recent], "path string").select(
        basename(F.col("path")).alias("name")
    )
    if last is not None:
        names = names.unionByName(scan_parquet(spark, version_path(covered_path(root), last)))
    version = new_version()
    write_version(names, covered_path(root), version=version)
    write_version(states, states_path(root), version=version)
    return version
