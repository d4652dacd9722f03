"""Scans of the model registry's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querymill.functions.paths import basename
from querymill.operators.registry import GROUPS, PACKAGES, one_per_key
from querymill.sources.files import scan_parquet
from querymill.sources.versions import committed_versions, version_path


def groups_path(root: str) -> str:
    return f"{root.rstrip('/')}/groups"


def packages_path(root: str) -> str:
    return f"{root.rstrip('/')}/packages"


def read_groups(spark: SparkSession, root: str) -> DataFrame:
    """One row per group, although several writers may have appended it."""
    return one_per_key(scan_parquet(spark, groups_path(root), schema=GROUPS), ["model_group"])


def read_packages(spark: SparkSession, root: str) -> DataFrame:
    """Every row ever appended; see ``current_packages`` for the present state."""
    return scan_parquet(spark, packages_path(root), schema=PACKAGES)


def states_path(root: str) -> str:
    """Versions of the packages' states, each with the files it covers beside it."""
    return f"{root.rstrip('/')}/package_states"


def covered_path(root: str) -> str:
    return f"{root.rstrip('/')}/package_files"


def uncovered_files(spark: SparkSession, root: str, version: str | None) -> list[str]:
    """Files of package rows that the states of ``version`` do not cover.

    Files are listed, not read. Their number is that of the appends since then.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(packages_path(root))
        .select("path", basename(F.col("path")).alias("name"))
    )
    if version is not None:
        covered = scan_parquet(spark, version_path(covered_path(root), version)).select("name")
        listed = listed.join(covered, "name", "left_anti")
    return sorted(r["path"] for r in listed.collect())


def read_recent(spark: SparkSession, root: str) -> DataFrame:
    """Rows that have the same current states as ``read_packages``, without the history that
    ``compact_packages`` has covered: each package's state then, and all rows appended since.
    """
    versions = committed_versions(spark, states_path(root))
    if not versions:
        return read_packages(spark, root)
    states = version_path(states_path(root), versions[-1])
    recent = uncovered_files(spark, root, versions[-1])
    return scan_parquet(spark, states, *recent, schema=PACKAGES)
