"""Model registry kept as append-only tables.

A package's history is a series of rows; nothing is updated in place. The
current state is the latest row per package, so a row written twice by two
writers does no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from querymill.functions.paths import basename
from querymill.operators.limits import latest_per_key

# Approval states of a package.
PENDING = "PendingManualApproval"
APPROVED = "Approved"

# Fixed value: end of an artifact's name.
ARTIFACT = "-model.tar.gz"

GROUPS = StructType(
    [StructField("model_group", StringType()), StructField("description", StringType())]
)

PACKAGES = StructType(
    [
        StructField("model_group", StringType()),
        StructField("version", StringType()),
        StructField("model_package_arn", StringType()),
        StructField("model_url", StringType()),
        StructField("description", StringType()),
        StructField("approval_status", StringType()),
        StructField("updated_at", TimestampType()),
    ]
)


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append: keys not in ``existing``, one row per key.

    Both sides are cut to one row per key before they meet, so repeated keys
    never gather in one task. NULL is a key like any other.
    """
    one = one_per_key(new, keys)
    known = existing.select([F.col(f"`{k}`").alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)]
    return one.join(known.distinct(), reduce(and_, same), "left_anti")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key, always the same one of several; columns of any type."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    named = [F.col(f"`{k}`") for k in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    kept = df.groupBy(*named).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return kept.select(*named, "_row.*").select([F.col(f"`{c}`") for c in df.columns])


def new_packages(
    models: DataFrame,
    model_url: str,
    description: str = "",
    at: Column | None = None,
    arn_prefix: str = "model-package",
) -> DataFrame:
    """Registry rows for models given as (model_group, version), all pending.

    The artifact's name starts with the model's version; that is the link from a
    package back to the dataset version it was trained into.
    """
    version = F.col("version").cast("string")
    return models.select(
        "model_group",
        version.alias("version"),
        F.concat_ws("/", F.lit(arn_prefix), "model_group", version).alias("model_package_arn"),
        F.concat(F.lit(model_url.rstrip("/") + "/"), version, F.lit(ARTIFACT)).alias(
            "model_url"
        ),
        F.lit(description).alias("description"),
        F.lit(PENDING).alias("approval_status"),
        (F.current_timestamp() if at is None else at).alias("updated_at"),
    )


def current_packages(packages: DataFrame) -> DataFrame:
    """Latest row of each package; at equal times a decision beats pending."""
    return latest_per_key(
        packages,
        ["model_package_arn"],
        [F.col("updated_at"), F.col("approval_status") != PENDING, F.col("approval_status")],
    )


def approvals(packages: DataFrame, arns: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows to append so that the packages in ``arns`` become approved.

    Histories shrink to one row each before the join, however long they are.
    """
    chosen = arns.select("model_package_arn").distinct()
    return (
        current_packages(packages)
        .join(chosen, "model_package_arn", "left_semi")
        .withColumns(
            {
                "approval_status": F.lit(APPROVED),
                "updated_at": F.current_timestamp() if at is None else at,
            }
        )
        .select(*packages.columns)
    )


def package_status(packages: DataFrame, group: str | None = None) -> DataFrame:
    """Identifier and current state of each package (of one group, if given)."""
    if group is not None:
        packages = packages.where(F.col("model_group") == group)
    return current_packages(packages).select("model_package_arn", "approval_status")


def pending(packages: DataFrame, group: str | None = None) -> DataFrame:
    """Packages that still wait for approval."""
    return package_status(packages, group).where(F.col("approval_status") == PENDING)


def approved(packages: DataFrame) -> DataFrame:
    """Packages whose current state is approved."""
    return current_packages(packages).where(F.col("approval_status") == APPROVED)


def latest_approved(packages: DataFrame) -> DataFrame:
    """Of each group, the approved package with the greatest version."""
    return latest_per_key(approved(packages), ["model_group"], ["version"])


def artifact_version(model_url: Column) -> Column:
    """Version a package's artifact is named after."""
    return F.regexp_extract(basename(model_url), r"^(.*)-model\.tar\.gz$", 1)


def link_versions(versions: DataFrame, packages: DataFrame) -> DataFrame:
    """Dataset versions with the packages made from them.

    A semi join with both inputs shuffled as they are: adaptive execution may then
    split a version with very many packages (which it could not next to an
    aggregate), and broadcasts the listing where its measured size allows.
    """
    linked = packages.withColumn("version", artifact_version(F.col("model_url")))
    return linked.select("version", "model_group", "model_package_arn").join(
        versions.select("version"), "version", "left_semi"
    )
