"""The jobs, each a chain of sources, operators and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from querymill.functions.paths import tail_name
from querymill.operators.classifier import train_classifier
from querymill.operators.columns import select_all, with_load_timestamp
from querymill.operators.evaluation import accuracy, train_test_split
from querymill.operators.limits import preview
from querymill.operators.neighbors import nearest_neighbor
from querymill.operators.registry import approved, new_packages
from querymill.session import materialize
from querymill.sinks.files import dated_path, write_partitioned
from querymill.sinks.registry import append_packages, create_registry, register_groups
from querymill.sinks.versions import save_model_version, write_version
from querymill.sources.files import scan_partitioned
from querymill.sources.registry import read_packages
from querymill.sources.versions import load_latest, load_versions

ARN_RECORD = StructType([StructField("model_package_arn", StringType())])


def query_to_partitions(
    spark: SparkSession,
    query: str,
    root: str,
    partition_cols: Sequence[str] = ("year", "month"),
    *,
    run_date: date | None = None,
    max_records_per_file: int | None = None,
) -> DataFrame:
    """Run a query, store the result by partition under the run date, read it back.

    One set of columns drives the shuffle and the directories. The query's rows
    go straight into the write; they are not stored a first time in between.
    """
    rows = select_all(spark.sql(query))
    path = dated_path(root, run_date=run_date)
    write_partitioned(rows, path, partition_cols, max_records_per_file=max_records_per_file)
    return scan_partitioned(spark, path, rows.schema, partition_cols)


def train_and_register(
    spark: SparkSession,
    training: DataFrame,
    root: str,
    model_url: str,
    group: str,
    *,
    group_description: str = "",
    description: str = "",
    label: str = "species",
    version: str | None = None,
) -> str:
    """Fit, save as a new version, register as a pending package.

    Under ``root``: ``models``, ``registry`` and the ``package`` records. Returns
    the package's identifier. Nothing is registered before the model is saved.
    """
    model = train_classifier(training, label)
    version = save_model_version(model, f"{root}/models", version)
    registry = f"{root}/registry"
    create_registry(spark, registry)
    groups = spark.range(1).select(
        F.lit(group).alias("model_group"), F.lit(group_description).alias("description")
    )
    register_groups(spark, registry, groups)
    package = new_packages(
        spark.range(1).select(
            F.lit(group).alias("model_group"), F.lit(version).alias("version")
        ),
        model_url,
        description,
    )
    append_packages(registry, package)
    record = package.select("model_package_arn")
    write_version(record, f"{root}/package", "json", version)
    return record.first()["model_package_arn"]


def deployments(records: DataFrame, packages: DataFrame, name_base: str) -> DataFrame:
    """Names for the recorded packages that are approved."""
    ready = approved(packages).select("model_package_arn")
    asked = records.select("model_package_arn").distinct()
    return asked.join(ready, "model_package_arn", "left_semi").select(
        F.concat_ws("-", F.lit(name_base), tail_name(F.col("model_package_arn"))).alias(
            "model_name"
        ),
        "model_package_arn",
    )


def deploy_model(spark: SparkSession, root: str, name_base: str) -> DataFrame:
    """Name the latest recorded package for use and record that name.

    A package that is not approved is refused.
    """
    latest = load_latest(spark, f"{root}/package", "json", ARN_RECORD)
    packages = read_packages(spark, f"{root}/registry")
    named = materialize(deployments(latest, packages, name_base), "deployment")
    if named.isEmpty():
        raise ValueError("the latest package is not approved")
    version = write_version(named, f"{root}/deployed", "json")
    return load_versions(spark, f"{root}/deployed", [version], "json", named.schema)


def stamp_and_preview(
    spark: SparkSession, df: DataFrame, root: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """Add the load time, store as a new CSV version, show the first stored rows."""
    stamped = with_load_timestamp(df)
    version = write_version(stamped, root, "csv")
    stored = load_versions(spark, root, [version], "csv", stamped.schema)
    return preview(stored, order_by=order_by)


def neighbor_accuracy(
    df: DataFrame, key: str, label: str, features: Sequence[str]
) -> DataFrame:
    """Split, predict the test part by its nearest training row, report accuracy."""
    train, test = train_test_split(df, key)
    predicted = nearest_neighbor(test, train, key, label, features)
    return accuracy(test.select(key, label).join(predicted, key), label, "predicted")
