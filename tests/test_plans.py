"""Plans: no pairwise joins, no Python where Spark's own operators do, pruned scans."""

from __future__ import annotations

import pytest

from querymill.plans import queries
from querymill.plans.queries import QUERIES
from querymill.plans.sql_datasets import SQL_DATASETS

SF_DIR = "/root/testdata/sf0.001"
# Operators whose work Spark has no expression for. CSV files are read in Python, too, where
# they are larger than a range, which none is here.
IN_PYTHON = {
    "nearest_neighbor",
    "nearest_neighbor_leaves",
    "nearest_neighbor_whole",
    "hashed_neighbor_recall",
    "accuracy",
    "accuracy_whole",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, monkeypatch, name):
    # A query that stores its result would show a scan of it and nothing else.
    monkeypatch.setattr(queries, "materialize", lambda df, *_: df)
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for pairwise in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pairwise not in plan
    assert ("Python" in plan or "InPandas" in plan) == (name in IN_PYTHON)


@pytest.mark.parametrize("name", sorted(SQL_DATASETS))
def test_plan_of_the_query_itself(spark, name):
    dataset = SQL_DATASETS[name]
    for table in dataset.tables:
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").createOrReplaceTempView(table)
    plan = spark.sql(dataset.query)._jdf.queryExecution().executedPlan().toString()
    for pairwise in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pairwise not in plan


def executed(spark, name: str) -> str:
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_narrow_queries_do_not_shuffle(spark):
    for name in ("date_parts", "hash_split", "path_parts", "zone_dates", "first_columns", "prefix_scan"):
        assert "Exchange" not in executed(spark, name), name


def test_partition_filter_reaches_the_scan(spark):
    plan = executed(spark, "pruned_partition")
    assert "(year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_only_needed_columns_are_read(spark):
    plan = executed(spark, "hash_split")
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    plan = executed(spark, "insert_if_absent")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_top_rows_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in executed(spark, "date_parts_limit")


def test_a_hot_version_is_split_in_the_link(spark):
    """A third of all packages were made from one version: several tasks join them."""
    from pyspark.sql import functions as F

    from querymill.operators.registry import link_versions

    hot = F.when(F.col("id") % 3 == 0, F.lit("v0")).otherwise(F.concat(F.lit("v"), F.col("id") % 500))
    packages = spark.range(0, 300_000, 1, 8).select(
        F.concat(F.lit("s3://m/"), hot, F.lit("-model.tar.gz")).alias("model_url"),
        F.lit("g").alias("model_group"),
        F.sha2(F.col("id").cast("string"), 256).alias("model_package_arn"),
    )
    versions = spark.range(500).select(F.concat(F.lit("v"), "id").alias("version"))
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000000",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        linked = link_versions(versions, packages)
        assert len(linked.collect()) == 300_000
        assert "skew=true" in linked._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
