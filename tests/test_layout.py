from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from querymill.operators.layout import distribute, repartition_by
from querymill.sinks.files import dated_path, unload, write_parquet, write_partitioned
from querymill.sources.files import scan_parquet


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def parts(path, pattern="**/*.parquet"):
    return sorted(Path(path).glob(pattern))


def test_decorator_keeps_the_function_and_shuffles(spark):
    @repartition_by(["k"])
    def load(n, *, step=1):
        """Numbers."""
        return spark.range(0, n, step).withColumn("k", F.col("id") % 3)

    assert load.__name__ == "load" and load.__doc__ == "Numbers."
    assert load(10, step=2).count() == 5
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(load(10))
    assert "hashpartitioning(k" in plan(load(10))


def test_together_puts_a_key_in_one_task(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 5)
    got = df.transform(distribute, ["k"], "together")
    assert "REPARTITION_BY_COL" in plan(got)
    got = got.withColumn("task", F.spark_partition_id())
    tasks = got.groupBy("k").agg(F.countDistinct("task").alias("n"))
    assert {r.n for r in tasks.collect()} == {1}


@pytest.mark.parametrize("bad", [[], "year", ()])
def test_columns_are_checked(bad):
    with pytest.raises(ValueError):
        repartition_by(bad)


def test_unknown_choice_is_refused(spark):
    with pytest.raises(ValueError):
        distribute(spark.range(1), ["id"], "sometimes")


def test_hot_partition_is_written_by_several_tasks(spark, root):
    """A third of the rows share one key; they do not end up in one task."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    df = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1000000")
    try:
        write_partitioned(df, root, ["k"])
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert len(parts(f"{root}/k=0")) > 2
    assert len(parts(f"{root}/k=7")) == 1
    back = scan_parquet(spark, root, schema=df.schema)
    assert back.count() == 300_000 and back.exceptAll(df.select(back.columns)).isEmpty()


def test_one_file_per_small_partition(spark, root):
    df = spark.range(0, 10_000, 1, 8).withColumn("k", F.col("id") % 20)
    write_parquet(df, root + "_plain", ["k"])
    write_partitioned(df, root, ["k"])
    assert len(parts(root)) == 20 < len(parts(root + "_plain")) == 160


def test_rows_per_file_are_bounded(spark, root):
    df = spark.range(0, 5500, 1, 2).withColumn("k", F.lit(1))
    write_partitioned(df, root, ["k"], max_records_per_file=1000)
    sizes = [spark.read.parquet(str(p)).count() for p in parts(root)]
    assert max(sizes) <= 1000 and sum(sizes) == 5500


def test_static_and_dynamic_overwrite(spark, root):
    df = spark.range(6).withColumn("k", F.col("id") % 3)
    one = df.where("k = 1").withColumn("id", F.col("id") + 100)
    write_partitioned(df, root, ["k"])
    write_partitioned(one, root, ["k"], dynamic=True)
    got = {tuple(r) for r in scan_parquet(spark, root, schema=df.schema).select("id", "k").collect()}
    assert got == {(0, 0), (3, 0), (2, 2), (5, 2), (101, 1), (104, 1)}
    write_partitioned(one, root, ["k"])
    assert scan_parquet(spark, root, schema=df.schema).count() == 2


def test_null_partition_value_and_types_come_back(spark, root):
    df = spark.createDataFrame([(1, "007", None), (2, None, None)], "id int, code string, y int")
    write_partitioned(df, root, ["code", "y"])
    got = scan_parquet(spark, root, schema=df.schema)
    assert {tuple(r) for r in got.select("id", "code", "y").collect()} == {(1, "007", None), (2, None, None)}


def test_empty_result_reads_as_no_rows(spark):
    df = spark.range(3).withColumn("k", F.lit(1)).where("id > 5")
    got = scan_parquet(spark, unload(df, ["k"]), schema=df.schema)
    assert got.count() == 0 and got.columns == ["id", "k"]


def test_unload_goes_to_a_new_place_each_time(spark):
    df = spark.range(3).withColumn("k", F.lit(1))
    assert unload(df, ["k"]) != unload(df, ["k"])


def test_dated_path():
    from datetime import date, datetime, timedelta
    from zoneinfo import ZoneInfo

    assert dated_path("s3a://b/", run_date=date(2024, 2, 29)) == "s3a://b/2024-02-29/parsed"
    yesterday = datetime.now(ZoneInfo("Asia/Singapore")).date() - timedelta(days=1)
    assert dated_path("r", "x") == f"r/{yesterday.isoformat()}/x"
