from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querymill.operators import registry
from querymill.plans import jobs
from querymill.session import settings_for, shared_folder
from querymill.sinks import registry as sinks
from querymill.sources.registry import read_groups, read_packages
from querymill.sources.versions import load_versions


@pytest.fixture
def models(spark):
    return spark.createDataFrame(
        [("g", "2026-01-01"), ("g", "2026-01-02"), ("h", "2026-01-01")], "model_group string, version string"
    )


@pytest.fixture
def store(spark, root, models):
    sinks.create_registry(spark, root)
    sinks.append_packages(root, registry.new_packages(models, "s3://store/models/", "d"))
    return root


def arns(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "model_package_arn string")


def states(df):
    return {r.model_package_arn: r.approval_status for r in df.collect()}


def test_insert_if_absent_keeps_one_row_per_new_key(spark):
    new = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "x"), ("c", "y")], "k string, d string")
    old = spark.createDataFrame([("b",), ("b",)], "k string")
    got = registry.insert_if_absent(new, old, ["k"])
    assert {tuple(r) for r in got.collect()} == {("a", "1"), ("c", "y")}
    assert registry.insert_if_absent(new.select("k"), old, ["k"]).count() == 2


def test_groups_are_registered_once(spark, root):
    sinks.create_registry(spark, root)
    assert read_groups(spark, root).count() == 0
    new = spark.createDataFrame([("g", "first")], registry.GROUPS)
    sinks.register_groups(spark, root, new)
    sinks.register_groups(spark, root, new.withColumn("description", F.lit("second")))
    sinks.create_registry(spark, root)
    assert [tuple(r) for r in read_groups(spark, root).collect()] == [("g", "first")]


def test_new_packages_are_pending_and_named_after_the_version(spark, store):
    packages = read_packages(spark, store)
    assert packages.schema == registry.PACKAGES
    row = packages.where("model_group = 'h'").first()
    assert row.model_package_arn == "model-package/h/2026-01-01"
    assert row.model_url == "s3://store/models/2026-01-01-model.tar.gz"
    assert row.approval_status == "PendingManualApproval" and row.description == "d"
    assert packages.select(registry.artifact_version(F.col("model_url"))).distinct().count() == 2


def test_approval_appends_and_decides(spark, store):
    chosen = "model-package/g/2026-01-01"
    sinks.approve(spark, store, arns(spark, chosen, chosen))
    packages = read_packages(spark, store)
    assert packages.count() == 4
    assert states(registry.package_status(packages)) == {
        chosen: "Approved",
        "model-package/g/2026-01-02": "PendingManualApproval",
        "model-package/h/2026-01-01": "PendingManualApproval",
    }
    assert set(states(registry.pending(packages))) == {"model-package/g/2026-01-02", "model-package/h/2026-01-01"}
    assert set(states(registry.pending(packages, "h"))) == {"model-package/h/2026-01-01"}
    assert set(states(registry.package_status(packages, "g"))) == {chosen, "model-package/g/2026-01-02"}
    assert [r.version for r in registry.latest_approved(packages).collect()] == ["2026-01-01"]
    sinks.approve(spark, store, arns(spark, chosen))
    assert registry.approved(read_packages(spark, store)).count() == 1


def test_unknown_package_cannot_be_approved(spark, store):
    with pytest.raises(ValueError, match="not registered: nope"):
        sinks.approve(spark, store, arns(spark, "nope"))
    assert read_packages(spark, store).count() == 3


def test_later_row_wins_and_a_tie_goes_to_the_decision(spark):
    rows = [("a", "Approved", 1), ("a", "PendingManualApproval", 2), ("b", "PendingManualApproval", 1), ("b", "Approved", 1)]
    df = spark.createDataFrame(rows, "model_package_arn string, approval_status string, updated_at int")
    assert states(registry.current_packages(df)) == {"a": "PendingManualApproval", "b": "Approved"}


def test_latest_approved_takes_the_greatest_version(spark, store):
    sinks.approve(spark, store, read_packages(spark, store).select("model_package_arn"))
    got = registry.latest_approved(read_packages(spark, store))
    assert {(r.model_group, r.version) for r in got.collect()} == {("g", "2026-01-02"), ("h", "2026-01-01")}


def test_any_column_types_names_and_null_keys_are_inserted_once(spark, root):
    rows = [("k", {"x": 1}), ("k", {"x": 1}), (None, {"y": 2}), (None, None)]
    new = spark.createDataFrame(rows, "`a.b` string, m map<string,int>")
    got = registry.insert_if_absent(new, new.where("false"), ["a.b"])
    assert sorted(repr(r[0]) for r in got.collect()) == ["'k'", "None"]
    assert registry.insert_if_absent(new, got, ["a.b"]).count() == 0
    sinks.create_registry(spark, root)
    groups = spark.createDataFrame([(None, "d"), ("g", "d")], registry.GROUPS)
    for _ in range(2):
        sinks.register_groups(spark, root, groups)
    assert read_groups(spark, root).count() == 2


def test_groups_of_two_writers_read_once(spark, root):
    from querymill.sinks.files import write_parquet
    from querymill.sources.registry import groups_path

    groups = spark.createDataFrame([("g", "b"), ("g", "a")], registry.GROUPS)
    write_parquet(groups, groups_path(root))
    write_parquet(groups, groups_path(root), mode="append")
    assert [tuple(r) for r in read_groups(spark, root).collect()] == [("g", "a")]


def test_latest_of_a_dotted_key(spark):
    from querymill.operators.limits import latest_per_key

    df = spark.createDataFrame([("x", 1), ("x", 2)], "`a.b` string, n int")
    assert latest_per_key(df, ["a.b"], ["n"]).first().n == 2


def test_link_versions(spark, store):
    versions = spark.createDataFrame([("2026-01-01",), ("2026-01-01",), ("2025",)], "version string")
    got = registry.link_versions(versions, read_packages(spark, store))
    assert {(r.version, r.model_group) for r in got.collect()} == {("2026-01-01", "g"), ("2026-01-01", "h")}


def test_train_register_approve_deploy(spark, root):
    rows = [(float(i % 3) + i / 100, float(i), 0.5, 1.0, f"s{i % 3}") for i in range(60)]
    training = spark.createDataFrame(rows, "a double, b double, c double, d double, species string")
    arn = jobs.train_and_register(spark, training, root, "s3://m", "test", version="2026-01-01")
    assert arn == "model-package/test/2026-01-01"
    with pytest.raises(ValueError, match="not approved"):
        jobs.deploy_model(spark, root, "base")
    sinks.approve(spark, f"{root}/registry", arns(spark, arn))
    got = jobs.deploy_model(spark, root, "base").first()
    assert (got.model_name, got.model_package_arn) == ("base-test-2026-01-01", arn)
    second = jobs.train_and_register(spark, training, root, "s3://m", "test", version="2026-01-02")
    assert read_groups(spark, f"{root}/registry").count() == 1
    assert {r.model_package_arn for r in load_versions(spark, f"{root}/package", fmt="json").collect()} == {arn, second}


def test_stamp_and_preview(spark, root):
    df = spark.range(20).withColumn("name", F.lit("x"))
    got = jobs.stamp_and_preview(spark, df, root, ["id"])
    rows = got.collect()
    assert [r.id for r in rows] == [0, 1, 2, 3, 4] and len({r.ts for r in rows}) == 1


def test_query_to_partitions_overwrites_its_day(spark, root):
    from datetime import date

    spark.range(50).select("id", (F.col("id") % 2).alias("k")).createOrReplaceTempView("numbers")
    for n in (50, 10):
        got = jobs.query_to_partitions(
            spark, f"SELECT * FROM numbers WHERE id < {n}", root, ["k"], run_date=date(2026, 1, 1)
        )
    assert got.count() == 10 and got.columns == ["id", "k"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settings_grow_with_the_input():
    small, large = settings_for(10**9, 8), settings_for(10**14, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) * 256 * 1024**2 >= 0.99 * 10**14
    assert int(large["spark.sql.files.maxPartitionBytes"]) > int(small["spark.sql.files.maxPartitionBytes"])


def test_files_read_do_not_grow_with_history(spark, root):
    from datetime import datetime, timedelta

    from querymill.operators.registry import PACKAGES, package_status
    from querymill.sinks.registry import append_packages, compact_packages, create_registry
    from querymill.sources.registry import read_packages, read_recent

    create_registry(spark, root)
    start = datetime(2024, 1, 1)

    def append(n, states, at):
        rows = [("g", str(i), f"p{i}", "u", "", s, at) for i, s in zip(range(n), states, strict=True)]
        append_packages(root, spark.createDataFrame(rows, PACKAGES).coalesce(1))

    def same():
        recent, whole = read_recent(spark, root), read_packages(spark, root)
        assert recent.schema == whole.schema
        found = sorted(map(tuple, package_status(recent).collect()))
        assert found == sorted(map(tuple, package_status(whole).collect()))
        return len(recent.inputFiles())

    same()
    read = []
    for turn in range(3):
        for n in range(4):
            state = ["PendingManualApproval", "Approved", "Rejected"][(turn + n) % 3]
            append(6, [state] * 6, start + timedelta(days=10 * turn + n))
        same()
        assert compact_packages(spark, root) is not None
        assert compact_packages(spark, root) is None
        append(2, ["Approved", "Rejected"], start)  # late: changes nothing
        read.append(same())
    assert len(read_packages(spark, root).inputFiles()) > 14
    assert max(read) == min(read) <= 10
