from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from querymill.operators.columns import with_date_parts
from querymill.sinks.files import create_table_as, write_parquet, write_partitioned, write_predictions
from querymill.sinks.versions import new_version, write_version
from querymill.sources.files import scan_csv, scan_declared, scan_json, scan_parquet, scan_prefix
from querymill.sources.query import query_dataset
from querymill.sources.tables import TRANSACTIONS, external_table, external_view
from querymill.sources.versions import (
    committed_versions,
    latest_version,
    load_latest,
    load_versions,
    version_from_path,
    version_path,
)

TEXTS = ["", None, " a ", 'q"u', "a\nb", "a\r\nb", "a\rb", "\\", ",", "#x", "null", '""', "\t", "\\N", "é😀\u2028x", '\\"', "\n\0a", '"\0', "\r\n\0", "\0"]


@pytest.fixture(scope="module")
def awkward(spark):
    at = datetime(2024, 1, 1, 1, 2, 3, 123456)
    rows = [(i, t, at, x) for i, (t, x) in enumerate(zip(TEXTS, [0.1, 1e300, float("nan"), float("inf")] * 5, strict=True))]
    df = spark.createDataFrame(rows, "i int, s string, t timestamp, x double")
    return df.withColumn("n", F.col("t").cast("timestamp_ntz"))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_versions_keep_every_value(spark, awkward, root, fmt):
    version = write_version(awkward, root, fmt)
    got = load_latest(spark, root, fmt, awkward.schema)
    assert {r.version for r in got.collect()} == {version}
    rows = got.drop("version").orderBy("i").collect()
    assert repr(rows) == repr(awkward.orderBy("i").collect())


ANY_TEXT = st.none() | st.text(
    st.characters(exclude_categories=["Cs"]) | st.sampled_from('",\n\r\t \\#\x00'), max_size=12
)


@pytest.mark.parametrize("fmt", ["csv", "json"])
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(ANY_TEXT, min_size=1, max_size=200))
def test_any_text_comes_back(spark, fmt, texts):
    from querymill.session import fresh_path

    root = fresh_path(spark, "any")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    write_version(df, root, fmt)
    got = load_latest(spark, root, fmt, df.schema).orderBy("i").collect()
    assert [r.s for r in got] == texts


MARKERS = [None, "", "\\N", "\\\\N", "\\", "a", " ", "\n", "\0querymill null\0"]


def test_one_column_csv_keeps_markers_nulls_and_empty_texts(spark, root):
    df = spark.createDataFrame([(t,) for t in MARKERS], "s string")
    write_version(df, root, "csv")
    got = [r.s for r in load_latest(spark, root, "csv", df.schema).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, MARKERS))
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    write_version(numbers, f"{root}/n", "csv")
    read = load_latest(spark, f"{root}/n", "csv", numbers.schema).collect()
    assert {r.n for r in read} == {1, None}


EDGES = [None, "", " ", "a/b", "%", "\\", "\\\\", "=", "é"]


@pytest.mark.parametrize("table", [None, "edge_table"])
def test_partition_texts_keep_their_value(spark, root, table):
    df = spark.createDataFrame(list(enumerate(EDGES)), "i int, k string")
    df.createOrReplaceTempView("edges")
    got = query_dataset(spark, "SELECT * FROM edges", ["k"], as_table=table, location=root)
    assert [r.k for r in got.orderBy("i").collect()] == EDGES
    assert [r.i for r in got.where("k = ''").collect()] == [1]
    if table:
        spark.sql(f"DROP TABLE {table}")


def test_table_without_location_outlives_scratch(spark):
    from querymill.session import release_scratch

    df = spark.range(5).withColumn("k", F.lit("x"))
    df.createOrReplaceTempView("five")
    query_dataset(spark, "SELECT * FROM five", ["k"], as_table="five_by_k")
    release_scratch(spark)
    assert spark.table("five_by_k").count() == 5
    spark.sql("DROP TABLE five_by_k")


def test_versions_keep_their_own_columns(spark, root):
    write_version(spark.createDataFrame([(1, "x")], "id int, extra string"), root, version="1")
    write_version(spark.createDataFrame([(2,)], "id int"), root, version="2")
    got = load_versions(spark, root)
    assert {(r.id, r.extra, r.version) for r in got.collect()} == {(1, "x", "1"), (2, None, "2")}
    write_version(spark.createDataFrame([("y",)], "id string"), root, version="3")
    with pytest.raises(ValueError, match="type of id"):
        load_versions(spark, root)


def test_declared_csv_of_our_own(spark, root):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "\\N")], "i int, s string")
    write_version(df, root, "csv")
    got = scan_declared(spark, root, "text/csv", df.schema, own_csv=True).orderBy("i")
    assert [r.s for r in got.collect()] == ["", None, "\\N"]


def test_csv_scan_infers_or_checks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,name\n1,2.5,"two\nlines"\n2,,\n')
    got = scan_csv(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "double", "string"]
    assert got.orderBy("x").collect()[0].name == "two\nlines"
    assert got.orderBy("x").collect()[1].y is None
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), schema="y double, x int, name string").collect()
    (tmp_path / "a.csv").write_text("x,y,name\nnot a number,2.5,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(tmp_path), schema="x int, y double, name string").collect()


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "".join(f"{i},{i}\n" for i in range(50_000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        for flat in (
            scan_csv(spark, str(tmp_path), schema="x int, y int", multiline=False),
            scan_declared(spark, str(tmp_path), "csv", "x int, y int", multiline=False),
        ):
            assert flat.count() == 50_000
            assert flat.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set(key, before)


def test_malformed_json_stops(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_json(spark, str(tmp_path), schema="x int").collect()


def test_declared_formats(spark, root):
    df = spark.range(5).select("id", F.lit("a").alias("species"))
    write_parquet(df, f"{root}/p/x")
    write_version(df, f"{root}/c", "csv")
    for name, path in [("parquet", "p"), ("application/x-parquet", "p"), ("csv", "c"), ("text/csv", "c")]:
        assert scan_declared(spark, f"{root}/{path}", name, df.schema).count() == 5
    for name in ["application/json", "orc", ""]:
        with pytest.raises(ValueError):
            scan_declared(spark, "/nowhere", name)


def test_prefix_scan_reads_all_depths_and_adds_no_columns(spark, root):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    write_partitioned(df, f"{root}/a/b", ["k"])
    write_parquet(df.drop("k"), f"{root}/c")
    got = scan_prefix(spark, root, schema=df.drop("k").schema)
    assert got.columns == ["id"] and got.count() == 20


def test_predictions_only_as_parquet(spark, root):
    df = spark.range(3).select(F.lit("a").alias("predicted_score"))
    write_predictions(df, root)
    assert scan_parquet(spark, root).count() == 3
    for accept in ["text/csv", "application/json"]:
        with pytest.raises(ValueError):
            write_predictions(df, root + "x", accept)
    assert not Path(root + "x").exists()


def test_versions_are_never_rewritten(spark, root):
    df = spark.range(3)
    write_version(df, root, version="v1")
    with pytest.raises(Exception, match="(?i)already exists"):
        write_version(df, root, version="v1")
    for bad in ["a/b", "", "..", "x:y"]:
        with pytest.raises(ValueError):
            write_version(df, root, version=bad)


def test_latest_is_the_last_finished_version(spark, root):
    with pytest.raises(ValueError):
        latest_version(spark, root)
    for version, n in [("2026-01-01T00.00.00.000Z", 1), ("2026-01-10T00.00.00.000Z", 2)]:
        write_version(spark.range(n), root, version=version)
    half = Path(version_path(root, "2026-02-01T00.00.00.000Z"))
    half.mkdir()
    assert latest_version(spark, root) == "2026-01-10T00.00.00.000Z"
    assert load_latest(spark, root).count() == 2
    both = load_versions(spark, root)
    assert {(r.version[:10], r["count"]) for r in both.groupBy("version").count().collect()} == {
        ("2026-01-01", 1),
        ("2026-01-10", 2),
    }
    assert len(committed_versions(spark, root)) == 2


def test_number_like_versions_stay_text_and_prune(spark, root):
    for v in ["1", "2"]:
        write_version(spark.range(3), root, version=v)
    got = load_versions(spark, root).where("version = '2'")
    assert got.schema["version"].dataType.simpleString() == "string"
    assert "PartitionFilters: [isnotnull(version" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 3


def test_new_version_sorts_by_time():
    at = [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 5000), datetime(2024, 10, 1)]
    names = [new_version(t) for t in at]
    assert names == sorted(names) and names[1] == "2024-01-01T00.00.00.005Z"
    assert ":" not in new_version()


def test_version_from_path(spark):
    df = spark.range(1).select(version_from_path(F.lit("file:/r/2024-01-01/part-0.csv")).alias("v"))
    assert df.first().v == "2024-01-01"


# ---------------------------------------------------------------- query datasets and tables


@pytest.fixture
def sales(spark):
    rows = [(1, "2024-01-31"), (2, "2024-02-29"), (3, "2023-12-31"), (4, None)]
    spark.createDataFrame(rows, "id int, date string").createOrReplaceTempView("sales")


QUERY = """SELECT *, year(cast(date AS timestamp)) AS year, month(cast(date AS timestamp)) AS month
           FROM sales LIMIT 5000"""


@pytest.mark.parametrize("table", [None, "sales_by_month"])
def test_query_dataset(spark, sales, table):
    got = query_dataset(spark, QUERY, ["year", "month"], as_table=table)
    assert got.columns == ["id", "date", "year", "month"]
    assert {(r.id, r.year, r.month) for r in got.collect()} == {
        (1, 2024, 1),
        (2, 2024, 2),
        (3, 2023, 12),
        (4, None, None),
    }
    pruned = got.where("year = 2023")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    if table:
        with pytest.raises(Exception, match="(?i)already exists"):
            create_table_as(got, table, ["year"])
        spark.sql(f"DROP TABLE {table}")


def test_query_dataset_errors(spark, sales):
    with pytest.raises(ValueError, match="no column day"):
        query_dataset(spark, QUERY, ["day"])
    with pytest.raises(Exception, match="(?i)not_found|cannot be found"):
        query_dataset(spark, "SELECT 1 AS k FROM nowhere", ["k"])


def test_date_parts_agree_with_the_query(spark, sales):
    by_query = spark.sql(QUERY)
    assert with_date_parts(spark.table("sales"), "date").exceptAll(by_query).isEmpty()


def test_external_table_keeps_comments_and_files(spark, root):
    empty = spark.createDataFrame([], TRANSACTIONS)
    write_parquet(empty, root)
    got = external_table(spark, "transactions", root, TRANSACTIONS)
    assert [f.name for f in got.schema] == TRANSACTIONS.names
    assert len(TRANSACTIONS) == 21
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE transactions").collect()}
    assert comments["nonce"] == "earlier transactions of the sender"
    spark.sql("DROP TABLE transactions")
    assert Path(root).exists()
    assert external_view(spark, "tx", root, TRANSACTIONS).count() == 0
    assert spark.table("tx").columns == TRANSACTIONS.names


def test_scan_reads_only_what_is_asked(spark):
    df = scan_parquet(spark, "/root/testdata/sf0.001/lineitem.parquet")
    plan = (
        df.where("l_quantity > 40").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    )
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
