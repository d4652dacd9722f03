from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querymill.operators import columns, limits


@pytest.fixture(scope="module")
def flowers(spark):
    return spark.createDataFrame(
        [(5.1, 3.5, 1.4, 0.2, "setosa"), (7.0, 3.2, 4.7, 1.4, "versicolor")],
        "sepal_length double, sepal_width double, petal_length double, "
        "petal_width double, species string",
    )


def test_select_all_adds_no_step(flowers):
    assert columns.select_all(flowers).collect() == flowers.collect()


def test_first_columns_also_with_dots(spark, flowers):
    assert columns.first_columns(flowers).columns == flowers.columns[:4]
    dotted = spark.range(2).select(F.col("id").alias("a.b"), F.col("id").alias("c"))
    assert columns.first_columns(dotted, 1).columns == ["a.b"]


def test_drop_label_present_or_not(flowers):
    bare = columns.drop_label(flowers)
    assert bare.columns == flowers.columns[:4]
    assert columns.drop_label(bare).columns == flowers.columns[:4]


def test_prediction_only_with_and_without_keys(flowers):
    scored = flowers.withColumn("p", F.upper("species"))
    assert columns.prediction_only(scored, source="p").columns == ["predicted_score"]
    keyed = columns.prediction_only(scored, ["species"], "p")
    assert {tuple(r) for r in keyed.collect()} == {
        ("setosa", "SETOSA"),
        ("versicolor", "VERSICOLOR"),
    }


def test_load_timestamp_leaves_input_alone(flowers):
    stamped = columns.with_load_timestamp(flowers)
    assert stamped.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert stamped.select("ts").distinct().count() == 1
    assert "ts" not in flowers.columns


def test_limit(spark):
    df = spark.range(100).repartition(7)
    assert limits.limit_rows(df, 10).count() == 10
    assert limits.limit_rows(df, 1000).count() == 100
    assert limits.limit_rows(df, 0).count() == 0
    top = limits.limit_rows(df, 3, [F.desc("id")])
    assert [r.id for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert limits.preview(df).count() == 5
    with pytest.raises(ValueError):
        limits.limit_rows(df, -1)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", "v1", 1), ("a", "v10", 2), ("a", "v2", 3), ("b", "v1", 4), ("b", "v1", 5), (None, "v3", 6)],
        "k string, version string, n int",
    )
    got = limits.latest_per_key(df, ["k"], ["version", "n"])
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {("a", "v2", 3), ("b", "v1", 5), (None, "v3", 6)}


def test_latest_per_key_shuffles_one_row_per_key_and_task(spark):
    """A key with most of the rows reaches the shuffle already reduced."""
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id"
    )
    got = limits.latest_per_key(df, ["k"], ["id"])
    assert got.where("k = -1").first().id == 99_998
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


# ---------------------------------------------------------------- many rows in order


def _mixed(spark, n=3000):
    import random
    from datetime import datetime, timedelta
    from decimal import Decimal

    draw = random.Random(9)
    day = datetime(2024, 1, 1)
    floats = [None, float("nan"), float("inf"), -0.0, 0.0, 1.5, -2.25]
    rows = [
        (
            draw.choice(floats + [draw.random()]),
            draw.choice([None, "", "a", "b", "é"]),
            day + timedelta(seconds=draw.randrange(50)),
            Decimal(draw.randrange(5)) / 4,
            i % (n // 2),
        )
        for i in range(n)
    ]
    schema = "f double, s string, t timestamp_ntz, d decimal(6,2), i long"
    return spark.createDataFrame(rows + rows[:200], schema)


@pytest.mark.parametrize("order,down", [
    (["f", "i"], False),
    (["s", "t", "f"], [True, False, True]),
    (["d"], True),
    (["t", "s"], False),
])
@pytest.mark.parametrize("n", [1, 1601])
def test_first_rows(spark, monkeypatch, order, down, n):
    from querymill.operators import limits

    monkeypatch.setattr(limits, "FEW", 50)
    df = _mixed(spark)
    df.cache()
    got = limits.first_rows(df, n, order, down)
    downs = [down] * len(order) if isinstance(down, bool) else down
    sort = [F.desc(c) if x else F.asc(c) for c, x in zip(order, downs, strict=True)]
    want = df.orderBy(*sort).limit(n)

    def texts(frame):
        return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in frame.select(*order).collect())

    assert texts(got) == texts(want)
    # What is taken is part of the table, each row as often as it occurs at most.
    assert got.exceptAll(df).count() == 0
    df.unpersist()


def test_first_rows_edges(spark):
    from querymill.operators.limits import first_rows

    df = spark.range(100).selectExpr("id % 2 AS a", "'x' AS `b.c`")
    assert first_rows(df, 0, ["a"]).count() == 0
    assert first_rows(df, 1000, ["a"]).count() == 100
    assert [r.a for r in first_rows(df, 7, ["a"]).collect()] == [0] * 7
    assert first_rows(df, 7, ["b.c"]).count() == 7
    assert first_rows(df.limit(0), 7, ["a"]).count() == 0
    with pytest.raises(ValueError):
        first_rows(df, -1, ["a"])
    with pytest.raises(TypeError):
        first_rows(df.selectExpr("array(a) AS a"), 1, ["a"])


def test_half_of_a_table_needs_no_shuffle(spark):
    from querymill.operators.limits import first_rows

    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    got = first_rows(lines, 30_000, ["l_shipdate", "l_orderkey", "l_linenumber"])
    assert got.count() == 30_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan
    assert "LessThanOrEqual(l_shipdate" in plan
