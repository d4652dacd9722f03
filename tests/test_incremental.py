"""What grows: the latest rows kept up to date, scores of arriving files, laid-out tables."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from querymill.operators.classifier import train_classifier
from querymill.operators.layout import interleaved
from querymill.operators.limits import latest_per_key
from querymill.sinks.latest import merge_latest, read_latest
from querymill.sinks.versions import write_version
from querymill.streaming.scoring import read_scores, score_arrivals


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_of(path: str) -> dict[str, set[str]]:
    return {
        d.name: {f.name for f in d.glob("*.parquet")} for d in Path(path).iterdir() if d.is_dir()
    }


def test_latest_kept_up_to_date(spark, root):
    draw = random.Random(3)
    keys = ["hot"] * 30 + [f"k{i}" for i in range(40)] + [None]
    batches = [
        [(draw.choice(keys), draw.randrange(1000), i + 100 * b, None if i % 9 else "x") for i in range(60)]
        for b in range(3)
    ]
    schema = "k string, at long, id long, `b.c` string"
    frames = [spark.createDataFrame(b, schema) for b in batches]
    for n, frame in enumerate([*frames, frames[1]]):  # one of them twice
        merge_latest(root, frame, ["k"], ["at", "id"], n_buckets=16)
        seen = spark.createDataFrame(sum(batches[: n + 1], []), schema)
        assert rows(read_latest(spark, root, frame.schema)) == rows(latest_per_key(seen, ["k"], ["at", "id"]))
    before = files_of(root)
    one = spark.createDataFrame([("k1", 5000, 1, "new")], schema)
    assert merge_latest(root, one, ["k"], ["at", "id"], n_buckets=16) == 1
    after = files_of(root)
    assert sum(before[d] != after[d] for d in before) == 1
    assert ("k1", 5000, 1, "new") in rows(read_latest(spark, root, one.schema))
    assert merge_latest(root, one.limit(0), ["k"], ["at", "id"], n_buckets=16) == 0
    assert files_of(root) == after


def test_latest_of_nothing(spark, root):
    empty = spark.createDataFrame([], "k string, at long")
    assert merge_latest(root, empty, ["k"], ["at"]) == 0
    assert read_latest(spark, root, empty.schema).count() == 0
    with pytest.raises(ValueError):
        merge_latest(root, empty, ["k"], ["at"], n_buckets=0)


def test_arriving_files_are_scored_once(spark, root):
    draw = random.Random(1)
    schema = "a double, b double, id long, t string, species string"
    made = [(float(i % 2), draw.random(), i, 'two\nlines, "quoted"', "xy"[i % 2]) for i in range(200)]
    data = spark.createDataFrame(made, schema)
    model = train_classifier(data.select("a", "b", "species"), n_features=2)
    for fmt, declared in (("parquet", "application/x-parquet"), ("csv", "text/csv")):
        source, target, state = (f"{root}/{fmt}/{n}" for n in ("in", "out", "state"))

        def call(source=source, target=target, state=state, declared=declared, fmt=fmt):
            return score_arrivals(
                spark, model, source, target, state, data.schema, declared=declared,
                key_cols=["id"], own_csv=fmt == "csv", files_per_batch=2,
            )

        for n, low in enumerate((0, 80, 150)):
            high = (80, 150, 200)[n]
            write_version(data.where(F.col("id").between(low, high - 1)).coalesce(3), source, fmt, f"v{n}")
            assert call() >= 1
            scores = read_scores(spark, target, spark.createDataFrame([], "id long, predicted_score string").schema)
            assert rows(scores.select("id", "predicted_score")) == sorted(
                [(i, "xy"[i % 2]) for i in range(high)], key=repr
            )
        assert call() == 0
    with pytest.raises(ValueError, match="expected"):
        score_arrivals(spark, model, root, root, root, data.schema, declared="json")


def test_filters_on_either_column_skip_most_files(spark, root):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid = interleaved(lines, ["l_shipdate", "l_partkey"])
        laid.write.parquet(root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stored = spark.read.parquet(root)
    assert stored.columns == lines.columns
    assert stored.exceptAll(lines).count() == 0 and stored.count() == lines.count()
    spans = {"l_shipdate": [], "l_partkey": []}
    for file in Path(root).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                if column.path_in_schema in spans:
                    spans[column.path_in_schema].append((column.statistics.min, column.statistics.max))
    for name, share in (("l_shipdate", 0.05), ("l_partkey", 0.05)):
        order = lines.select(name).orderBy(name).collect()
        low, high = (order[int(p * (len(order) - 1))][0] for p in (0.5, 0.5 + share))
        met = sum(a <= high and b >= low for a, b in spans[name])
        assert met <= 0.35 * len(spans[name]), (name, met, len(spans[name]))


def test_layout_of_odd_values(spark):
    odd = [(None, 1), (float("nan"), 2), (float("inf"), 3), (-1.0, 4), (0.0, None)] * 40 + [(5.0, 5)] * 100
    df = spark.createDataFrame(odd, "f double, _rank int")
    assert repr(rows(interleaved(df, ["f", "_rank"], bits=3))) == repr(rows(df))
    assert interleaved(df.limit(0), ["f"]).count() == 0
    with pytest.raises(ValueError):
        interleaved(df, ["f", "_rank"], bits=40)
