"""As-of and interval joins against brute force, with hot keys, ties and odd values."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from querymill.operators.asof import asof_join
from querymill.operators.overlaps import overlap_join

NAN, INF = float("nan"), float("inf")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def last_before(lefts, rights, strict):
    out = []
    for k, t, name in lefts:
        best = None
        for rk, rt, rv in rights:
            if None in (k, t, rk, rt) or k != rk or t != t or rt != rt:
                continue
            if (rt < t or (rt == t and not strict)) and (best is None or (rt, rv) > best):
                best = (rt, rv)
        out.append((k, t, name, *(best or (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [7, 60, 10_000])
def test_asof(spark, strict, rows_per_bucket):
    draw = random.Random(4)
    keys = ["hot"] * 6 + ["a", "b", None]
    times = [float(i) for i in range(40)] + [0.5, -3.0, INF, -INF, None, NAN]
    lefts = [(draw.choice(keys), draw.choice(times), i % 90) for i in range(150)]
    lefts += lefts[:20]
    rights = [(draw.choice(keys[:7] + [None]), draw.choice(times), i) for i in range(60)]
    left = spark.createDataFrame(lefts, "k string, t double, name long")
    right = spark.createDataFrame(rights, "k string, at double, v long")
    got = asof_join(
        left, right, ["k"], "t", "at", strict=strict, ties=["v"], rows_per_bucket=rows_per_bucket
    )
    assert got.columns == ["k", "t", "name", "at", "v"]
    assert repr(rows(got)) == repr(last_before(lefts, rights, strict))


def test_asof_edges(spark):
    start = datetime(2024, 3, 31, 0, 30)
    lefts = [(1, start + timedelta(minutes=20 * i)) for i in range(12)]
    left = spark.createDataFrame(lefts, "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, t, str(t)) for _, t in lefts[::3]], "k int, at timestamp_ntz, v string")
    got = asof_join(left, right, ["k"], "t", "at", rows_per_bucket=3).orderBy("t").collect()
    assert [r.at for r in got] == [lefts[i - i % 3][1] for i in range(12)]
    none = asof_join(left, right.limit(0), ["k"], "t", "at", rename="r_{}")
    assert none.columns == ["k", "t", "r_at", "r_v"]
    assert rows(none) == sorted(((1, t, None, None) for _, t in lefts), key=repr)
    assert asof_join(left.limit(0), right, ["k"], "t", "at").count() == 0
    with pytest.raises(ValueError, match="clash"):
        asof_join(left, left, ["k"], "t", "t")


def test_a_hot_key_is_cut_by_time(spark):
    left = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS t")
    right = left.selectExpr("k", "t AS at")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = asof_join(left, right, ["k"], "t", "at", strict=True, rows_per_bucket=2000)
        assert got.where("at IS NOT NULL").count() == 13_333
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "_bucket" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def overlapping(lefts, rights, closed):
    out = []
    for k, s, e, i in lefts:
        for rk, rs, re_, j in rights:
            if None in (k, s, e, rk, rs, re_) or k != rk:
                continue
            if closed and s <= e and rs <= re_ and s <= re_ and rs <= e:
                out.append((k, s, e, i, rs, re_, j))
            if not closed and s < e and rs < re_ and s < re_ and rs < e:
                out.append((k, s, e, i, rs, re_, j))
    return sorted(out, key=repr)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("longest", [0, 3, 5000])
def test_overlaps(spark, closed, longest):
    draw = random.Random(longest)

    def some(n):
        found = []
        for i in range(n):
            start = float(draw.randrange(-50, 400))
            length = draw.choice([0, 1, 2, draw.random() * longest, longest])
            found.append((draw.choice("xxxy"), start, start + min(length, longest), i))
        odd = [(None, 0.0, 1.0), ("x", None, 1.0), ("x", 1.0, None), ("x", NAN, 1.0), ("x", 5.0, 4.0),
               ("x", -INF, INF), ("x", 3.0, INF), ("x", -INF, 2.0)]
        return found + found[:5] + [(*o, n + j) for j, o in enumerate(odd)]

    lefts, rights = some(70), some(50)
    left = spark.createDataFrame(lefts, "k string, s double, e double, i long")
    right = spark.createDataFrame(rights, "k string, rs double, re double, j long")
    got = overlap_join(left, right, ("s", "e"), ("rs", "re"), ["k"], closed=closed)
    assert got.columns == ["k", "s", "e", "i", "rs", "re", "j"]
    assert rows(got) == overlapping(lefts, rights, closed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlaps_of_times_and_edges(spark):
    day = datetime(2024, 1, 1)
    lefts = [(day + timedelta(days=i), day + timedelta(days=i, hours=30 * (i % 4)), i) for i in range(60)]
    left = spark.createDataFrame(lefts, "s timestamp_ntz, e timestamp_ntz, kind int")
    right = left.toDF("bin", "at", "row")
    got = overlap_join(left, right, ("s", "e"), ("bin", "at"))
    want = [(i, j) for a, b, i in lefts for c, d, j in lefts if a <= d and c <= b]
    assert rows(got.select("kind", "row")) == sorted(want, key=repr)
    assert overlap_join(left.limit(0), right, ("s", "e"), ("bin", "at")).count() == 0
    assert overlap_join(left.limit(0), right.limit(0), ("s", "e"), ("bin", "at")).columns == [
        "s", "e", "kind", "bin", "at", "row"]
    with pytest.raises(ValueError, match="clash"):
        overlap_join(left, left, ("s", "e"), ("s", "e"))


def test_a_long_interval_costs_few_entries(spark):
    """One interval over everything and many short ones: compared pairs stay near the result."""
    short = spark.range(20_000).selectExpr("id AS s", "id AS e", "id AS i")
    long = spark.createDataFrame([(0, 20_000, 0)], "rs long, re long, j long")
    both = long.unionByName(spark.range(1, 20_000).selectExpr("id * 1 AS rs", "id AS re", "id AS j"))
    got = overlap_join(short, both, ("s", "e"), ("rs", "re"))
    assert got.count() == 20_000 + 19_999
