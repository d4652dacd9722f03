from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from querymill.operators import neighbors
from querymill.operators.blocks import BlockSearch
from querymill.operators import hashed_neighbors
from querymill.operators.evaluation import in_train
from querymill.operators.neighbors import nearest_neighbor
from querymill.plans.jobs import neighbor_accuracy
from querymill.plans.queries import QUERIES


def brute_force(test, train, features):
    train = train.sort_values("id", ignore_index=True)
    near = []
    for row in test[features].to_numpy():
        square = np.zeros(len(train))
        for d, x in enumerate(features):
            square += (row[d] - train[x].to_numpy()) ** 2
        near.append((int(train["id"][square.argmin()]), float(np.sqrt(square.min()))))
    return dict(zip(test["id"], near, strict=True))


def check(spark, test, train, features, **options):
    found = nearest_neighbor(
        spark.createDataFrame(test), spark.createDataFrame(train), "id", "label", features, **options
    ).collect()
    want = brute_force(test, train, features)
    assert len(found) == len(test)
    labels = dict(zip(train["id"], train["label"], strict=True))
    assert {r.id: (r.nearest_key, r.distance) for r in found} == want
    assert all(r.predicted == labels[r.nearest_key] for r in found)


def table(rng, n, dims, start, draw):
    df = pd.DataFrame({f"x{d}": draw(rng, n) for d in range(dims)})
    return df.assign(id=np.arange(start, start + n), label=[f"l{i % 7}" for i in range(n)])


DRAWS = {
    "spread": lambda rng, n: rng.normal(size=n),
    # many ties and equal points
    "grid": lambda rng, n: rng.integers(0, 4, size=n).astype(float),
    # a third of the rows in one spot, the rest far apart
    "hot": lambda rng, n: np.where(np.arange(n) % 3 == 0, 1.0, rng.uniform(-100, 100, size=n)),
    "constant": lambda rng, n: np.zeros(n),
}


@pytest.mark.parametrize("draw", sorted(DRAWS))
@pytest.mark.parametrize("options", [{}, {"leaf_rows": 8, "chunk_rows": 16}, {"leaf_rows": 8, "chunk_rows": 16, "max_leaves": 4}])
def test_equals_brute_force(spark, draw, options):
    rng = np.random.default_rng(5)
    train = table(rng, 400, 3, 0, DRAWS[draw])
    test = table(rng, 150, 3, 1000, DRAWS[draw])
    check(spark, test, train, ["x0", "x1", "x2"], **options)


def test_a_poor_sample_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "SAMPLE_ROWS", 20)
    rng = np.random.default_rng(6)
    train = table(rng, 500, 2, 0, DRAWS["spread"])
    test = table(rng, 100, 2, 1000, lambda r, n: r.normal(3.0, 2.0, size=n))
    check(spark, test, train, ["x0", "x1"], leaf_rows=10, chunk_rows=7)


def test_copies_do_not_grow_a_group(spark):
    """Equal training points shrink to one before any distance is taken."""
    train = pd.DataFrame({"x0": [1.0] * 3000 + [5.0], "id": range(3001), "label": ["a"] * 3000 + ["b"]})
    test = pd.DataFrame({"x0": [1.1] * 2000 + [4.9], "id": range(5000, 7001), "label": ["?"] * 2001})
    check(spark, test, train, ["x0"], leaf_rows=1, chunk_rows=50)


def test_text_keys_and_labels(spark):
    train = spark.createDataFrame([("b", "x", 1.0), ("a", "y", 1.0), ("c", "z", 9.0)], "k string, l string, v double")
    test = spark.createDataFrame([("t1", 2.0), ("t2", 8.0)], "k string, v double")
    got = {r.k: (r.nearest_key, r.predicted, r.distance) for r in nearest_neighbor(test, train, "k", "l", ["v"]).collect()}
    assert got == {"t1": ("a", "y", 1.0), "t2": ("c", "z", 1.0)}


def test_errors(spark):
    train = spark.createDataFrame([(1, "x", 1.0)], "k int, l string, v double")
    with pytest.raises(ValueError, match="no training rows"):
        nearest_neighbor(train, train.where("k > 1"), "k", "l", ["v"])
    gap = train.withColumn("v", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="missing value"):
        nearest_neighbor(gap, train, "k", "l", ["v"]).collect()


def test_no_pairs_reach_a_join(spark):
    points = spark.range(300).select("id", F.col("id").cast("string").alias("l"), F.rand(1).alias("v"))
    got = nearest_neighbor(points, points, "id", "l", ["v"], leaf_rows=16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert got.where("id <> nearest_key").isEmpty()


def test_empty_test_part(spark):
    train = spark.createDataFrame([(1, "x", 1.0)], "k int, l string, v double")
    got = nearest_neighbor(train.where("k > 1"), train, "k", "l", ["v"])
    assert got.count() == 0


def test_accuracy_of_separated_classes(spark):
    df = spark.range(400).select("id", (F.col("id") % 2).alias("l"), ((F.col("id") % 2) * 10 + F.rand(3)).alias("v"))
    assert neighbor_accuracy(df, "id", "l", ["v"]).first().accuracy == 1.0


@pytest.mark.parametrize("draw", sorted(DRAWS))
@pytest.mark.parametrize("options", [{}, {"leaf_rows": 64, "chunk_rows": 50}])
def test_many_features_equal_brute_force(spark, draw, options):
    rng = np.random.default_rng(8)
    train = table(rng, 300, 20, 0, DRAWS[draw])
    test = table(rng, 80, 20, 1000, DRAWS[draw])
    check(spark, test, train, [f"x{d}" for d in range(20)], **options)


@pytest.mark.parametrize("scale", [1e-170, 1.0, 1e12, 1e160])
def test_product_changes_nothing(scale):
    rng = np.random.default_rng(9)
    targets = rng.integers(-2, 3, size=(200, 20)) * scale
    rows = np.concatenate([targets[:30], targets[:30] + scale * 1e-9, rng.normal(size=(30, 20)) * scale])
    with np.errstate(over="ignore"):
        want = neighbors._by_sums(rows, targets)
    got = neighbors._by_product(rows, targets)
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_whole_embeddings_are_compared(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id")
    rows = rows.select("vec_id", "embedding", in_train("vec_id").alias("train")).toPandas()
    x = np.stack(rows["embedding"].to_list()).astype(float)
    train = rows["train"].to_numpy()
    square = ((x[~train, None] - x[None, train]) ** 2).sum(axis=2)
    ids = rows["vec_id"].to_numpy()
    want = dict(zip(ids[~train].tolist(), ids[train][square.argmin(axis=1)].tolist(), strict=True))
    got = QUERIES["nearest_neighbor_whole"](spark, sf_dir).collect()
    assert {r.vec_id: r.nearest_id for r in got} == want


def test_visits_do_not_grow_with_the_points(spark):
    """Ten times the points under a tree of 16 leaves: a row sees about as many blocks."""
    rng = np.random.default_rng(8)
    per_row = []
    for n in (3000, 30_000):
        features = ["x0", "x1", "x2"]
        train = spark.createDataFrame(table(rng, n, 3, 0, DRAWS["spread"]))
        points = train.select(
            *[F.col(x).alias(f"_f{i}") for i, x in enumerate(features)],
            F.col("id").alias("_near"), F.col("label").alias("_label"))
        dims = ["_f0", "_f1", "_f2"]
        tree = neighbors._leaf_function(neighbors._sampled_tree(points.select(*dims), n, 4), 4)
        leaved = points.withColumn("_leaf", tree(*dims))
        boxes = (
            leaved.groupBy("_leaf")
            .agg(*[F.min(d).alias(f"lo{d}") for d in dims], *[F.max(d).alias(f"hi{d}") for d in dims])
            .toPandas()
            .sort_values("_leaf", ignore_index=True)
        )
        search = BlockSearch(leaved, boxes, dims, 64, 1000, neighbors._nearest_in_group(dims))
        test = table(rng, 200, 3, 10**6, DRAWS["spread"])
        rows = spark.createDataFrame(test).select(
            F.col("id").alias("_key"), *[F.col(x).alias(d) for x, d in zip(features, dims, strict=True)])
        best = search.run(rows, lambda a, b, boxes=boxes: neighbors._nearest_leaves(boxes, dims, a, b))
        assert best.count() == 200
        per_row.append(search.visits / 200)
    assert per_row[1] < 2 * per_row[0]
    assert per_row[1] < 0.1 * 30_000 / 64


def test_collision_chance_is_measured():
    rng = np.random.default_rng(2)
    for distance in (0.5, 1.0, 3.0):
        offset = rng.uniform(0, 2.0, 200_000)
        step = rng.normal(size=200_000) * distance
        share = np.mean(np.floor(offset / 2.0) == np.floor((offset + step) / 2.0))
        chance = hashed_neighbors.collision(np.array([distance]), 2.0)[0]
        assert abs(share - chance) < 0.01
    assert hashed_neighbors.collision(np.array([0.0]), 2.0)[0] == 1.0


@pytest.mark.parametrize("kind", ["groups", "unrelated", "copies"])
def test_hashed_neighbors(spark, kind):
    """Recall of nine in ten, distances exact, every row answered; hot cells are cut."""
    rng = np.random.default_rng(6)
    features = [f"x{d}" for d in range(24)]
    centers = rng.normal(size=(12, 24)) * 6

    def some(n, start):
        values = rng.normal(size=(n, 24))
        if kind == "groups":
            values += centers[rng.integers(0, 12, n) * (rng.random(n) > 0.4)]
        if kind == "copies":
            values = np.round(values * 0.3)
        df = pd.DataFrame(values, columns=features)
        return df.assign(id=np.arange(start, start + n), label=[f"l{i % 7}" for i in range(n)])

    train, test = some(1500, 0), some(200, 10_000)
    test.loc[:2, features] = 1e6  # far from everything
    found = hashed_neighbors.hashed_neighbor(
        spark.createDataFrame(test), spark.createDataFrame(train), "id", "label", features, chunk_rows=200
    ).collect()
    want = brute_force(test, train, features)
    assert sorted(r.id for r in found) == sorted(want)
    exact = [r.distance == want[r.id][1] for r in found]
    assert np.mean(exact) >= 0.9
    by_id = train.set_index("id")[features]
    for r in found[:50]:
        gap = by_id.loc[r.nearest_key].to_numpy() - test.set_index("id").loc[r.id, features].to_numpy(float)
        assert abs(r.distance - np.sqrt((gap**2).sum())) <= 1e-9 * max(1, r.distance)


def test_less_is_compared_where_neighbours_are_near():
    rng = np.random.default_rng(3)
    near, far = rng.uniform(0.1, 0.3, 300), rng.uniform(4, 8, (300, 500))
    easy = hashed_neighbors.calibrated(near, far, 10**9, 0.95)
    assert easy.recall >= 0.95 and easy.share < 0.001
    hard = hashed_neighbors.calibrated(far[:, 0] * 0.9, far, 10**9, 0.95)
    assert hard.share > easy.share
    with pytest.raises(ValueError, match="recall"):
        hashed_neighbors.calibrated(near, far, 10, 2.0)
