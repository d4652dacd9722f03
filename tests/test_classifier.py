from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from querymill.operators.classifier import INVERSE_PENALTY, batch_score, predict, train_classifier
from querymill.operators.evaluation import accuracy, in_train, train_test_split
from querymill.sinks.files import write_parquet
from querymill.sinks.versions import save_model_version, write_version
from querymill.sources.files import scan_parquet
from querymill.sources.versions import committed_versions, load_latest_model, model_versions

FEATURES = ["x0", "x1", "x2", "x3"]


def newton_optimum(x, y, penalty, classes):
    """Minimise half the squared weights + penalty * summed log-loss, by Newton steps."""
    n, d = x.shape
    k = len(classes)
    z = np.hstack([x, np.ones((n, 1))])
    onehot = (y[:, None] == classes[None, :]).astype(float)
    shrink = np.diag([1.0] * d + [0.0])
    w = np.zeros((k, d + 1))
    for _ in range(50):
        scores = z @ w.T
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = penalty * (p - onehot).T @ z + w @ shrink
        hessian = np.zeros((k * (d + 1), k * (d + 1)))
        for a in range(k):
            for b in range(k):
                curve = p[:, a] * ((a == b) - p[:, b])
                block = penalty * (z * curve[:, None]).T @ z + (a == b) * shrink
                hessian[a * (d + 1) : (a + 1) * (d + 1), b * (d + 1) : (b + 1) * (d + 1)] = block
        step = np.linalg.lstsq(hessian, gradient.ravel(), rcond=None)[0].reshape(k, d + 1)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


@pytest.fixture(scope="module")
def points(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    columns = [F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(FEATURES)]
    return embeddings.select(*columns, F.concat(F.lit("c"), F.col("label")).alias("species"), "vec_id").cache()


def test_weights_are_those_of_the_stated_objective(points):
    rows = points.where("species < 'c4'")
    model = train_classifier(rows)
    fitted = model.stages[1]
    data = rows.toPandas()
    classes = np.array(sorted(data["species"].unique()))
    want = newton_optimum(data[FEATURES].to_numpy(), data["species"].to_numpy(), INVERSE_PENALTY, classes)
    got = fitted.coefficientMatrix.toArray()
    assert list(model.stages[2].getLabels()) == list(classes)
    np.testing.assert_allclose(got, want[:, :4], atol=2e-5)
    centred = want[:, 4] - want[:, 4].mean()
    intercepts = fitted.interceptVector.toArray()
    np.testing.assert_allclose(intercepts - intercepts.mean(), centred, atol=2e-5)


def test_two_classes_use_one_weight_vector(points):
    rows = points.where("species IN ('c0', 'c1')")
    model = train_classifier(rows)
    data = rows.toPandas()
    x = np.hstack([data[FEATURES].to_numpy(), np.ones((len(data), 1))])
    y = (data["species"] == "c1").to_numpy(dtype=float)
    w = np.zeros(5)
    shrink = np.diag([1.0, 1.0, 1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = INVERSE_PENALTY * x.T @ (p - y) + shrink @ w
        w -= np.linalg.solve(INVERSE_PENALTY * (x * (p * (1 - p))[:, None]).T @ x + shrink, gradient)
    np.testing.assert_allclose(model.stages[1].coefficients.toArray(), w[:4], atol=2e-5)
    assert model.stages[1].intercept == pytest.approx(w[4], abs=2e-5)


def test_predictions_are_the_most_likely_label(points):
    model = train_classifier(points)
    scored = model.transform(points).select("_probability", "predicted_score").collect()
    names = model.stages[2].getLabels()
    assert all(r.predicted_score == names[int(np.argmax(r._probability.toArray()))] for r in scored)


@pytest.mark.parametrize("broken", ["one class", "missing label", "missing feature"])
def test_unusable_training_data_is_refused(points, broken):
    df = {
        "one class": points.where("species = 'c1'"),
        "missing label": points.withColumn("species", F.when(F.col("vec_id") != 3, F.col("species"))),
        "missing feature": points.withColumn("x2", F.when(F.col("vec_id") != 3, F.col("x2"))),
    }[broken]
    with pytest.raises(Exception):
        train_classifier(df)


def test_scores_with_and_without_label_agree(spark, points, root):
    model = train_classifier(points)
    keys = ["vec_id"]
    with_label = predict(model, points, keys)
    without = predict(model, points.drop("species"), keys)
    assert with_label.columns == ["vec_id", "predicted_score"]
    assert with_label.exceptAll(without).isEmpty()
    assert predict(model, points).columns == ["predicted_score"]
    plan = with_label._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_whole_number_labels_stay_numbers(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    df = embeddings.select(*[F.col("embedding")[i].alias(x) for i, x in enumerate(FEATURES)], "label")
    scored = predict(train_classifier(df, "label"), df, label="label")
    assert scored.schema["predicted_score"].dataType.simpleString() == "int"


def test_model_versions(spark, points, root):
    model = train_classifier(points)
    first = save_model_version(model, root, "2026-01-01")
    second = save_model_version(model, root, "2026-01-02")
    with pytest.raises(Exception, match="(?i)already exists"):
        save_model_version(model, root, "2026-01-02")
    assert committed_versions(spark, root) == [first, second]
    loaders = model_versions(spark, root)
    assert list(loaders) == [first, second]
    assert isinstance(loaders[first](), PipelineModel)
    again = predict(load_latest_model(spark, root), points, ["vec_id"])
    assert again.exceptAll(predict(model, points, ["vec_id"])).isEmpty()


@pytest.mark.parametrize("declared", ["application/x-parquet", "text/csv"])
def test_batch_scoring(spark, points, root, declared):
    model = train_classifier(points)
    if declared == "text/csv":
        write_version(points, f"{root}/in", "csv", "a")
    else:
        write_parquet(points.where("vec_id % 2 = 0"), f"{root}/in/deep/even")
        write_parquet(points.where("vec_id % 2 = 1"), f"{root}/in/odd")
    batch_score(
        spark, model, f"{root}/in", f"{root}/out", declared=declared, schema=points.schema, key_cols=["vec_id"]
    )
    got = scan_parquet(spark, f"{root}/out")
    want = predict(model, points, ["vec_id"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError):
        batch_score(spark, model, f"{root}/in", f"{root}/out2", declared="image/png")
    with pytest.raises(ValueError):
        batch_score(spark, model, f"{root}/in", f"{root}/out2", declared=declared, accept="text/csv", schema=points.schema)


# ---------------------------------------------------------------- split and accuracy


def test_split_is_complete_disjoint_and_layout_independent(spark):
    df = spark.range(20_000)
    train, test = train_test_split(df, "id")
    assert train.count() + test.count() == 20_000
    assert train.intersect(test).isEmpty()
    assert train.count() / 20_000 == pytest.approx(0.8, abs=0.01)
    again, _ = train_test_split(df.repartition(13), "id")
    assert again.exceptAll(train).isEmpty()
    other, _ = train_test_split(df, "id", seed=4)
    assert not other.exceptAll(train).isEmpty()


@pytest.mark.parametrize("fraction, n", [(0.0, 0), (1.0, 1000)])
def test_split_bounds(spark, fraction, n):
    assert spark.range(1000).where(in_train("id", fraction)).count() == n


def test_split_rejects_bad_fraction():
    with pytest.raises(ValueError):
        in_train("id", 1.5)


def test_accuracy(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", None), ("d", "d")], "l string, p string")
    assert accuracy(df, "l", "p").first().accuracy == 0.5


def test_boolean_label(spark):
    rows = [(float(i % 2), 0.0, 0.0, 0.0, i % 2 == 1) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label boolean")
    model = train_classifier(df, "label")
    got = predict(model, df, ["a"], "label")
    assert {(r.a, r.predicted_score) for r in got.collect()} == {(0.0, False), (1.0, True)}


def test_class_bound_names_the_real_number(spark):
    df = spark.range(9).select(*[F.lit(0.0).alias(c) for c in "abcd"], F.col("id").alias("label"))
    with pytest.raises(ValueError, match="has 9 classes, need 2 to 5"):
        train_classifier(df, "label", max_classes=5)


def test_null_split_key_stops(spark):
    from querymill.operators.evaluation import train_test_split

    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(Exception, match="missing value"):
        train_test_split(df, "k")[0].collect()


def test_equal_rows_are_joined_before_a_fit(spark, monkeypatch):
    """Few distinct rows, many times each: the same weights as from all rows."""
    from querymill.operators import classifier

    rows = [(float(i % 3), float(i % 5), "abc"[(i % 3 + i % 5) % 3 if i % 7 else 0]) for i in range(400)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, species string")
    joined = classifier.train_classifier(df, n_features=2).stages[1]
    assert joined.getWeightCol() == "_weight"
    monkeypatch.setattr(classifier, "REPEATS", 10**9)
    whole = classifier.train_classifier(df, n_features=2).stages[1]
    gap = joined.coefficientMatrix.toArray() - whole.coefficientMatrix.toArray()
    assert abs(gap).max() < 1e-5
