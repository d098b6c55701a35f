"""Forests whose trees grow inside tasks, and Huber fits of one task, against Spark ML and the steps."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from pricelens.operators import curve, forest, robust


def _rows(kind, n, seed):
    r = np.random.default_rng(seed)
    if kind == "ties":  # few values: most candidates of a node gain the same
        return r.integers(0, 3, (n, 6)).astype(float), r.integers(0, 4, n) * 0.5 + 5.1
    a, z = r.normal(size=(n, 4)), r.poisson(2, (n, 2)).astype(float)
    k, c = r.integers(0, 7, n), r.integers(0, 3, n)
    x = np.hstack([a, z, a[:, :1] * 2, np.zeros((n, 1)), np.eye(7)[k], np.eye(3)[c], (r.random((n, 2)) < 0.3) * 1.0])
    return x, 4 + a[:, 0] * 0.3 + z[:, 0] * 0.1 + k * 0.05 + r.normal(size=n) * 0.2


def _frames(spark, kind, n):
    x, y = _rows(kind, n, n)
    train = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["y", "features"]).coalesce(1).cache()
    asked = _rows(kind, 150, 5)[0]
    return train, spark.createDataFrame([(i, Vectors.dense(a)) for i, a in enumerate(asked)], ["i", "features"]).repartition(3).cache()


def _by_id(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("kind,n,trees", [("mixed", 400, 12), ("ties", 200, 12), ("mixed", 5, 6), ("mixed", 12_000, 2),
                                          ("mixed", 26_000, 1)])
def test_trees_grown_in_tasks_are_those_of_spark(spark, monkeypatch, kind, n, trees):
    """No fit of a job per level, and the predictions of one (over 10,000 rows the bins are
    found on a sample, drawn as Spark draws it)."""
    train, asked = _frames(spark, kind, n)
    want = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=trees, maxDepth=30,
                                 featureSubsetStrategy="all", seed=42).fit(train).transform(asked)

    def no_fit(**_):
        raise AssertionError("a job per level")
    monkeypatch.setattr(curve, "RandomForestRegressor", no_fit)
    got = curve.forest_predictions(train, asked, n, "y", curve.CurveConfig(rf_trees=trees))
    assert got.columns == ["i", "forest"]
    assert np.allclose(_by_id(got, "forest"), _by_id(want, "prediction"), rtol=1e-13, atol=0)


def test_lots_in_tasks_equal_lots_of_fits(spark, monkeypatch):
    train, asked = _frames(spark, "mixed", 300)
    cfg = curve.CurveConfig(rf_trees=7, rf_depth=4)
    monkeypatch.setattr(curve, "NODES_AT_ONCE", 3 * 2 * 300)  # lots of 3, 3 and 1 trees
    in_tasks = _by_id(curve.forest_predictions(train, asked, 300, "y", cfg), "forest")
    fits = _by_id(curve.forest_predictions(train, asked, 300, "y", cfg, 2), "forest")  # as if in two partitions
    assert np.allclose(in_tasks, fits, rtol=1e-13, atol=0)


def test_training_rows_must_be_numbers(spark):
    train, asked = _frames(spark, "mixed", 20)
    bad = train.withColumn("y", F.when(F.col("y") > 4, F.col("y"))).cache()
    with pytest.raises(Exception, match="null, NaN or infinite"):
        curve.forest_predictions(bad, asked, 20, "y", curve.CurveConfig(rf_trees=2)).collect()


def test_a_task_fits_what_the_steps_fit(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = []
    for fit, (n, p) in enumerate([(300, 4), (25, 9), (80, 1)]):
        x = r.normal(size=(n, p))
        y = x @ r.normal(size=p) + 1 + r.normal(size=n) * 0.2 + (r.random(n) < 0.1) * 9
        rows += [(fit, [float(v) for v in a], float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "fit int, x array<double>, y double").repartition(5)

    def no_steps(*_):
        raise AssertionError("a job per step")
    with monkeypatch.context() as m:
        m.setattr(robust, "_in_steps", no_steps)
        whole = robust.huber_groups(df)
    monkeypatch.setattr(robust, "TASK_ROWS", 50)  # the first and the last in steps
    mixed = robust.huber_groups(df)
    assert whole.keys() == mixed.keys() == {0, 1, 2}
    for f in whole:
        assert np.allclose(whole[f][0], mixed[f][0], atol=1e-7) and abs(whole[f][1] - mixed[f][1]) < 1e-7
        assert abs(whole[f][2] - mixed[f][2]) < 1e-7


def test_small_tables_grow(spark):
    """One row, equal rows, no column with a split, a tree without rows."""
    one = forest.Binned(np.ones((1, 2)), np.array([3.0]), forest.find_thresholds(np.ones((1, 2)), 1))
    trees = forest.grow(one, np.array([[2, 0]], np.uint8), 30)
    assert trees.sums(one.of(np.zeros((2, 2)))).tolist() == [3.0, 3.0] and len(trees.value) == 2
    x = np.array([[0.0, 1.0], [0.0, 1.0], [0.0, 5.0]])
    table = forest.Binned(x, np.array([1.0, 2.0, 6.0]), forest.find_thresholds(x, 3))
    trees = forest.grow(table, np.ones((3, 1), np.uint8), 30)
    assert trees.sums(table.of(np.array([[9.0, 2.0], [9.0, 4.0]]))).tolist() == [1.5, 6.0]
