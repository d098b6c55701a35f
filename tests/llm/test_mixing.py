import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm.mixing import flight, mix_sources, targets


def test_targets_cap_and_reshare():
    assert targets({"b": 100, "a": 100, None: 100}) == pytest.approx({"a": 200, "b": 500 / 3, None: 250 / 3})
    got = targets({"a": 10, "b": 0, "c": 990})
    assert got["a"] == 20 and got["b"] == 0 and got["c"] == pytest.approx(1480)
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0}


def test_flight_keeps_both_totals_and_leaves_two():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 700).astype(float)
    prob = np.full(700, 0.37)
    p = flight(size, prob, np.random.default_rng(0), land=False)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert p.sum() == pytest.approx(prob.sum(), abs=1e-6) and p @ size == pytest.approx(prob @ size, rel=1e-9)
    landed = flight(size, prob, np.random.default_rng(0), land=True)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ size - prob @ size) <= size.max()


def test_inclusion_probabilities_hold():
    size = np.array([3.0, 5, 5, 8, 13, 21, 2, 2, 40, 1])
    runs = np.array([flight(size, np.full(10, 0.4), np.random.default_rng(s), False) for s in range(3000)])
    assert np.abs(runs.mean(axis=0) - 0.4).max() < 0.05


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = mix_sources(docs, block=100).toPandas()
    assert len(got) == 10_000 and got["copies"].between(0, 2).all()
    got["taken"] = got["copies"] * got["size"]
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"),
                                   source_size=("source_size", "first"), most=("size", "max"))
    assert (by["size"] == by["source_size"]).all()
    assert ((by["taken"] - by["target"]).abs() <= by["most"]).all()
    assert by["target"].sum() == pytest.approx(1.5 * by["size"].sum())
    again = mix_sources(docs.repartition(5), block=100).toPandas()
    key = ["doc", "copies"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    got = mix_sources(odd_docs.withColumn("p", F.lit("clash"))).toPandas()
    assert len(got) == odd_docs.count() and got["source"].isna().sum() == 2
    assert mix_sources(no_docs).count() == 0
