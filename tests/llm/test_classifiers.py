import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import quality as Q
from pricelens.llm import text as T
from pricelens.llm import toxicity as X
from pricelens.llm.util import held_out

SF = "/root/testdata/sf0.1"


def auc(y, p):
    import pandas as pd
    rank = pd.Series(p).rank().to_numpy()
    one = y == 1
    return (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())


@pytest.mark.parametrize("name, label, least", [("op7_ftrl", "toxic", 0.9), ("op9_random_indexing", "quality", 0.98)])
def test_held_out_rows_are_ranked_well(spark, name, label, least):
    from pricelens.llm import queries
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) == 10_000 and got["score"].between(0, 1).all()
    threshold = 0.3 if label == "toxic" else 0.7
    assert ((got["score"] >= threshold).astype(int) == got["predicted"]).all()
    held = got.merge(labels, on="doc_id").query("held_out")
    assert auc(held[label].to_numpy(), held["score"].to_numpy()) > least


def test_toxic_words_are_caught_and_clean_rows_left_alone(spark):
    rng = np.random.default_rng(2)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    rows = [(i, f"{word(40)} scoundrel {word(40)}" if i % 5 == 0 else word(81), int(i % 5 == 0)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic").where(~held_out())
    got = X.score(docs, X.fit(docs, labels), ["doc_id", "toxic", held_out().alias("held_out")]).toPandas()
    held = got[got["held_out"]]
    assert (held.loc[held["toxic"] == 1, "score"] >= 0.3).mean() > 0.95
    assert (held.loc[held["toxic"] == 0, "score"] < 0.3).mean() > 0.98


@pytest.mark.parametrize("kind, label", [(X, "toxic"), (Q, "quality")])
def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, kind, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (9, 0), (5, 1), (13, 0)],
                                   f"doc_id long, {label} int").withColumn("text", F.lit("clash"))
    model = kind.fit(odd_docs, labels, label)
    got = kind.score(odd_docs.drop("score"), model, ["doc_id", "text"]).toPandas()
    assert len(got) == odd_docs.count() and got["score"].between(0, 1).all()
    assert got.groupby(got["text"].fillna(""))["score"].nunique().eq(1).all()
    assert kind.score(no_docs, model, ["doc_id"]).count() == 0
    blind = kind.fit(odd_docs, labels.where("false"), label)
    assert set(kind.score(odd_docs, blind, ["doc_id"]).toPandas()["score"]) == {0.5}


def test_word_vectors_add_up_over_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = Q.word_vectors(docs.coalesce(1)), Q.word_vectors(docs.repartition(7))
    assert np.array_equal(one, many) and one.any()


def test_neighbours_make_a_word_vector():
    data = np.frombuffer(b"alpha beta gamma", np.uint8)
    w = T.words(data, np.array([0, len(data)]), T.NONSPACE)
    batch = __import__("pyarrow").RecordBatch.from_pydict({"text": ["alpha beta gamma"]})
    out = next(Q._contexts(8, 64)(iter([batch]))).to_pydict()
    want = np.zeros((64, 8))
    index = [np.zeros(8) for _ in range(3)]
    for at, sign in Q._index_entries(w.hashes, 8):
        for i in range(3):
            index[i][at[i]] += sign[i]
    for i in range(3):
        want[int(w.hashes[i] % np.uint64(64))] += sum(index[j] for j in range(3) if j != i)
    got = np.zeros((64, 8))
    for r, b in enumerate(out["bucket"]):
        got[b] = [out[f"v{d}"][r] for d in range(8)]
    assert np.array_equal(got, want)
