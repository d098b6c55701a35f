import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelens.llm import langid as L
from pricelens.llm.util import held_out


def brute_bits(train, text, order):
    """Code length of a text after training texts, by the definition."""
    counts = [Counter() for _ in range(order + 1)]

    def contexts(t, d):
        b = t.lower().encode() if t.isascii() else t.encode()
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
        for i in range(len(b)):
            ctx = bytes(b[i - j] if i >= j else 0 for j in range(d, 0, -1))
            yield ctx, b[i]
    for t in train:
        for d in range(order + 1):
            counts[d].update(contexts(t, d))
    total = 0.0
    symbols = [list(contexts(text, d)) for d in range(order + 1)]
    for i in range(len(symbols[0])):
        for d in range(order, -1, -1):
            ctx, s = symbols[d][i]
            at = {k[1]: n for k, n in counts[d].items() if k[0] == ctx}
            if not at:
                continue
            t, q = sum(at.values()), len(at)
            if s in at:
                total -= math.log2(at[s] / (t + q))
                break
            total -= math.log2(q / (t + q))
        else:
            total += 8
    return total


def test_code_lengths_equal_the_definition(spark):
    train = {"en": ["the cat and the hat", "That is it"], "fr": ["le chat et le chapeau", "été à côté"]}
    rows = [(lang, t) for lang, ts in train.items() for t in ts]
    df = spark.createDataFrame(rows, "lang string, text string")
    for order in (0, 2, 4):
        names, trees = L.learn(df, F.lit(True), order=order)
        assert names == ["en", "fr"]
        for text in ("the chat", "zzz", "à la CAT", "t"):
            data = np.frombuffer(text.encode(), np.uint8)
            bits = trees.code_lengths(data, np.array([0, len(data)]))[0]
            for k, lang in enumerate(names):
                assert bits[k] == pytest.approx(brute_bits(train[lang], text, order), rel=1e-4)


def test_key_table_finds_all_keys_and_no_other():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))
    table = L.KeyTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(2**62)) == -1).all()
    assert (L.KeyTable(keys[:0]).find(keys) == -1).all()


def test_held_out_accuracy(spark):
    from pricelens.llm.queries import op2_ppm
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id"), "lang").toPandas()
    got = op2_ppm(spark, sf).toPandas().merge(truth, on="doc_id")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["lang_pred"] == got["lang"])[got["held_out"]].mean() > 0.98


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    names, trees = L.learn(odd_docs, ~held_out())
    rows = odd_docs.withColumnRenamed("score", "_score")
    got = L.identify(rows, names, trees, ["doc_id", "text", "_score"]).toPandas()
    assert len(got) == odd_docs.count()
    blank = got["text"].isna() | ~got["text"].fillna("").str.contains(r"[^\W\d_]", regex=True)
    assert (got.loc[blank, "lang_pred"] == "und").all() and (got.loc[blank, "score"] == 0).all()
    assert got.loc[~blank, "lang_pred"].isin(names).all()
    assert L.identify(no_docs, names, trees, ["doc_id"]).count() == 0
    none, empty = L.learn(no_docs, F.lit(True))
    assert none == [] and set(L.identify(odd_docs, none, empty, ["doc_id"]).toPandas()["lang_pred"]) == {"und"}


def test_learning_is_bounded_by_the_sample(spark):
    rows = spark.range(4000).select(F.lit("en").alias("lang"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    _, few = L.learn(rows, F.lit(True), order=0, per_language=100)
    _, many = L.learn(rows, F.lit(True), order=0, per_language=10**6)
    assert isinstance(few.cost, list) and len(few.symbol[0]) <= len(many.symbol[0])
    assert pd.Series(many.symbol[0]).is_unique
