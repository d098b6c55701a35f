import random
from itertools import combinations

from pyspark.sql import functions as F

from pricelens.llm.sharding import minimax_cuts, shard


def largest(sizes, cuts):
    at = [0, *cuts, len(sizes)]
    return max(sum(sizes[a:b]) for a, b in zip(at, at[1:]))


def test_cuts_are_minimax():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 5, 9, 40]) for _ in range(rng.randint(0, 9))]
        k = rng.randint(1, 5)
        cuts = minimax_cuts(sizes, k)
        assert len(cuts) == k - 1 and cuts == sorted(cuts) and all(0 <= c <= len(sizes) for c in cuts)
        best = min(largest(sizes, c) for c in combinations(sorted(list(range(len(sizes) + 1)) * k), k - 1))
        assert largest(sizes, cuts) == best


def check(got, shards=24):
    for _, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert got["shard"].between(0, shards - 1).all()


def test_texts_stay_together_slots_are_gapless_totals_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = shard(docs).join(docs.select(F.col("doc_id").alias("doc"), "text"), "doc").toPandas()
    check(got)
    assert len(got) == 10_000 and (got.groupby("text")["shard"].nunique() == 1).all()
    assert (got["size"] == got["text"].str.encode("utf-8").str.len() + 8).all()
    totals = got.groupby("shard")["size"].sum()
    assert len(totals) == 24 and totals.max() < 1.1 * totals.mean() and totals.min() > 0.9 * totals.mean()


def test_a_hot_text_is_numbered_in_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = shard(docs, slot_rows=100).toPandas()
    check(got)
    assert got.loc[got["doc"] % 3 > 0, "shard"].nunique() == 1


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    got = shard(odd_docs).toPandas()
    check(got)
    assert len(got) == odd_docs.count() and (got.loc[got["doc"] == 4, "size"] == 8).all()
    assert shard(no_docs).count() == 0
