import random

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F


def test_stages_and_rows(spark):
    got = C.run(spark, "/root/testdata/sf0.001").toPandas()
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot"} <= set(got.columns)
    for _, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert [n for n, _ in C.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(1)
    lang = {"en": "the of and that with", "fr": "le la des que dans"}
    text = lambda w, n: " ".join(rng.choice(w.split()) + rng.choice("abcdefgh") for _ in range(n))
    rows = [(i, text(lang[x], 60), x, f"s{i % 2}") for i in range(60) for x in [("en", "fr")[i % 2]]]
    item = " ".join(f"question{i}" for i in range(20))
    rows += [(100, rows[0][1], "en", "s0"), (101, rows[0][1] + " end", "en", "s0"), (0, rows[0][1], "en", "s0"),
             (102, f"{text(lang['en'], 30)} {item}", "en", "s0"), (103, "123 456", "en", "s0"), (104, None, "en", "s1")]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, 0, "extra") for r in rows],
                          "doc_id long, text string, lang string, source string, n_chars long, _row string"
                          ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_each_decision_takes_effect(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    after, ids = docs, {}
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, after, corpus)
        assert after.columns == docs.columns
        ids[name] = [r["doc_id"] for r in after.collect()]
    whole = [r["doc_id"] for r in docs.collect()]
    assert sorted(ids["language_id"]) == sorted(x for x in whole if x not in (103, 104))
    assert sorted(ids["near_duplicates"]) == [*range(60), 102]
    assert sorted(ids["decontamination"]) == list(range(60))
    assert set(ids["mixing"]) <= set(range(60)) and len(ids["mixing"]) > 60
    assert max(ids["mixing"].count(i) for i in range(60)) == 2


def test_empty_and_odd_tables(spark, odd_docs, no_docs, corpus):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", F.col("score").alias("_doc"))
    for table in (docs, docs.where("false")):
        for _, stage in C.STAGES:
            out = stage(spark, table, corpus)
            assert out.count() >= 0
            if "slot" not in out.columns:
                assert out.columns == docs.columns and (table is docs or out.isEmpty())


def test_copies_of_similarity_80_to_85_go(spark):
    """100 words, two scattered ones changed: 86 of 106 shingles in common, 0.81."""
    words = [f"w{i}" for i in range(100)]
    edited = [f"x{i}" if i in (30, 70) else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, "another text of six words")],
                                 "doc_id long, text string")
    assert sorted(r["doc_id"] for r in C.near_duplicate_removal(spark, docs, "").collect()) == [1, 3]
