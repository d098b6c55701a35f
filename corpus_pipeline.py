"""Training corpus pipeline: language ID, near-duplicates, decontamination, mixing, shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``docs``. Rows are told apart by id and text; rows that agree in
both are copies of one row. Columns beyond those of ``documents`` pass through untouched.
An empty table stays empty through every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm import langid
from pricelens.llm.decontaminate import decontaminate
from pricelens.llm.mixing import mix_sources
from pricelens.llm.neardup import near_duplicates
from pricelens.llm.queries import contaminated, sharded
from pricelens.llm.util import (held_out, join_rows, materialise, reach_package, read_table,
                                text_key)

#: A text whose best language has a smaller share than this says nothing about its language;
#: short clean texts between two close languages stay.
LEAST_SCORE = 0.3
#: Documents whose sets of five-word shingles are similar to 0.80 or more are near-duplicates.
DUPLICATE_PERCENT = 80
KEYS = ["_doc", "_tkey"]


def _packed(docs: DataFrame) -> DataFrame:
    """Rows as one column ``_row``, with their key: no name in them can clash."""
    return docs.select(F.col("doc_id").alias("_doc"), text_key().alias("_tkey"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language: those with a letter whose language is clear."""
    reach_package(spark)
    names, trees = langid.learn(docs, ~held_out())
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    told = langid.identify(rows, names, trees, ["_row"])
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (similarity of five-word shingles
    0.80 or more, against 0.85 in the query of the operator), that with the smallest id, and
    every document without words (those are linked with nothing)."""
    reach_package(spark)
    groups = near_duplicates(docs, percent=DUPLICATE_PERCENT)
    first = (groups.where("n_shingles > 0").groupBy("group")
             .agg(F.min(F.struct(F.col("doc").isNull().alias("x"), "doc", "tkey")).alias("m"))
             .select(F.col("m.doc").alias("_doc"), F.col("m.tkey").alias("_tkey"),
                     F.lit(True).alias("_one")))
    blank = groups.where("n_shingles = 0").select(
        F.col("doc").alias("_doc"), F.col("tkey").alias("_tkey"), F.lit(False).alias("_one")).distinct()
    kept = join_rows(_packed(docs), first.union(blank), KEYS)
    copy = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.lit(0)))
    return kept.withColumn("_copy", copy).where("_copy = 1 or not _one").select("_row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more lies in benchmark windows."""
    reach_package(spark)
    bad = decontaminate(docs, read_table(spark, sf_dir, "benchmark")).where(contaminated()).select(
        F.col("doc").alias("_doc"), F.col("tkey").alias("_tkey")).distinct()
    return join_rows(_packed(docs), bad, KEYS, "left_anti").select("_row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; what it doesn't take goes."""
    reach_package(spark)
    keys = [*KEYS, "_source"]
    taken = mix_sources(docs).groupBy(
        F.col("doc").alias("_doc"), F.col("tkey").alias("_tkey"), F.col("source").alias("_source")
    ).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0")
    rows = _packed(docs).withColumn("_source", F.col("_row.source").cast("string"))
    each = join_rows(rows, taken, keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1
    times = F.floor(F.col("_copies") / F.col("_rows")) + F.when(
        F.col("_nth") < F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (each.withColumn("_nth", nth)
            .select("_row", F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_again"))
            .select("_row.*"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row, as the query of the sharding operator returns them."""
    return sharded(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicate_removal),
          ("decontamination", benchmark_decontamination), ("mixing", source_mixing),
          ("sharding", sharding)]

#: Trained models, sampling and hash order can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
