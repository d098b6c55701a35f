"""Registered queries: ingest, split, match and audit (build steps 1-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import clean, match, quality, split, stats
from ..sources import fixtures as fx
from . import common as C
from .common import round_doubles as r6, sql_with

PRICE_FILTER_LO, PRICE_FILTER_HI = 20.0, 10000.0  # open range on both study prices


# ------------------------------------------------------------------ step 1

def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return C.local_fresh(spark, d).select("id", "row_key", "last_scraped", "price")


def price_parse(spark: SparkSession, d: str) -> DataFrame:
    fresh = clean.parse_price(C.local_fresh(spark, d), fx=C.FX)
    return fresh.select("id", "raw_price_str", "price_usd")


def valid_price_log(spark: SparkSession, d: str) -> DataFrame:
    return r6(C.local_silver(spark, d).select("id", "price_usd", "log_price"))


def split_test(spark: SparkSession, d: str) -> DataFrame:
    test, _, _ = C.splits(spark, d)
    return r6(test.select("id", "price_usd", "log_price"))


def split_local_train(spark: SparkSession, d: str) -> DataFrame:
    _, local_train, _ = C.splits(spark, d)
    return r6(local_train.select("id", "price_usd", "log_price"))


def split_global_train(spark: SparkSession, d: str) -> DataFrame:
    _, _, global_train = C.splits(spark, d)
    return r6(global_train.select("id", "price", "log_price"))


def leak_count(spark: SparkSession, d: str) -> DataFrame:
    test, local_train, global_train = C.splits(spark, d)
    return split.leak_counts({"local_train": local_train, "global_train": global_train}, test)


def split_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: scan -> freshest per key -> parse -> valid -> log -> hash split -> anti
    join -> price summary per split (exact quantiles, distributed)."""
    test, local_train, global_train = C.splits(spark, d)
    u = (test.select(F.lit("test").alias("split_name"), F.col("price_usd").alias("price"))
         .unionByName(local_train.select(F.lit("local_train").alias("split_name"),
                                         F.col("price_usd").alias("price")))
         .unionByName(global_train.select(F.lit("global_train").alias("split_name"), "price")))
    return stats.summary_stats(u, "price", ["split_name"], digits=2)


# ------------------------------------------------------------------ step 2

def _matched(spark: SparkSession, d: str) -> DataFrame:
    local = C.local_silver(spark, d).select("id", "latitude", "longitude",
                                            F.col("price_usd").alias("price"))
    glob = C.global_silver_all(spark, d).select("id", "lat", "long", "price")
    return match.id_match(local, glob, "id", "_glob")


def id_match(spark: SparkSession, d: str) -> DataFrame:
    return r6(_matched(spark, d).select("id", "price", "price_glob", "latitude", "longitude",
                                        "lat_glob", "long_glob"))


def coord_match(spark: SparkSession, d: str) -> DataFrame:
    m = match.coord_match(_matched(spark, d), "latitude", "longitude", "lat_glob", "long_glob",
                          C.COORD_TOLERANCE)
    return r6(m.select("id", "price", "price_glob", "coord_dist"))


def unmatched(spark: SparkSession, d: str) -> DataFrame:
    return match.unmatched_keys(C.global_silver_all(spark, d), C.local_silver(spark, d), "id")


def _pair_raw(spark: SparkSession, d: str) -> DataFrame:
    """Freshest local row (parsed, not yet validated) next to the global row, by key."""
    local = clean.parse_price(C.local_fresh(spark, d), fx=C.FX).select(
        "id", F.col("price_usd").alias("price"))
    glob = fx.global_raw(spark, d).select(F.col("property_id").alias("id"), "price")
    return match.id_match(local, glob, "id", "_glob")


def quality_audit(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_audit(_pair_raw(spark, d), "price", "price_glob")


def valid_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return quality.valid_crosstab(_pair_raw(spark, d), "price", "price_glob")


def missing_strategy(spark: SparkSession, d: str) -> DataFrame:
    return r6(quality.missing_strategy(_pair_raw(spark, d), "price", "price_glob"))


def coalesced_price(spark: SparkSession, d: str) -> DataFrame:
    return r6(quality.coalesced_price(_pair_raw(spark, d), "id", "price", "price_glob"))


def _study(spark: SparkSession, d: str) -> DataFrame:
    """Two prices per item within the open study range, with differences."""
    ts = clean.open_range(fx.two_source(spark, d), ["price_local", "price_global"],
                          PRICE_FILTER_LO, PRICE_FILTER_HI)
    return ts.withColumn("price_diff", F.col("price_global") - F.col("price_local"))


def price_diff_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.summary_stats(_study(spark, d), "price_diff", digits=2)


def sign_counts(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.sign_counts(_study(spark, d), "price_diff"))


def match_rates(spark: SparkSession, d: str) -> DataFrame:
    """A3: id matches as % of global listings, coordinate matches as % of id matches."""
    m = _matched(spark, d)
    near = F.sqrt(F.pow(F.col("latitude") - F.col("lat_glob"), 2)
                  + F.pow(F.col("longitude") - F.col("long_glob"), 2)) < F.lit(C.COORD_TOLERANCE)
    a = m.agg(F.count(F.lit(1)).alias("id_matches"), F.count_if(near).alias("coord_matches"))
    g = C.global_silver_all(spark, d).agg(F.count(F.lit(1)).alias("global_rows"))
    j = a.unionByName(g, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("id_matches", "coord_matches", "global_rows")])
    return r6(j.withColumns({
        "id_match_pct": F.try_divide(F.col("id_matches") * 100.0, F.col("global_rows")),
        "coord_match_pct": F.try_divide(F.col("coord_matches") * 100.0, F.col("id_matches"))}))


def price_diffs(spark: SparkSession, d: str) -> DataFrame:
    """difference, % difference and log10 difference per matched item."""
    s = _study(spark, d)
    return r6(s.select("id", "price_diff",
                       fc.pct_diff("price_global", "price_local").alias("pct_diff"),
                       (fc.log10p1("price_global") - fc.log10p1("price_local")).alias("log_diff")))


QUERIES = {
    "match_rates": match_rates,
    "price_diffs": price_diffs,
    "latest_per_key": latest_per_key,
    "price_parse": price_parse,
    "valid_price_log": valid_price_log,
    "split_test": split_test,
    "split_local_train": split_local_train,
    "split_global_train": split_global_train,
    "leak_count": leak_count,
    "split_summary": split_summary,
    "id_match": id_match,
    "coord_match": coord_match,
    "unmatched": unmatched,
    "quality_audit": quality_audit,
    "valid_crosstab": valid_crosstab,
    "missing_strategy": missing_strategy,
    "coalesced_price": coalesced_price,
    "price_diff_stats": price_diff_stats,
    "sign_counts": sign_counts,
}

# ------------------------------------------------------------------ DuckDB oracle

_R2 = lambda e: C.sql_round_half_up(e, 2)

_SUMMARY_SELECT = f"""
    count(v) AS count, {_R2('min(v)')} AS min, {_R2('quantile_cont(v, 0.25)')} AS q1,
    {_R2('quantile_cont(v, 0.5)')} AS median, {_R2('avg(v)')} AS mean,
    {_R2('quantile_cont(v, 0.75)')} AS q3, {_R2('max(v)')} AS max,
    {_R2('stddev_samp(v)')} AS std"""

_MATCHED = """
    SELECT l.id, l.latitude, l.longitude, l.price_usd AS price,
           g.lat AS lat_glob, g.long AS long_glob, g.price AS price_glob
    FROM local_silver l JOIN global_silver_all g ON l.id = g.id"""

_PAIR_RAW = f"""
    SELECT l.id, l.p AS price, g.price AS price_glob
    FROM (SELECT id, {C.SQL_PARSE} AS p FROM local_fresh) l
    JOIN global_raw g ON l.id = g.property_id"""

_STUDY = f"""
    SELECT *, price_global - price_local AS price_diff FROM two_source
    WHERE price_local > {PRICE_FILTER_LO}::DOUBLE AND price_local < {PRICE_FILTER_HI}::DOUBLE
      AND price_global > {PRICE_FILTER_LO}::DOUBLE AND price_global < {PRICE_FILTER_HI}::DOUBLE"""


def _valid(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} > 0)"


def _invalid(c: str) -> str:
    return f"({c} IS NULL OR {c} <= 0)"


ORACLE = {
    "match_rates": sql_with(f"""
        SELECT id_matches, coord_matches, global_rows,
               round(id_matches * 100.0 / global_rows, 6) AS id_match_pct,
               round(coord_matches * 100.0 / id_matches, 6) AS coord_match_pct
        FROM (SELECT count(*) AS id_matches,
                     count_if(sqrt(pow(latitude - lat_glob, 2) + pow(longitude - long_glob, 2))
                              < {C.COORD_TOLERANCE}::DOUBLE) AS coord_matches,
                     (SELECT count(*) FROM global_silver_all) AS global_rows
              FROM ({_MATCHED}))""", "global_silver_all", "local_raw", "global_raw"),
    "price_diffs": fx.with_ctes(f"""
        SELECT id, round(price_diff, 6) AS price_diff,
               round((price_global - price_local) / price_local * 100, 6) AS pct_diff,
               round(log10(price_global + 1) - log10(price_local + 1), 6) AS log_diff
        FROM ({_STUDY})""", "two_source"),
    "latest_per_key": sql_with("SELECT id, row_key, last_scraped, price FROM local_fresh",
                               "local_fresh", "local_raw"),
    "price_parse": sql_with(f"SELECT id, price AS raw_price_str, {C.SQL_PARSE} AS price_usd "
                            "FROM local_fresh", "local_fresh", "local_raw"),
    "valid_price_log": sql_with("SELECT id, round(price_usd, 6) AS price_usd, "
                                "round(log_price, 6) AS log_price FROM local_silver",
                                "local_silver", "local_raw"),
    "split_test": sql_with("SELECT id, round(price_usd, 6) AS price_usd, "
                           "round(log_price, 6) AS log_price FROM test_set", "test_set",
                           "local_raw", "global_raw"),
    "split_local_train": sql_with("SELECT id, round(price_usd, 6) AS price_usd, "
                                  "round(log_price, 6) AS log_price FROM local_train",
                                  "local_train", "local_raw", "global_raw"),
    "split_global_train": sql_with("SELECT id, round(price, 6) AS price, "
                                   "round(log_price, 6) AS log_price FROM global_train",
                                   "global_train", "local_raw", "global_raw"),
    "leak_count": sql_with("""
        SELECT 'local_train' AS set_name, count(*) AS leaked_rows FROM local_train
          WHERE id IN (SELECT id FROM test_set)
        UNION ALL
        SELECT 'global_train', count(*) FROM global_train
          WHERE id IN (SELECT id FROM test_set)""", "global_train", "local_raw", "global_raw"),
    "split_summary": sql_with(f"""
        SELECT split_name, {_SUMMARY_SELECT} FROM (
          SELECT 'test' AS split_name, price_usd AS v FROM test_set
          UNION ALL SELECT 'local_train', price_usd FROM local_train
          UNION ALL SELECT 'global_train', price FROM global_train) GROUP BY split_name""",
                              "global_train", "local_raw", "global_raw"),
    "id_match": sql_with(f"""
        SELECT id, round(price, 6) AS price, round(price_glob, 6) AS price_glob,
               round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
               round(lat_glob, 6) AS lat_glob, round(long_glob, 6) AS long_glob
        FROM ({_MATCHED})""", "global_silver_all", "local_raw", "global_raw"),
    "coord_match": sql_with(f"""
        SELECT id, round(price, 6) AS price, round(price_glob, 6) AS price_glob,
               round(coord_dist, 6) AS coord_dist FROM (
          SELECT *, sqrt(pow(latitude - lat_glob, 2) + pow(longitude - long_glob, 2))
                    AS coord_dist FROM ({_MATCHED}))
        WHERE coord_dist < {C.COORD_TOLERANCE}::DOUBLE""",
                            "global_silver_all", "local_raw", "global_raw"),
    "unmatched": sql_with("SELECT id FROM global_silver_all EXCEPT SELECT id FROM local_silver",
                          "global_silver_all", "local_raw", "global_raw"),
    "quality_audit": sql_with(f"""
        SELECT count(*) AS total,
          count_if(price IS NULL) AS a_null, count_if(price = 0) AS a_zero,
          count_if({_valid('price')}) AS a_valid,
          count_if(price_glob IS NULL) AS b_null, count_if(price_glob = 0) AS b_zero,
          count_if({_valid('price_glob')}) AS b_valid,
          count_if({_valid('price')} AND {_valid('price_glob')}) AS both_valid,
          count_if({_valid('price')} AND {_invalid('price_glob')}) AS a_only_valid,
          count_if({_invalid('price')} AND {_valid('price_glob')}) AS b_only_valid,
          count_if({_invalid('price')} AND {_invalid('price_glob')}) AS both_invalid
        FROM ({_PAIR_RAW})""", "local_fresh", "local_raw", "global_raw"),
    "valid_crosstab": sql_with(f"""
        SELECT coalesce({_valid('price')}, false) AS a_valid,
               coalesce({_valid('price_glob')}, false) AS b_valid, count(*) AS n
        FROM ({_PAIR_RAW}) GROUP BY ALL""", "local_fresh", "local_raw", "global_raw"),
    "missing_strategy": sql_with("""
        SELECT total, strategy, remaining, total - remaining AS dropped,
               round((total - remaining) * 100.0 / total, 6) AS pct_dropped FROM (
          SELECT total, 'drop_any_invalid' AS strategy, drop_any_invalid AS remaining FROM ms_agg
          UNION ALL SELECT total, 'coalesce_first_positive', coalesce_first_positive FROM ms_agg
          UNION ALL SELECT total, 'keep_separate_a', keep_separate_a FROM ms_agg
          UNION ALL SELECT total, 'keep_separate_b', keep_separate_b FROM ms_agg)""",
                                 "local_fresh", "local_raw", "global_raw", extra=(("ms_agg", f"""
        SELECT count(*) AS total,
               count_if({_valid('price')} AND {_valid('price_glob')}) AS drop_any_invalid,
               count_if(coalesce(CASE WHEN price > 0 THEN price END,
                                 CASE WHEN price_glob > 0 THEN price_glob END) IS NOT NULL)
                 AS coalesce_first_positive,
               count_if({_valid('price')}) AS keep_separate_a,
               count_if({_valid('price_glob')}) AS keep_separate_b
        FROM ({_PAIR_RAW})"""),)),
    "coalesced_price": sql_with(f"""
        SELECT id, round(coalesce(CASE WHEN price > 0 THEN price END,
                                  CASE WHEN price_glob > 0 THEN price_glob END), 6) AS price
        FROM ({_PAIR_RAW})""", "local_fresh", "local_raw", "global_raw"),
    "price_diff_stats": fx.with_ctes(f"SELECT {_SUMMARY_SELECT} FROM "
                                     f"(SELECT price_diff AS v FROM ({_STUDY}))", "two_source"),
    "sign_counts": fx.with_ctes(f"""
        SELECT sign, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct FROM (
          SELECT CASE WHEN price_diff > 0 THEN 'positive' WHEN price_diff < 0 THEN 'negative'
                      ELSE 'zero' END AS sign, count(*) AS n
          FROM ({_STUDY}) WHERE price_diff IS NOT NULL GROUP BY 1)""", "two_source"),
}
