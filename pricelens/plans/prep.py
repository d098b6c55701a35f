"""Registered queries: schema adaptation, hand features, sampling, metrics (steps 6-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, metrics, sampling, split
from ..operators.features import (GLOBAL_CATEGORICAL, GLOBAL_NUMERIC, LOCAL_LOCATION,
                                  LOCAL_TO_GLOBAL, SHARED_AMENITIES, amenity_column)
from ..sources import fixtures as fx
from . import common as C
from .common import round_doubles as r6
from .study import _SCORED, scored

SAMPLE_N = 500
SAMPLE_PCT, SAMPLE_CAP = 30, 200
SPLIT_PCT = 5
BLOCK_SIZE, BLOCKS_CHOSEN = 3, 4


def adapt_schema(spark: SparkSession, d: str) -> DataFrame:
    a = features.adapt_to_global(fx.local_gold(spark, d))
    return r6(a.select("id", *LOCAL_TO_GLOBAL.keys(), *LOCAL_LOCATION.keys()))


def clean_cast(spark: SparkSession, d: str) -> DataFrame:
    a = features.adapt_to_global(fx.local_gold(spark, d))
    return r6(features.clean_cast(a))


def amenity_count(spark: SparkSession, d: str) -> DataFrame:
    return features.amenity_features(fx.amenity_text(spark, d)).select("id", "amenities_count")


def amenity_flags(spark: SparkSession, d: str) -> DataFrame:
    f = features.amenity_features(fx.amenity_text(spark, d))
    return f.select("id", *[amenity_column(a) for a in SHARED_AMENITIES])


def exact_sample(spark: SparkSession, d: str) -> DataFrame:
    return r6(sampling.exact_sample(fx.points(spark, d), "id", SAMPLE_N, C.SEED))


def sample_cap(spark: SparkSession, d: str) -> DataFrame:
    return r6(sampling.sample_then_cap(fx.points(spark, d), "id", SAMPLE_PCT, SAMPLE_CAP, C.SEED))


def group_blocks(spark: SparkSession, d: str) -> DataFrame:
    return sampling.group_blocks(fx.points(spark, d), "grp", BLOCK_SIZE, C.SEED)


def block_sample(spark: SparkSession, d: str) -> DataFrame:
    s = sampling.block_sample(fx.points(spark, d), "grp", BLOCK_SIZE, BLOCKS_CHOSEN, C.SEED)
    return r6(s.select("id", "grp", "log_price"))


def error_metrics_log(spark: SparkSession, d: str) -> DataFrame:
    return r6(metrics.log_model_metrics(scored(spark, d), "log_price", "pred_log"))


def error_metrics_dollar(spark: SparkSession, d: str) -> DataFrame:
    return r6(metrics.dollar_metrics(scored(spark, d), "log_price", "pred_log", ["grp"]))


def split_sample(spark: SparkSession, d: str) -> DataFrame:
    """A 5 % sample of either side of the hold-out split (T5 on split input)."""
    test, train = split.hash_split(fx.points(spark, d), "id", C.TEST_PCT, C.SEED)
    parts = [sampling.fraction_sample(s, "id", SPLIT_PCT, C.SEED).select(
        F.lit(side).alias("side"), "id") for side, s in (("test", test), ("train", train))]
    return parts[0].unionByName(parts[1])


QUERIES = {
    "split_sample": split_sample,
    "adapt_schema": adapt_schema,
    "clean_cast": clean_cast,
    "amenity_count": amenity_count,
    "amenity_flags": amenity_flags,
    "exact_sample": exact_sample,
    "sample_cap": sample_cap,
    "group_blocks": group_blocks,
    "block_sample": block_sample,
    "error_metrics_log": error_metrics_log,
    "error_metrics_dollar": error_metrics_dollar,
}

# ------------------------------------------------------------------ DuckDB oracle


def _q(c: str) -> str:
    return f'"{c}"'


_ADAPTED = ("SELECT *, " + ", ".join(f"{src} AS {_q(dst)}" for dst, src in LOCAL_TO_GLOBAL.items())
            + ", " + ", ".join(f"'{v}' AS {k}" for k, v in LOCAL_LOCATION.items())
            + " FROM local_gold")



_DOUBLES = {"lat", "long", "num_baths", "ratings", "rating_Accuracy", "rating_Cleanliness",
            "rating_Check-in", "rating_Communication", "rating_Location", "rating_Value"}


def _cast(c: str) -> str:
    return f"{C.sql_round_half_up(f'TRY_CAST({_q(c)} AS DOUBLE)', 6)} AS {_q(c)}"


_MD5_KEY = "md5(CAST({k} AS VARCHAR) || '|42')"

ORACLE = {
    "split_sample": fx.with_ctes(f"""
        SELECT CASE WHEN {C.sql_bucket('id')} < {C.TEST_PCT} THEN 'test' ELSE 'train' END AS side, id
        FROM points WHERE {C.sql_bucket('id', purpose='sample')} < {SPLIT_PCT}""", "points"),
    "adapt_schema": fx.with_ctes(
        "SELECT id, " + ", ".join(f"{C.sql_round_half_up(_q(k), 6)} AS {_q(k)}" if k in _DOUBLES
                                  else _q(k) for k in LOCAL_TO_GLOBAL)
        + ", " + ", ".join(LOCAL_LOCATION) + " FROM adapted", "local_gold",
        extra=(("adapted", _ADAPTED),)),
    "clean_cast": fx.with_ctes(
        "SELECT " + ", ".join(_cast(c) for c in GLOBAL_NUMERIC) + ", "
        + ", ".join(f"coalesce(lower(CAST({c} AS VARCHAR)), 'other') AS {c}"
                    for c in GLOBAL_CATEGORICAL)
        + f", {C.sql_round_half_up('log_price', 6)} AS log_price, id FROM adapted", "local_gold",
        extra=(("adapted", _ADAPTED),)),
    "amenity_count": fx.with_ctes(
        "SELECT id, CAST(json_array_length(amenities) AS INTEGER) AS amenities_count "
        "FROM amenity_text",
        "amenity_text"),
    "amenity_flags": fx.with_ctes(
        "SELECT id, " + ", ".join(
            f"CAST(list_contains(CAST(amenities AS VARCHAR[]), '{a}') AS INTEGER) "
            f"AS {amenity_column(a)}" for a in SHARED_AMENITIES) + " FROM amenity_text",
        "amenity_text"),
    "exact_sample": fx.with_ctes(f"""
        SELECT id, grp, round(lat, 6) AS lat, round(lon, 6) AS lon,
               round(log_price, 6) AS log_price
        FROM points ORDER BY {_MD5_KEY.format(k='id')}, id LIMIT {SAMPLE_N}""", "points"),
    "sample_cap": fx.with_ctes(f"""
        SELECT id, grp, round(lat, 6) AS lat, round(lon, 6) AS lon,
               round(log_price, 6) AS log_price
        FROM points WHERE {C.sql_bucket('id', purpose='sample')} < {SAMPLE_PCT}
        ORDER BY {_MD5_KEY.format(k='id')}, id LIMIT {SAMPLE_CAP}""", "points"),
    "group_blocks": fx.with_ctes(f"""
        SELECT grp, position, CAST(floor(position / {BLOCK_SIZE}) AS INTEGER) AS block FROM (
          SELECT grp, CAST(row_number() OVER (ORDER BY {_MD5_KEY.format(k='grp')}, grp) - 1
                           AS INTEGER) AS position
          FROM (SELECT DISTINCT grp FROM points WHERE grp IS NOT NULL))""", "points"),
    "block_sample": fx.with_ctes(f"""
        WITH b AS (SELECT grp, CAST(floor((row_number() OVER (
                     ORDER BY {_MD5_KEY.format(k='grp')}, grp) - 1) / {BLOCK_SIZE}) AS INTEGER)
                     AS block
                   FROM (SELECT DISTINCT grp FROM points WHERE grp IS NOT NULL)),
        chosen AS (SELECT block FROM (SELECT DISTINCT block FROM b)
                   ORDER BY {_MD5_KEY.format(k='block')}, block LIMIT {BLOCKS_CHOSEN})
        SELECT id, grp, round(log_price, 6) AS log_price FROM points
        WHERE grp IN (SELECT grp FROM b WHERE block IN (SELECT block FROM chosen))""",
                                 "points"),
    "error_metrics_log": fx.with_ctes("""
        SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae,
               round(avg(CASE WHEN y <> 0 THEN abs(y - p) / abs(y) END) * 100, 6) AS mape_pct,
               round(sqrt(avg(pow(y - p, 2))), 6) AS rmse,
               round(1 - sum(pow(log_price - pred_log, 2)) / (count(*) * var_pop(log_price)), 6)
                 AS r2_log,
               round(quantile_cont(abs(y - p), 0.5), 6) AS medae
        FROM (SELECT *, exp(log_price) - 1 AS y, exp(pred_log) - 1 AS p FROM scored)""",
                                      "points", extra=(("scored", _SCORED),)),
    "error_metrics_dollar": fx.with_ctes("""
        SELECT grp, count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS dollar_rmse,
               round(avg(abs(y - p)), 6) AS dollar_mae,
               round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS dollar_r2,
               round(avg(CASE WHEN y > 0 THEN abs(y - p) / y END), 6) AS dollar_mape
        FROM (SELECT grp, exp(log_price) - 1 AS y, greatest(exp(pred_log) - 1, 0) AS p
              FROM scored) GROUP BY grp""", "points", extra=(("scored", _SCORED),)),
}
