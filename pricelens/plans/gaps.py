"""Registered queries: filters, whole-row set operations, gold selection, final features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import strength_class
from ..operators import clean, features, match, quality, stats
from ..operators.features import GOLD_COLUMNS
from ..sources import fixtures as fx
from . import common as C
from .common import round_doubles as r6
from .geofeat import _corr_rows

LOCATION_PATTERN, LOCATION_PREFIX = "^(auto|mach)", "BU"
MATRIX = ["log_price", "accommodates", "beds", "bedrooms", "latitude", "review_scores_rating"]
FLAGS = ["near_site", "sites_nearby", "far_from_metro"]
STANDARD = {"listing_id": ("id", "string"), "scraped": ("last_scraped", "date"),
            "price_number": ("price", "double"), "lat": ("latitude", "float")}


def standardised(spark: SparkSession, d: str) -> DataFrame:
    """Select, cast and rename; text that is no number becomes null."""
    return clean.standardise(fx.local_raw(spark, d), STANDARD).withColumn(
        "lat", F.round(F.col("lat").cast("double"), 4)).withColumn("scraped", F.col("scraped").cast("string"))


def location_regex(spark: SparkSession, d: str) -> DataFrame:
    """Case-folded pattern on the location."""
    return clean.regex_filter(fx.global_raw(spark, d), "location", LOCATION_PATTERN).select(
        "property_id", "location")


def location_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose location starts with a prefix."""
    return clean.prefix_filter(fx.global_raw(spark, d), "location", LOCATION_PREFIX).select(
        "property_id", "location")


def unmatched_rows(spark: SparkSession, d: str) -> DataFrame:
    """Whole global rows without an id match among the valid local listings."""
    glob = fx.global_raw(spark, d).withColumnRenamed("property_id", "id")
    return r6(match.unmatched_rows(glob, C.local_silver(spark, d), "id"))


def whole_row_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Distinct whole rows of the listing places, one per listing and place."""
    return r6(clean.dedup_rows(fx.local_raw(spark, d).select("id", "latitude", "longitude")))


def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """A10: full correlation matrix of listing features."""
    gold = fx.local_gold(spark, d)
    return r6(stats.corr_matrix(gold.select(*[F.col(c).cast("double") for c in MATRIX]), MATRIX))


def gold_columns(spark: SparkSession, d: str) -> DataFrame:
    """H5: the 26-column gold selection."""
    return r6(features.gold_select(fx.local_gold(spark, d).withColumn("unused", F.lit(1))))


def host_years(spark: SparkSession, d: str) -> DataFrame:
    """H4: start dates as calendar years, by year."""
    text = fx.local_raw(spark, d).select(F.date_format("last_scraped", "yyyy-MM-dd").alias("since"))
    return (text.select(features.host_year("since").alias("hosts_year")).groupBy("hosts_year")
            .agg(F.count(F.lit(1)).alias("n")))


def _selection(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Gated flags table and the correlations of its candidates with log price."""
    f = C.flagged(spark, d)
    features.require_columns(f, [*C.site_cols(), *FLAGS, "log_price"], "flagged table")
    quality.assert_no_missing(f, [*C.site_cols(), "log_price"])
    return f, stats.corr_with_target(f, [*C.site_cols(), *FLAGS], "log_price")


def threshold_choice(spark: SparkSession, d: str) -> DataFrame:
    """The largest |corr| of the site distance columns against that of the three flags
    decides whether the continuous or the binary form is kept."""
    _, corr = _selection(spark, d)
    kind = F.when(F.col("feature").isin(FLAGS), "binary").otherwise("continuous")
    best = corr.groupBy(kind.alias("form")).agg(F.max(F.abs("corr")).alias("max_abs_corr"),
                                                F.max_by("feature", F.abs("corr")).alias("feature"))
    top = F.max("max_abs_corr").over(Window.partitionBy())     # two rows
    return r6(best.withColumn("chosen", F.col("max_abs_corr") == top))


def final_selection(spark: SparkSession, d: str) -> DataFrame:
    """Rejected columns (flags, weak distances) dropped; the kept ones ranked."""
    _, corr = _selection(spark, d)
    kept = corr.where(~F.col("feature").isin(FLAGS)).withColumn("strength", strength_class("corr"))
    rank = F.row_number().over(Window.orderBy(F.abs("corr").desc(), "feature"))  # one row per site
    ranked = kept.withColumn("rank", rank)
    return r6(ranked.where((F.col("strength") != "WEAK") | (F.col("rank") <= 5)).select(
        "rank", "feature", "corr", "strength"))


def enriched_summary(spark: SparkSession, d: str) -> DataFrame:
    """Columns that the enrichment added, with missing count and mean of each."""
    f = C.flagged(spark, d)
    added = [c for c in f.columns if c not in fx.points(spark, d).columns
             and c not in ("station_id", "station_name")]
    cells = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing"),
                      F.avg(c).alias("mean")) for c in added]
    return r6(f.agg(F.array(*cells).alias("_a")).select(F.explode("_a").alias("_c")).select("_c.*"))


QUERIES = {q.__name__: q for q in (
    standardised, location_regex, location_prefix, unmatched_rows, whole_row_dedup, corr_matrix,
    gold_columns, host_years, threshold_choice, final_selection, enriched_summary)}

_SITES = C.site_cols()
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr "
    "FROM local_gold" for a in MATRIX for b in MATRIX)
_ADDED = [*_SITES, "dist_nearest_metro", *FLAGS]

ORACLE = {
    "standardised": fx.with_ctes("""
        SELECT CAST(id AS VARCHAR) AS listing_id, CAST(CAST(last_scraped AS DATE) AS VARCHAR) AS scraped,
               TRY_CAST(price AS DOUBLE) AS price_number, round(latitude, 4) AS lat
        FROM local_raw""", "local_raw"),
    "location_regex": fx.with_ctes(f"""
        SELECT property_id, location FROM global_raw
        WHERE regexp_matches(lower(location), '{LOCATION_PATTERN}')""", "global_raw"),
    "location_prefix": fx.with_ctes(f"""
        SELECT property_id, location FROM global_raw
        WHERE starts_with(location, '{LOCATION_PREFIX}')""", "global_raw"),
    "unmatched_rows": C.sql_with("""
        SELECT id, round(lat, 6) AS lat, round(long, 6) AS long, listing_title, round(price, 6) AS price,
               location
        FROM (SELECT DISTINCT property_id AS id, * EXCLUDE (property_id) FROM global_raw
              WHERE property_id NOT IN (SELECT id FROM local_silver))""",
                                 "local_silver", "global_raw", "local_raw"),
    "whole_row_dedup": fx.with_ctes("""
        SELECT DISTINCT id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
        FROM local_raw""", "local_raw"),
    "corr_matrix": fx.with_ctes(_PAIRS, "local_gold"),
    "host_years": fx.with_ctes("""
        SELECT CAST(year(last_scraped) AS DOUBLE) AS hosts_year, count(*) AS n
        FROM local_raw GROUP BY 1""", "local_raw"),
    "threshold_choice": C.geo_sql(f"""
        WITH c AS ({_corr_rows([*_SITES, *FLAGS], 'flagged')}),
        b AS (SELECT CASE WHEN feature IN ('near_site', 'sites_nearby', 'far_from_metro')
                     THEN 'binary' ELSE 'continuous' END AS form, max(abs(corr)) AS m,
                     arg_max(feature, abs(corr)) AS feature FROM c GROUP BY 1)
        SELECT form, round(m, 6) AS max_abs_corr, feature, m = max(m) OVER () AS chosen FROM b"""),
    "final_selection": C.geo_sql(f"""
        WITH c AS ({_corr_rows(_SITES, 'flagged')}),
        r AS (SELECT CAST(row_number() OVER (ORDER BY abs(corr) DESC, feature) AS INTEGER) AS rank,
                     feature, corr, CASE WHEN abs(corr) > 0.20 THEN 'STRONG'
                       WHEN abs(corr) > 0.10 THEN 'MODERATE' ELSE 'WEAK' END AS strength FROM c)
        SELECT rank, feature, round(corr, 6) AS corr, strength FROM r
        WHERE strength <> 'WEAK' OR rank <= 5"""),
    "enriched_summary": C.geo_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS missing, round(avg({c}), 6) AS mean "
        "FROM flagged" for c in _ADDED)),
    "gold_columns": fx.with_ctes("SELECT " + ", ".join(
        c if c in ("id", "neighbourhood_cleansed", "listing_type", "host_response_time",
                   "host_is_superhost", "accommodates", "beds", "bedrooms", "number_of_reviews",
                   "availability_365", "amenities_count", "has_dishwasher", "has_washer", "host_since")
        else f"round({c}, 6) AS {c}" for c in GOLD_COLUMNS) + " FROM local_gold", "local_gold"),
}
