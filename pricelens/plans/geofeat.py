"""Registered queries: geographic features and the statistics run on them (steps 3 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import label_from_name, strength_class
from ..operators import features, geo, quality, split, stats
from ..sources import fixtures as fx
from . import common as C
from .common import round_doubles as r6

TOP_K = 5


def site_distances(spark: SparkSession, d: str) -> DataFrame:
    pts = fx.points(spark, d)
    out = geo.site_distances(pts, fx.sites(spark, d), exclude=[C.EXCLUDED_SITE])
    return r6(out.select("id", *C.site_cols()))


def nearest_station(spark: SparkSession, d: str) -> DataFrame:
    nn = geo.nearest_neighbour(fx.points(spark, d), fx.stations(spark, d),
                               s_keep=["station_name"], out_dist="dist_km")
    return r6(nn)


def near_flags(spark: SparkSession, d: str) -> DataFrame:
    return C.flagged(spark, d).select("id", "near_site", "sites_nearby", "far_from_metro")


def sites_nearby(spark: SparkSession, d: str) -> DataFrame:
    """Value counts of the number of sites within 1 km, with share."""
    return r6(stats.value_counts(C.flagged(spark, d), "sites_nearby"))


def geo_gate(spark: SparkSession, d: str) -> DataFrame:
    """Missing distance values per column (the gate raises on any)."""
    cols = C.site_cols() + ["dist_nearest_metro"]
    return quality.missing_gate(C.geo_features(spark, d), cols)


def range_two_sets(spark: SparkSession, d: str) -> DataFrame:
    """Min / max of every distance column across the train and test slices."""
    f = C.geo_features(spark, d)
    test, train = split.hash_split(f, "id", C.TEST_PCT, C.SEED)
    return r6(stats.range_two_sets(train, test, C.site_cols() + ["dist_nearest_metro"]))


def coord_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Largest coordinate disagreement between the two sources for matched keys."""
    local = C.local_silver(spark, d).select("id", "latitude", "longitude")
    glob = C.global_silver_all(spark, d).select("id", "lat", "long")
    j = local.join(glob, "id")
    return r6(j.agg(F.max(F.abs(F.col("latitude") - F.col("lat"))).alias("max_abs_lat_diff"),
                    F.max(F.abs(F.col("longitude") - F.col("long"))).alias("max_abs_lon_diff")))


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Nearest-station coverage: min / mean / median / max km and % within 500 m."""
    f = C.geo_features(spark, d)
    base = geo.coverage(f, "dist_nearest_metro", C.FAR_KM)
    med = stats.quantiles_wide(f, "dist_nearest_metro", {"median_km": 0.5})
    return r6(stats._join_by(base, med, []))


def corr_target(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of every distance column with log price, one aggregate pass (A10)."""
    f = C.geo_features(spark, d)
    return r6(stats.corr_with_target(f, C.site_cols() + ["dist_nearest_metro"], "log_price"))


def feature_rank(spark: SparkSession, d: str) -> DataFrame:
    """Distance features ranked by |corr| with strength class and display label
    (G4, F15, F16); the candidates are picked by their ``dist_`` name prefix (P7)."""
    f = C.geo_features(spark, d)
    c = stats.corr_with_target(f, features.columns_with_prefix(f, "dist_"), "log_price")
    return r6(c.select("feature", "corr", F.abs("corr").alias("abs_corr"),
                       strength_class("corr").alias("strength"),
                       label_from_name(F.col("feature")).alias("label")))


def topk_corr(spark: SparkSession, d: str) -> DataFrame:
    """The 5 highest and 5 lowest correlations (T2), tie-broken on the feature name."""
    c = stats.corr_with_target(C.geo_features(spark, d),
                               C.site_cols() + ["dist_nearest_metro"], "log_price")
    hi = stats.top_k(c, [F.col("corr").desc(), F.col("feature")], TOP_K) \
        .withColumn("end", F.lit("highest"))
    lo = stats.top_k(c, [F.col("corr").asc(), F.col("feature")], TOP_K) \
        .withColumn("end", F.lit("lowest"))
    return r6(hi.unionByName(lo))


def describe_cols(spark: SparkSession, d: str) -> DataFrame:
    f = C.geo_features(spark, d)
    return r6(stats.describe_cols(f, ["dist_nearest_metro", "log_price", "lat", "lon"]))


def group_mean_std(spark: SparkSession, d: str) -> DataFrame:
    """Mean and std of log price per number of nearby sites (A12 / D12 error bars)."""
    return r6(stats.group_mean_std(C.flagged(spark, d), "sites_nearby", "log_price"))


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.value_counts(C.flagged(spark, d), "near_site"))


def group_premium(spark: SparkSession, d: str) -> DataFrame:
    """Mean log price near a site vs not, difference, % of mean, implied price ratio."""
    return r6(stats.group_premium(C.flagged(spark, d), "near_site", "log_price"))


def trend_direction(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.trend_direction(C.flagged(spark, d), "sites_nearby", "log_price"))


def trend_line(spark: SparkSession, d: str) -> DataFrame:
    """Least-squares trend of log price on nearest-station distance, 100 points."""
    return r6(stats.trend_line(C.geo_features(spark, d), "dist_nearest_metro", "log_price"))


def threshold_trial(spark: SparkSession, d: str) -> DataFrame:
    """Correlation with log price of the three flags and of the continuous minimum site
    distance; the candidate with the largest |corr| is marked chosen."""
    f = C.flagged(spark, d).withColumn("min_site_km", F.least(*[F.col(c) for c in C.site_cols()]))
    c = stats.corr_with_target(f, ["near_site", "sites_nearby", "far_from_metro", "min_site_km"],
                               "log_price")
    best = F.max_by("feature", F.abs("corr")).over(Window.partitionBy())  # 4 rows
    return r6(c.withColumn("chosen", F.col("feature") == best))


QUERIES = {
    "site_distances": site_distances,
    "nearest_station": nearest_station,
    "near_flags": near_flags,
    "sites_nearby": sites_nearby,
    "geo_gate": geo_gate,
    "range_two_sets": range_two_sets,
    "coord_consistency": coord_consistency,
    "coverage": coverage,
    "corr_target": corr_target,
    "feature_rank": feature_rank,
    "topk_corr": topk_corr,
    "describe_cols": describe_cols,
    "group_mean_std": group_mean_std,
    "value_counts": value_counts,
    "group_premium": group_premium,
    "trend_direction": trend_direction,
    "trend_line": trend_line,
    "threshold_trial": threshold_trial,
}

# ------------------------------------------------------------------ DuckDB oracle

_DIST_COLS = [f"dist_{s}" for s in C.SITE_IDS if s != C.EXCLUDED_SITE]
_ALL_DIST = _DIST_COLS + ["dist_nearest_metro"]


def _corr_rows(cols, src="geo_features", target="log_price") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN stddev_samp({c}) * stddev_samp({target}) > 0 "
        f"THEN corr({c}, {target}) END AS corr FROM {src}" for c in cols)


def _hav(a, b) -> str:
    return C.sql_haversine(f"{a}.lat", f"{a}.lon", f"{b}.lat", f"{b}.lon")


def _sql_long(cols, src) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS series, CAST({c} AS DOUBLE) AS value FROM {src}"
                              for c in cols)


_BUCKET = C.sql_bucket("id")

ORACLE = {
    "site_distances": C.geo_sql("SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in _DIST_COLS)
                                + " FROM geo_features"),
    "nearest_station": fx.with_ctes(f"""
        SELECT id, station_id, station_name, round(dist_km, 6) AS dist_km FROM (
          SELECT p.id, s.station_id, s.station_name, {_hav('p', 's')} AS dist_km,
                 row_number() OVER (PARTITION BY p.id ORDER BY {_hav('p', 's')}, s.station_id) rn
          FROM points p, stations s) WHERE rn = 1""", "points", "stations"),
    "near_flags": C.geo_sql("SELECT id, near_site, sites_nearby, far_from_metro FROM flagged"),
    "sites_nearby": C.geo_sql("""
        SELECT sites_nearby, n, round(n / sum(n) OVER (), 6) AS share FROM (
          SELECT sites_nearby, count(*) AS n FROM flagged GROUP BY 1)"""),
    "geo_gate": C.geo_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column, count_if({c} IS NULL OR isnan({c})) AS missing FROM geo_features"
        for c in _ALL_DIST)),
    "range_two_sets": C.geo_sql(f"""
        SELECT series AS column, round(min(value), 6) AS min, round(max(value), 6) AS max
        FROM ({_sql_long(_ALL_DIST, 'geo_features')}) GROUP BY 1"""),
    "coord_consistency": C.sql_with("""
        SELECT round(max(abs(l.latitude - g.lat)), 6) AS max_abs_lat_diff,
               round(max(abs(l.longitude - g.long)), 6) AS max_abs_lon_diff
        FROM local_silver l JOIN global_silver_all g ON l.id = g.id""",
        "global_silver_all", "local_raw", "global_raw"),
    "coverage": C.geo_sql(f"""
        SELECT round(min(dist_nearest_metro), 6) AS min_km,
               round(avg(dist_nearest_metro), 6) AS mean_km,
               round(max(dist_nearest_metro), 6) AS max_km,
               round(avg(CAST(dist_nearest_metro < {C.FAR_KM}::DOUBLE AS DOUBLE)) * 100, 6)
                 AS pct_within,
               round(quantile_cont(dist_nearest_metro, 0.5), 6) AS median_km
        FROM geo_features"""),
    "corr_target": C.geo_sql(f"SELECT feature, round(corr, 6) AS corr FROM ({_corr_rows(_ALL_DIST)})"),
    "feature_rank": C.geo_sql(f"""
        SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr,
               CASE WHEN abs(corr) > 0.20 THEN 'STRONG' WHEN abs(corr) > 0.10 THEN 'MODERATE'
                    ELSE 'WEAK' END AS strength,
               list_aggregate(list_transform(string_split(replace(regexp_replace(feature, '^dist_', ''),
                 '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS label
        FROM ({_corr_rows(_ALL_DIST)})"""),
    "topk_corr": C.geo_sql(f"""
        WITH c AS ({_corr_rows(_ALL_DIST)})
        SELECT * FROM (SELECT feature, round(corr, 6) AS corr, 'highest' AS "end" FROM c
                       ORDER BY corr DESC, feature LIMIT {TOP_K})
        UNION ALL
        SELECT * FROM (SELECT feature, round(corr, 6) AS corr, 'lowest' AS "end" FROM c
                       ORDER BY corr ASC, feature LIMIT {TOP_K})"""),
    "describe_cols": C.geo_sql(f"""
        SELECT series AS column, count(value) AS count, round(min(value), 6) AS min,
               round(quantile_cont(value, 0.25), 6) AS q1,
               round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean,
               round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max,
               round(stddev_samp(value), 6) AS std
        FROM ({_sql_long(['dist_nearest_metro', 'log_price', 'lat', 'lon'], 'geo_features')})
        GROUP BY 1"""),
    "group_mean_std": C.geo_sql("""
        SELECT sites_nearby, count(log_price) AS n, round(avg(log_price), 6) AS mean,
               round(stddev_samp(log_price), 6) AS std FROM flagged GROUP BY 1"""),
    "value_counts": C.geo_sql("""
        SELECT near_site, n, round(n / sum(n) OVER (), 6) AS share FROM (
          SELECT near_site, count(*) AS n FROM flagged GROUP BY 1)"""),
    "group_premium": C.geo_sql("""
        SELECT round(m1, 6) AS mean_flagged, round(m0, 6) AS mean_other,
               round(m1 - m0, 6) AS diff, round((m1 - m0) / m0 * 100, 6) AS pct_of_mean,
               round((exp(m1 - m0) - 1) * 100, 6) AS price_ratio_pct
        FROM (SELECT avg(CASE WHEN near_site = 1 THEN log_price END) AS m1,
                     avg(CASE WHEN near_site = 0 THEN log_price END) AS m0 FROM flagged)"""),
    "trend_direction": C.geo_sql("""
        SELECT round(first_mean, 6) AS first_mean, round(last_mean, 6) AS last_mean,
               CASE WHEN last_mean > first_mean THEN 'increasing'
                    WHEN last_mean < first_mean THEN 'decreasing' ELSE 'flat' END AS direction
        FROM (SELECT arg_min(mean, sites_nearby) AS first_mean,
                     arg_max(mean, sites_nearby) AS last_mean
              FROM (SELECT sites_nearby, avg(log_price) AS mean FROM flagged GROUP BY 1))"""),
    "trend_line": C.geo_sql("""
        WITH fit AS (SELECT regr_slope(log_price, dist_nearest_metro) AS slope,
                            regr_intercept(log_price, dist_nearest_metro) AS intercept,
                            corr(dist_nearest_metro, log_price) AS r,
                            min(dist_nearest_metro) AS lo, max(dist_nearest_metro) AS hi
                     FROM geo_features)
        SELECT CAST(i AS INTEGER) AS i, round(lo + (hi - lo) * i / 99.0, 6) AS x,
               round(intercept + slope * (lo + (hi - lo) * i / 99.0), 6) AS y_fit,
               round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r, 6) AS r
        FROM fit, range(0, 100) t(i)"""),
    "threshold_trial": C.geo_sql(f"""
        WITH f AS (SELECT *, least({', '.join(_DIST_COLS)}) AS min_site_km FROM flagged),
        c AS ({_corr_rows(['near_site', 'sites_nearby', 'far_from_metro', 'min_site_km'], 'f')})
        SELECT feature, round(corr, 6) AS corr,
               feature = (SELECT arg_max(feature, abs(corr)) FROM c) AS chosen FROM c"""),
}
