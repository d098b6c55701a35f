"""Registered queries: chart-series extras."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dist, geo, sampling, stats
from ..sources import fixtures as fx
from ..sources import io
from . import common as C
from .common import round_doubles as r6

SCATTER_PCT, SCATTER_CAP = 50, 300
BBOX_LAT, BBOX_LON = (48.82, 48.90), (2.23, 2.47)  # fixed plot window of the map


def kde_2d(spark: SparkSession, d: str) -> DataFrame:
    """2-D density of listing locations at each listing (binned, bounded work)."""
    return r6(dist.kde_2d_binned(fx.points(spark, d), "lon", "lat", "id"))


def scatter_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two-price scatter sample: 50 % hash sample capped at 300 rows."""
    s = C.study(spark, d)
    return r6(sampling.sample_then_cap(s, "id", SCATTER_PCT, SCATTER_CAP, C.SEED)
              .select("id", "price_local", "price_global"))


def scatter_limit(spark: SparkSession, d: str) -> DataFrame:
    """Axis limit for the y = x line over the whole study table."""
    return r6(dist.scatter_limit(C.study(spark, d), "price_local", "price_global"))


def color_range(spark: SparkSession, d: str) -> DataFrame:
    """5th and 95th percentile of log price for a colour scale."""
    return r6(stats.quantiles_wide(fx.points(spark, d), "log_price", {"p05": 0.05, "p95": 0.95}))


def bbox_points(spark: SparkSession, d: str) -> DataFrame:
    """Listings inside the fixed map window."""
    return r6(geo.bbox(fx.points(spark, d), "lat", "lon", BBOX_LAT, BBOX_LON))


def preview_latest(spark: SparkSession, d: str) -> DataFrame:
    """First 5 freshest listings by key (S10, stable order)."""
    return io.preview(C.local_fresh(spark, d).select("id", "row_key", "price"), 5, ["id"])


QUERIES = {
    "kde_2d": kde_2d,
    "scatter_sample": scatter_sample,
    "scatter_limit": scatter_limit,
    "color_range": color_range,
    "bbox_points": bbox_points,
    "preview_latest": preview_latest,
}

_STUDY = (("study", C.SQL_STUDY),)

ORACLE = {
    "kde_2d": fx.with_ctes("""
        WITH s AS (SELECT min(lon) AS x0, min(lat) AS y0, count(*) AS n,
                     var_samp(lon) * pow(count(*), -1.0 / 3) AS sxx,
                     var_samp(lat) * pow(count(*), -1.0 / 3) AS syy,
                     covar_samp(lon, lat) * pow(count(*), -1.0 / 3) AS sxy FROM points),
        b AS (SELECT id, CAST(floor((lon - x0) / sqrt(sxx) * 5) AS BIGINT) AS cx,
                CAST(floor(((lat - y0) - sxy / sxx * (lon - x0)) / sqrt((sxx * syy - sxy * sxy) / sxx) * 5) AS BIGINT)
                  AS cy FROM points, s),
        o AS (SELECT cx, cy, count(*) AS c FROM b GROUP BY cx, cy),
        d AS (SELECT t.cx, t.cy, sum(o.c * exp(-0.02 * (pow(t.cx - o.cx, 2) + pow(t.cy - o.cy, 2))))
                / (2 * pi() * sqrt(sxx * syy - sxy * sxy) * any_value(n)) AS density
              FROM o t JOIN o ON abs(t.cx - o.cx) <= 25 AND abs(t.cy - o.cy) <= 25, s
              GROUP BY t.cx, t.cy, sxx, syy, sxy)
        SELECT id, round(density, 6) AS density FROM b JOIN d USING (cx, cy)""", "points"),
    "scatter_sample": fx.with_ctes(f"""
        SELECT id, round(price_local, 6) AS price_local, round(price_global, 6) AS price_global
        FROM study WHERE {C.sql_bucket('id', purpose='sample')} < {SCATTER_PCT}
        ORDER BY md5(CAST(id AS VARCHAR) || '|42'), id LIMIT {SCATTER_CAP}""", "two_source",
                                   extra=_STUDY),
    "scatter_limit": fx.with_ctes(
        "SELECT round(max(greatest(price_local, price_global)), 6) AS axis_max FROM study",
        "two_source", extra=_STUDY),
    "color_range": fx.with_ctes("""
        SELECT round(quantile_cont(log_price, 0.05), 6) AS p05,
               round(quantile_cont(log_price, 0.95), 6) AS p95 FROM points""", "points"),
    "bbox_points": fx.with_ctes(f"""
        SELECT id, grp, round(lat, 6) AS lat, round(lon, 6) AS lon,
               round(log_price, 6) AS log_price FROM points
        WHERE lat BETWEEN {BBOX_LAT[0]}::DOUBLE AND {BBOX_LAT[1]}::DOUBLE
          AND lon BETWEEN {BBOX_LON[0]}::DOUBLE AND {BBOX_LON[1]}::DOUBLE""", "points"),
    "preview_latest": C.sql_with("SELECT id, row_key, price FROM local_fresh ORDER BY id LIMIT 5",
                                 "local_fresh", "local_raw"),
}
