"""Registered queries: price-study statistics and distribution series (build steps 3-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import similarity_class, skew_class
from ..functions import columns as fcol
from ..operators import dist, sampling, stats
from ..sources import fixtures as fx
from . import common as C
from .common import round_doubles as r6

BINS = 50
KDE_POINTS = 100
QQ_POINTS = 99
RESIDUAL_PCT, RESIDUAL_CAP = 25, 400


def moment_table(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.moment_table(C.study(spark, d), C.study_series()))


def iqr(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.iqr(C.study(spark, d), "price_diff"))


def corr_pair(spark: SparkSession, d: str) -> DataFrame:
    return r6(stats.corr_pair(C.study(spark, d), "price_local", "price_global"))


def study_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Mean log10 difference with its similarity class, both skews with the skew class,
    share of higher / lower / equal prices (F17, F18, A6)."""
    s = C.study(spark, d)
    m = s.agg(
        F.avg(F.log10(F.col("price_global") + 1) - F.log10(F.col("price_local") + 1))
        .alias("mean_log10_diff"),
        F.skewness("price_local").alias("_g1a"), F.skewness("price_global").alias("_g1b"),
        F.count(F.lit(1)).alias("n"),
        (F.avg((F.col("price_diff") > 0).cast("double")) * 100).alias("pct_global_higher"),
        (F.avg((F.col("price_diff") < 0).cast("double")) * 100).alias("pct_local_higher"))
    n = F.col("n").cast("double")
    corr = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    m = (m.withColumn("skew_local", F.col("_g1a") * corr)
          .withColumn("skew_global", F.col("_g1b") * corr)
          .withColumn("similarity", similarity_class("mean_log10_diff"))
          .withColumn("implied_pct_diff", (F.pow(F.lit(10.0), F.abs("mean_log10_diff")) - 1) * 100)
          .withColumn("skew_verdict", skew_class("skew_local", "skew_global")))
    return r6(m.drop("_g1a", "_g1b"))


def histogram(spark: SparkSession, d: str) -> DataFrame:
    s = C.study(spark, d)
    return r6(dist.histogram(s, {"price_local": "price_local", "price_global": "price_global"},
                             BINS))


def histogram_density(spark: SparkSession, d: str) -> DataFrame:
    s = C.study(spark, d)
    ss = C.study_series()
    series = {"log_local": ss["log_local"], "log_global": ss["log_global"]}
    return r6(dist.histogram(s, series, BINS, density=True))


def kde_1d(spark: SparkSession, d: str) -> DataFrame:
    s = C.study(spark, d)
    ss = C.study_series()
    series = {"log_local": ss["log_local"], "log_global": ss["log_global"]}
    return r6(dist.kde_1d(s, series, KDE_POINTS).withColumn("density", F.col("density") * 1e3)
              .withColumnRenamed("density", "density_x1000"))


def box_stats(spark: SparkSession, d: str) -> DataFrame:
    s = C.study(spark, d)
    return r6(dist.box_stats(s, {"price_local": "price_local", "price_global": "price_global",
                                 "price_diff": "price_diff"}))


def qq_series(spark: SparkSession, d: str) -> DataFrame:
    return r6(dist.qq_series(C.study(spark, d), "price_diff", QQ_POINTS))


def residual_series(spark: SparkSession, d: str) -> DataFrame:
    """Residual summary of a scored table (actual - predicted, dollars and log): A5 stats."""
    r = dist.residuals(scored(spark, d), "price", "pred_price")
    return stats.summary_stats(r, "residual", digits=2)


def log_residual_series(spark: SparkSession, d: str) -> DataFrame:
    """Summary of the log residuals of the scored table."""
    r = dist.residuals(scored(spark, d), "price", "pred_price")
    return stats.summary_stats(r, "log_residual", digits=2)


def residual_qq(spark: SparkSession, d: str) -> DataFrame:
    """Normal Q-Q series of the residuals."""
    r = dist.residuals(scored(spark, d), "price", "pred_price")
    return r6(dist.qq_series(r, "residual", QQ_POINTS))


def residual_vs_predicted(spark: SparkSession, d: str) -> DataFrame:
    """Residual against prediction, a hash sample of the scored table."""
    r = dist.residuals(scored(spark, d), "price", "pred_price")
    return r6(sampling.sample_then_cap(r, "id", RESIDUAL_PCT, RESIDUAL_CAP, C.SEED).select(
        "id", "pred_price", "residual", "log_residual"))


def residual_histogram(spark: SparkSession, d: str) -> DataFrame:
    sc = scored(spark, d)
    r = dist.residuals(sc, "price", "pred_price")
    return r6(dist.histogram(r, {"residual": "residual"}, BINS))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic pseudo-prediction next to a true price (stands in for model output):
    pred_log = 0.9 * log_price + 0.5 + ((id * 7919) % 101 - 50) * 0.004."""
    p = fx.points(spark, d)
    pred_log = (F.col("log_price") * 0.9 + 0.5
                + (F.pmod(F.col("id") * 7919, F.lit(101)) - 50) * F.lit(0.004))
    return p.select("id", "grp", "log_price", pred_log.alias("pred_log"),
                    F.expm1("log_price").alias("price"), F.expm1(pred_log).alias("pred_price"))


QUERIES = {
    "moment_table": moment_table,
    "iqr": iqr,
    "corr_pair": corr_pair,
    "study_verdict": study_verdict,
    "histogram": histogram,
    "histogram_density": histogram_density,
    "kde_1d": kde_1d,
    "box_stats": box_stats,
    "qq_series": qq_series,
    "residual_series": residual_series,
    "residual_histogram": residual_histogram,
    "log_residual_series": log_residual_series,
    "residual_qq": residual_qq,
    "residual_vs_predicted": residual_vs_predicted,
}

# ------------------------------------------------------------------ DuckDB oracle

_R2 = lambda e: C.sql_round_half_up(e, 2)


def _sql_long(series: dict) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS series, CAST({v} AS DOUBLE) AS value FROM study"
                              for k, v in series.items())


def _study_sql(body: str, extra=()) -> str:
    return fx.with_ctes(body, "two_source", extra=(("study", C.SQL_STUDY),) + tuple(extra))


def _sql_histogram(long_sql: str, density: bool) -> str:
    dens = (", round(CASE WHEN n * width = 0 THEN NULL ELSE count / (n * width) END, 6) "
            "AS density") if density else ""
    return f"""
    WITH lf AS ({long_sql}),
    e AS (SELECT series, min(value) AS lo, max(value) AS hi, count(*) AS n FROM lf GROUP BY 1),
    b AS (SELECT lf.series, least(CAST(CASE WHEN (e.hi - e.lo) / {float(BINS)} > 0
                 THEN floor((value - e.lo) / ((e.hi - e.lo) / {float(BINS)})) ELSE 0 END AS INTEGER),
                 {BINS - 1}) AS bin
          FROM lf JOIN e USING (series)),
    c AS (SELECT series, bin, count(*) AS count FROM b GROUP BY ALL),
    g AS (SELECT e.*, CAST(i AS INTEGER) AS bin, (hi - lo) / {float(BINS)} AS width
          FROM e, range(0, {BINS}) t(i))
    SELECT g.series, g.bin, round(lo + g.bin * width, 6) AS lo,
           round(lo + (g.bin + 1) * width, 6) AS hi, coalesce(c.count, 0) AS count{dens}
    FROM g LEFT JOIN c ON g.series = c.series AND g.bin = c.bin"""


def _sql_inverse_normal(p: str) -> str:
    def poly(coefs, x):
        out = f"{coefs[0]!r}"
        for c in coefs[1:]:
            out = f"(({out}) * {x} + {c!r})"
        return out
    A, B, Cc, D = fcol._A, fcol._B, fcol._C, fcol._D
    ql = f"sqrt(-2.0 * ln({p}))"
    qh = f"sqrt(-2.0 * ln(1.0 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    low = f"({poly(Cc, ql)}) / (({poly(D, ql)}) * {ql} + 1.0)"
    central = f"({poly(A, r)}) * {q} / (({poly(B, r)}) * {r} + 1.0)"
    high = f"-({poly(Cc, qh)}) / (({poly(D, qh)}) * {qh} + 1.0)"
    return (f"CASE WHEN {p} < {fcol._P_LOW!r} THEN {low} WHEN {p} <= {1 - fcol._P_LOW!r} "
            f"THEN {central} ELSE {high} END")


_LOG2 = {"log_local": C.SQL_STUDY_SERIES["log_local"], "log_global": C.SQL_STUDY_SERIES["log_global"]}

_SCORED = """
    SELECT id, grp, log_price, pred_log, exp(log_price) - 1 AS price, exp(pred_log) - 1 AS pred_price
    FROM (SELECT id, grp, log_price,
                 log_price * 0.9 + 0.5 + (((id * 7919) % 101) - 50) * 0.004::DOUBLE AS pred_log
          FROM points)"""

_QQ_PROBS = [k / (QQ_POINTS + 1) for k in range(1, QQ_POINTS + 1)]



def _sql_qq(value: str, table: str) -> str:
    return f"""
        WITH q AS (SELECT unnest({_QQ_PROBS!r}) AS prob,
                          unnest(quantile_cont({value}, {_QQ_PROBS!r})) AS sample_q FROM {table}),
        t AS (SELECT prob, sample_q, {_sql_inverse_normal('prob')} AS theoretical_q FROM q),
        fit AS (SELECT regr_slope(sample_q, theoretical_q) AS slope,
                       regr_intercept(sample_q, theoretical_q) AS intercept,
                       corr(sample_q, theoretical_q) AS r FROM t)
        SELECT round(CAST(prob AS DOUBLE), 6) AS prob, round(sample_q, 6) AS sample_q,
               round(theoretical_q, 6) AS theoretical_q, round(slope, 6) AS slope,
               round(intercept, 6) AS intercept, round(r, 6) AS r,
               round(intercept + slope * theoretical_q, 6) AS fit_q
        FROM t, fit"""


def _sql_summary(values: str) -> str:
    return f"""
        SELECT count(v) AS count, {_R2('min(v)')} AS min, {_R2('quantile_cont(v, 0.25)')} AS q1,
               {_R2('quantile_cont(v, 0.5)')} AS median, {_R2('avg(v)')} AS mean,
               {_R2('quantile_cont(v, 0.75)')} AS q3, {_R2('max(v)')} AS max,
               {_R2('stddev_samp(v)')} AS std
        FROM ({values})"""


ORACLE = {
    "moment_table": _study_sql(f"""
        SELECT series, count(value) AS count, round(avg(value), 6) AS mean,
               round(quantile_cont(value, 0.5), 6) AS median,
               round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
               round(quantile_cont(value, 0.25), 6) AS q1,
               round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max,
               round(skewness(value), 6) AS skew, round(kurtosis(value), 6) AS kurtosis
        FROM ({_sql_long(C.SQL_STUDY_SERIES)}) GROUP BY series"""),
    "iqr": _study_sql("""
        SELECT round(quantile_cont(price_diff, 0.25), 6) AS q1,
               round(quantile_cont(price_diff, 0.75), 6) AS q3,
               round(quantile_cont(price_diff, 0.75) - quantile_cont(price_diff, 0.25), 6) AS iqr
        FROM study"""),
    "corr_pair": _study_sql("""
        SELECT round(r_linear, 6) AS r_linear, round(r_log, 6) AS r_log,
               CASE WHEN abs(r_log) > abs(r_linear) THEN 'log' ELSE 'linear' END AS stronger
        FROM (SELECT corr(price_local, price_global) AS r_linear,
                     corr(log10(price_local + 1), log10(price_global + 1)) AS r_log FROM study)"""),
    "study_verdict": _study_sql("""
        SELECT round(mean_log10_diff, 6) AS mean_log10_diff, n,
               round(pct_global_higher, 6) AS pct_global_higher,
               round(pct_local_higher, 6) AS pct_local_higher,
               round(skew_local, 6) AS skew_local, round(skew_global, 6) AS skew_global,
               CASE WHEN abs(mean_log10_diff) < 0.05 THEN 'very similar'
                    WHEN abs(mean_log10_diff) < 0.1 THEN 'moderately similar'
                    ELSE 'notable' END AS similarity,
               round((pow(10.0, abs(mean_log10_diff)) - 1) * 100, 6) AS implied_pct_diff,
               CASE WHEN skew_local > 1 OR skew_global > 1 THEN 'highly right-skewed'
                    WHEN skew_local > 0.5 OR skew_global > 0.5 THEN 'moderately right-skewed'
                    ELSE 'relatively symmetric' END AS skew_verdict
        FROM (SELECT avg(log10(price_global + 1) - log10(price_local + 1)) AS mean_log10_diff,
                     count(*) AS n,
                     avg(CAST(price_diff > 0 AS DOUBLE)) * 100 AS pct_global_higher,
                     avg(CAST(price_diff < 0 AS DOUBLE)) * 100 AS pct_local_higher,
                     skewness(price_local) AS skew_local, skewness(price_global) AS skew_global
              FROM study)"""),
    "histogram": _study_sql(_sql_histogram(
        _sql_long({"price_local": "price_local", "price_global": "price_global"}), False)),
    "histogram_density": _study_sql(_sql_histogram(_sql_long(_LOG2), True)),
    "kde_1d": _study_sql(f"""
        WITH lf AS ({_sql_long(_LOG2)}),
        st AS (SELECT series, min(value) AS lo, max(value) AS hi, count(*) AS n,
                      stddev_samp(value) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h
               FROM lf GROUP BY 1),
        g AS (SELECT st.*, CAST(i AS INTEGER) AS i,
                     lo + (hi - lo) * i / {float(KDE_POINTS - 1)} AS x
              FROM st, range(0, {KDE_POINTS}) t(i))
        SELECT g.series, g.i, round(g.x, 6) AS x,
               round(sum(exp(-0.5 * ((g.x - lf.value) / g.h) * ((g.x - lf.value) / g.h)))
                     / (g.n * g.h * sqrt(2 * pi())) * 1000.0, 6) AS density_x1000
        FROM g JOIN lf ON g.series = lf.series GROUP BY g.series, g.i, g.x, g.n, g.h"""),
    "box_stats": _study_sql(f"""
        WITH lf AS ({_sql_long({"price_local": "price_local", "price_global": "price_global",
                                "price_diff": "price_diff"})}),
        q AS (SELECT series, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                     quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY 1),
        f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
                     q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
        SELECT f.series, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               round(iqr, 6) AS iqr, round(lower_fence, 6) AS lower_fence,
               round(upper_fence, 6) AS upper_fence,
               round(min(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END), 6)
                 AS whisker_low,
               round(max(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END), 6)
                 AS whisker_high,
               count_if(NOT (value BETWEEN lower_fence AND upper_fence)) AS outliers
        FROM f JOIN lf ON f.series = lf.series
        GROUP BY f.series, q1, median, q3, iqr, lower_fence, upper_fence"""),
    "qq_series": _study_sql(_sql_qq("price_diff", "study")),
    "residual_qq": fx.with_ctes(_sql_qq("price - pred_price", "scored"), "points",
                                extra=(("scored", _SCORED),)),
    "log_residual_series": fx.with_ctes(_sql_summary(
        "SELECT ln(1 + price) - ln(1 + pred_price) AS v FROM scored"), "points",
        extra=(("scored", _SCORED),)),
    "residual_vs_predicted": fx.with_ctes(f"""
        SELECT id, round(pred_price, 6) AS pred_price, round(price - pred_price, 6) AS residual,
               round(ln(1 + price) - ln(1 + pred_price), 6) AS log_residual
        FROM scored WHERE {C.sql_bucket('id', purpose='sample')} < {RESIDUAL_PCT}
        ORDER BY md5(CAST(id AS VARCHAR) || '|{C.SEED}'), id LIMIT {RESIDUAL_CAP}""", "points",
                                          extra=(("scored", _SCORED),)),
    "residual_series": fx.with_ctes(_sql_summary("SELECT price - pred_price AS v FROM scored"),
                                    "points", extra=(("scored", _SCORED),)),
    "residual_histogram": fx.with_ctes(_sql_histogram(
        "SELECT 'residual' AS series, price - pred_price AS value FROM scored", False),
        "points", extra=(("scored", _SCORED),)),
}
