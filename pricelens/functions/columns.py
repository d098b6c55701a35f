"""Column expressions (JVM-side, whole-stage-codegen friendly; no Python UDFs)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EARTH_RADIUS_KM = 6371.0
EUR_TO_USD = 1.17
CURRENCY_JUNK_PATTERN = "[$,]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """NaN becomes null so that null-aware aggregates and ``least`` treat both alike."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def parse_currency(text, fx: float = EUR_TO_USD, digits: int = 3) -> Column:
    """'$1,234.50' -> round(1234.5 * fx, digits); blank or junk text -> null (never raises)."""
    stripped = F.regexp_replace(_c(text), CURRENCY_JUNK_PATTERN, "")
    return F.round(stripped.try_cast("double") * F.lit(float(fx)), digits)


def is_valid_price(x) -> Column:
    """Not null and strictly positive."""
    c = _c(x)
    return c.isNotNull() & (c > 0)


def log10p1(x) -> Column:
    return F.log10(_c(x) + F.lit(1.0))


def first_positive(a, b) -> Column:
    """First of two values that is > 0, else null."""
    a, b = _c(a), _c(b)
    return F.coalesce(F.when(a > 0, a), F.when(b > 0, b))


def pct_diff(a, b) -> Column:
    """(a - b) / b * 100; null when b is 0 (ANSI-safe)."""
    a, b = _c(a), _c(b)
    return F.try_divide(a - b, b) * F.lit(100.0)


def planar_distance(lat1, lon1, lat2, lon2) -> Column:
    """Euclidean distance in degrees."""
    return F.sqrt(F.pow(_c(lat1) - _c(lat2), 2) + F.pow(_c(lon1) - _c(lon2), 2))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km (atan2 form), inputs in degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(float(radius_km)) * F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def hash_bucket(key, seed: int = 42, buckets: int = 100, purpose: str = "") -> Column:
    """Deterministic bucket in [0, buckets) from md5(key || '|' || seed), or from
    md5(key || '|' || purpose || '|' || seed): buckets drawn for different purposes are
    independent, so a sample of one side of a split is a sample and not a piece of it.

    Independent of partitioning and of row order, and repeatable in any SQL engine
    that has md5 (first 8 hex digits read as an unsigned integer).
    """
    salt = f"|{purpose}|{seed}" if purpose else f"|{seed}"
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(salt)))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def hash_order_key(key, seed: int = 42) -> Column:
    """Deterministic pseudo-random sort key (full md5 hex) for exact-n samples."""
    return F.md5(F.concat(_c(key).cast("string"), F.lit(f"|{seed}")))


def flag_any_below(cols: Sequence[str], threshold: float) -> Column:
    """1 when the row-wise minimum of ``cols`` is strictly below ``threshold``.

    NaN is treated as missing (``least`` alone would rank NaN above every number).
    """
    return F.coalesce((F.least(*[nan_to_null(c) for c in cols]) < F.lit(threshold)).cast("int"),
                      F.lit(0))


def count_below(cols: Sequence[str], threshold: float) -> Column:
    """Row-wise count of columns strictly below ``threshold`` (missing counts as not below)."""
    terms = [F.coalesce((nan_to_null(c) < F.lit(threshold)).cast("int"), F.lit(0)) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def flag_above(x, threshold: float) -> Column:
    return F.coalesce((_c(x) > F.lit(threshold)).cast("int"), F.lit(0))


def safe_corr(x, y) -> Column:
    """Pearson correlation as an aggregate that returns null (instead of failing under
    ANSI mode) when either side has zero variance."""
    x, y = _c(x), _c(y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def clamp_at_zero(x) -> Column:
    return F.greatest(_c(x), F.lit(0.0))


def label_from_name(name, prefix: str = "dist_") -> Column:
    """'dist_eiffel_tower' -> 'Eiffel Tower'."""
    stripped = F.regexp_replace(_c(name), "^" + prefix, "")
    return F.initcap(F.regexp_replace(stripped, "_", " "))


def strength_class(r) -> Column:
    """Fixed thresholds: |r| > 0.20 STRONG, > 0.10 MODERATE, else WEAK."""
    a = F.abs(_c(r))
    return F.when(a > 0.20, "STRONG").when(a > 0.10, "MODERATE").otherwise("WEAK")


def similarity_class(mean_log10_diff) -> Column:
    """Fixed thresholds on |mean log10 difference|: < 0.05 very similar, < 0.1 moderately
    similar, else notable with the implied percentage (10^|d| - 1) * 100."""
    a = F.abs(_c(mean_log10_diff))
    return (F.when(a < 0.05, F.lit("very similar"))
            .when(a < 0.1, F.lit("moderately similar"))
            .otherwise(F.lit("notable")))


def skew_class(skew_a, skew_b) -> Column:
    """Fixed thresholds: either skew > 1 highly right-skewed, > 0.5 moderately, else symmetric."""
    a, b = _c(skew_a), _c(skew_b)
    return (F.when((a > 1) | (b > 1), F.lit("highly right-skewed"))
            .when((a > 0.5) | (b > 0.5), F.lit("moderately right-skewed"))
            .otherwise(F.lit("relatively symmetric")))


def map_values(x, mapping: dict) -> Column:
    """Replace values through a literal map, keeping unmapped values."""
    c = _c(x)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return c if expr is None else expr.otherwise(c)


# Fixed coefficients of the rational approximation to the inverse normal CDF (P. J. Acklam).
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00]
_P_LOW = 0.02425


def _poly(coefs, x: Column) -> Column:
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def inverse_normal_cdf(p) -> Column:
    """Standard normal quantile of p in (0, 1) as a column expression (|error| < 1.2e-9)."""
    p = _c(p)
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    q = p - F.lit(0.5)
    r = q * q
    low = _poly(_C, q_lo) / (_poly(_D, q_lo) * q_lo + F.lit(1.0))
    central = _poly(_A, r) * q / (_poly(_B, r) * r + F.lit(1.0))
    high = -_poly(_C, q_hi) / (_poly(_D, q_hi) * q_hi + F.lit(1.0))
    return (F.when(p < _P_LOW, low)
            .when(p <= 1 - _P_LOW, central)
            .otherwise(high))


def inverse_normal_py(p: float) -> float:
    """Same approximation on the driver, for tests."""
    if p < _P_LOW:
        q = math.sqrt(-2 * math.log(p))
        return _polyf(_C, q) / (_polyf(_D, q) * q + 1)
    if p <= 1 - _P_LOW:
        q = p - 0.5
        r = q * q
        return _polyf(_A, r) * q / (_polyf(_B, r) * r + 1)
    q = math.sqrt(-2 * math.log(1 - p))
    return -_polyf(_C, q) / (_polyf(_D, q) * q + 1)


def _polyf(coefs, x):
    out = coefs[0]
    for c in coefs[1:]:
        out = out * x + c
    return out
