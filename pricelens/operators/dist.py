"""Data series behind distribution charts.

All series are aggregates: each task folds its rows into at most (series x bins) or
(series x grid points) partial sums, so nothing proportional to the row count is
shuffled or gathered. Per-series constants (edges, bandwidth) are a small aggregate
joined back on the series key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import inverse_normal_cdf, nan_to_null
from ..session import checkpointed
from .select import Selection
from .stats import QUARTILES, exact_quantiles, long_form


def _series_frame(df: DataFrame, series: Mapping[str, str | Column] | None, value: str | None):
    if series is not None:
        return long_form(df, series).withColumn("value", nan_to_null(F.col("value"))) \
                                    .where(F.col("value").isNotNull())
    return df.select(F.lit(value).alias("series"), nan_to_null(F.col(value)).alias("value")) \
             .where(F.col("value").isNotNull())


def histogram(df: DataFrame, series: Mapping[str, str | Column], bins: int = 50,
              density: bool = False) -> DataFrame:
    """Equal-width histogram per series on its own [min, max]; the maximum falls into the
    last bin. Columns: series, bin, lo, hi, count (+ density = count / (n * width))."""
    lf = _series_frame(df, series, None)
    edges = lf.groupBy("series").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"),
                                     F.count(F.lit(1)).alias("_n"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    raw_bin = F.when(w > 0, F.floor((F.col("value") - F.col("_lo")) / w)).otherwise(F.lit(0))
    # one row per literal series name, so the input rows need not move for it
    b = lf.join(F.broadcast(edges), "series").withColumn("bin", F.least(raw_bin.cast("int"), F.lit(bins - 1)))
    counts = b.groupBy("series", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = edges.select("series", "_lo", "_hi", "_n",
                        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = (grid.join(counts, ["series", "bin"], "left")
           .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
           .withColumn("width", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
           .withColumn("lo", F.col("_lo") + F.col("bin") * F.col("width"))
           .withColumn("hi", F.col("_lo") + (F.col("bin") + 1) * F.col("width")))
    cols = ["series", "bin", "lo", "hi", "count"]
    if density:
        out = out.withColumn("density", F.try_divide(F.col("count"), F.col("_n") * F.col("width")))
        cols.append("density")
    return out.select(*cols)


CELLS_PER_WIDTH = 64  # tests bound the error of ``kde_1d`` by that of linear binning at this step


def kde_1d(df: DataFrame, series: Mapping[str, str | Column], points: int = 100) -> DataFrame:
    """Gaussian KDE per series on ``points`` evenly spaced grid points over [min, max],
    Scott bandwidth h = std * n^(-1/5) (sample std). Exact: every value contributes to
    every grid point; the explode is a fixed ``points`` per row and is folded by the
    partial aggregate inside the task."""
    lf = _series_frame(df, series, None)
    st = lf.groupBy("series").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"),
                                  F.count(F.lit(1)).alias("_n"),
                                  F.stddev_samp("value").alias("_sd"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    g = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    x = lf.join(F.broadcast(st), "series").select("series", "value", "_lo", "_hi", "_h", g)
    gx = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i") / F.lit(float(points - 1))
    z = F.try_divide(gx - F.col("value"), F.col("_h"))
    s = x.groupBy("series", "i").agg(F.sum(F.exp(F.lit(-0.5) * z * z)).alias("_s"))
    return (s.join(F.broadcast(st), "series")
            .select("series", "i",
                    (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i")
                     / F.lit(float(points - 1))).alias("x"),
                    F.try_divide(F.col("_s"), F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
                    .alias("density")))


def kde_2d_binned(df: DataFrame, x: str, y: str, key: str, per_width: int = 5,
                  widths: int = 5) -> DataFrame:
    """2-D Gaussian KDE density at each row (Scott factor n^(-1/6), sample covariance).

    Rows are turned by the Cholesky factor of the bandwidth matrix, so that the kernel is round
    and splits into one factor per axis, and counted on a grid whose cells are a
    ``per_width``-th of the bandwidth (the binning error stays the same as rows grow and the
    bandwidth shrinks). The density at a cell's centre is then two passes of
    2 * per_width * widths + 1 offsets, one along each axis, over occupied cells; what lies
    beyond ``widths`` bandwidths weighs under 4e-6. Each row gets its cell's density."""
    base = df.select(key, nan_to_null(F.col(x)).alias("_x"), nan_to_null(F.col(y)).alias("_y")) \
             .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    st = base.agg(F.min("_x").alias("x0"), F.min("_y").alias("y0"), F.count(F.lit(1)).alias("n"),
                  F.var_samp("_x").alias("vx"), F.var_samp("_y").alias("vy"),
                  F.covar_samp("_x", "_y").alias("cxy")).first()
    n = st["n"]
    sxx, syy, sxy = ((st[c] or 0.0) * max(n, 1) ** (-2.0 / 6.0) for c in ("vx", "vy", "cxy"))
    det = sxx * syy - sxy * sxy
    if not n or det <= 0:
        return base.select(key, F.lit(None).cast("double").alias("density"))
    dx, dy = F.col("_x") - F.lit(st["x0"]), F.col("_y") - F.lit(st["y0"])
    u = dx / F.lit(math.sqrt(sxx))
    v = (dy - F.lit(sxy / sxx) * dx) / F.lit(math.sqrt(det / sxx))
    binned = base.withColumn("a", F.floor(u * per_width)).withColumn("b", F.floor(v * per_width))
    cells = checkpointed(binned.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w")))
    reach = per_width * widths

    def along(axis: str, other: str, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """Weights spread along one axis, to the cells that are ``wanted``."""
        step = F.explode(F.sequence(F.lit(-reach).cast("long"), F.lit(reach).cast("long")))
        spread = rows.select(axis, other, "w", step.alias("o")).select(
            (F.col(axis) + F.col("o")).alias(axis), other,
            (F.col("w") * F.exp(F.lit(-0.5 / per_width ** 2) * F.col("o") * F.col("o"))).alias("w"))
        return spread.join(wanted, wanted.columns, "left_semi").groupBy("a", "b").agg(F.sum("w").alias("w"))

    dens = along("b", "a", along("a", "b", cells, cells.select("a").distinct()), cells.select("a", "b"))
    dens = dens.select("a", "b", (F.col("w") / F.lit(2 * math.pi * math.sqrt(det) * n)).alias("density"))
    return binned.select(key, "a", "b").join(dens, ["a", "b"]).select(key, "density")


def box_stats(df: DataFrame, series: Mapping[str, str | Column]) -> DataFrame:
    """Box-plot numbers per series: q1, median, q3, iqr, fences at 1.5 IQR, whiskers (most
    extreme values inside the fences), outlier count. The fences take a third pass."""
    lf = _series_frame(df, series, None)
    s = Selection(lf, "value", ["series"], QUARTILES.values())
    q = checkpointed(s.quantiles_wide(QUARTILES))  # one row per series
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr")))
    inside = (F.col("_v") >= F.col("lower_fence")) & (F.col("_v") <= F.col("upper_fence"))
    # the fence table has one row per literal series name
    agg = (s.rows.join(F.broadcast(q.select("series", "lower_fence", "upper_fence")), "series")
           .groupBy("series").agg(F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
                                  F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
                                  F.count_if(~inside).alias("outliers")))
    return q.join(agg, "series")


def qq_series(df: DataFrame, value: str, points: int = 99) -> DataFrame:
    """Normal Q-Q series on a fixed probability grid p_k = k / (points + 1): sample quantile
    (exact) against the standard normal quantile, plus the least-squares fit line."""
    probs = [k / (points + 1) for k in range(1, points + 1)]
    q = exact_quantiles(df, value, probs).withColumnRenamed("quantile", "sample_q")
    q = q.withColumn("theoretical_q", inverse_normal_cdf(F.col("prob")))
    whole = Window.partitionBy()  # the grid has ``points`` rows
    q = q.withColumns({
        "slope": F.regr_slope("sample_q", "theoretical_q").over(whole),
        "intercept": F.regr_intercept("sample_q", "theoretical_q").over(whole),
        "r": F.corr("sample_q", "theoretical_q").over(whole)})
    return q.withColumn("fit_q", F.col("intercept") + F.col("slope") * F.col("theoretical_q"))


def residuals(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """residual = actual - pred, log residual = log1p(actual) - log1p(pred)."""
    return df.withColumns({"residual": F.col(actual) - F.col(pred),
                           "log_residual": F.log1p(F.col(actual)) - F.log1p(F.col(pred))})


def scatter_limit(df: DataFrame, a: str, b: str) -> DataFrame:
    """Upper axis limit for a y = x reference line: max of both columns."""
    return df.agg(F.max(F.greatest(F.col(a), F.col(b))).alias("axis_max"))
