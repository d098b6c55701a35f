"""Model error metrics as single aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clamp_at_zero
from .stats import _join_by, quantiles_wide


def log_model_metrics(df: DataFrame, label: str = "log_price", pred: str = "prediction",
                      by: Sequence[str] = (), exact_median: bool = True) -> DataFrame:
    """Dollar MAE, median absolute error, MAPE (%), RMSE after expm1, and R^2 in log space.

    MAPE skips rows whose true dollar value is 0. R^2 = 1 - SSE / (n * var_pop(label))
    (equals RegressionEvaluator's r2). The median is exact (distributed) unless
    ``exact_median=False``, which uses percentile_approx like the original evaluation."""
    by = list(by)
    y, p = F.expm1(F.col(label)), F.expm1(F.col(pred))
    base = df.select(*by, y.alias("_y"), p.alias("_p"), F.col(label).alias("_ly"),
                     F.col(pred).alias("_lp"))
    err = F.abs(F.col("_y") - F.col("_p"))
    aggs = [F.count(F.lit(1)).alias("n"),
            F.avg(err).alias("mae"),
            (F.avg(F.when(F.col("_y") != 0, err / F.abs(F.col("_y")))) * 100).alias("mape_pct"),
            F.sqrt(F.avg(F.pow(F.col("_y") - F.col("_p"), 2))).alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.sum(F.pow(F.col("_ly") - F.col("_lp"), 2)),
                                       F.count(F.lit(1)) * F.var_pop("_ly"))).alias("r2_log")]
    if not exact_median:
        aggs.append(F.percentile_approx(err, 0.5, 10000).alias("medae"))
    m = base.groupBy(*by).agg(*aggs) if by else base.agg(*aggs)
    if exact_median:
        med = quantiles_wide(base.withColumn("_e", err), "_e", {"medae": 0.5}, by)
        m = _join_by(m, med, by)
    return m


def dollar_metrics(df: DataFrame, label: str = "log_price", pred: str = "prediction",
                   by: Sequence[str] = ()) -> DataFrame:
    """Per cell: dollar RMSE, MAE, R^2 and MAPE (fraction), the prediction clamped at 0
    after expm1; MAPE only over rows with a positive true price."""
    by = list(by)
    y = F.expm1(F.col(label))
    p = clamp_at_zero(F.expm1(F.col(pred)))
    base = df.select(*by, y.alias("_y"), p.alias("_p"))
    d = F.col("_y") - F.col("_p")
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sqrt(F.avg(d * d)).alias("dollar_rmse"),
            F.avg(F.abs(d)).alias("dollar_mae"),
            (F.lit(1.0) - F.try_divide(F.sum(d * d), F.count(F.lit(1)) * F.var_pop("_y")))
            .alias("dollar_r2"),
            F.avg(F.when(F.col("_y") > 0, F.abs(d) / F.col("_y"))).alias("dollar_mape")]
    return base.groupBy(*by).agg(*aggs) if by else base.agg(*aggs)


def calibration_report(df: DataFrame, label: str, raw: str, calibrated: str) -> DataFrame:
    """Before/after: RMSE, MAE, bias (mean pred - true) and % improvement."""
    def block(c, tag):
        d = F.col(c) - F.col(label)
        return [F.sqrt(F.avg(d * d)).alias(f"rmse_{tag}"), F.avg(F.abs(d)).alias(f"mae_{tag}"),
                F.avg(d).alias(f"bias_{tag}")]
    m = df.agg(*block(raw, "raw"), *block(calibrated, "cal"))
    return (m.withColumn("rmse_improvement_pct",
                         F.try_divide(F.col("rmse_raw") - F.col("rmse_cal"), F.col("rmse_raw")) * 100)
             .withColumn("mae_improvement_pct",
                         F.try_divide(F.col("mae_raw") - F.col("mae_cal"), F.col("mae_raw")) * 100))
