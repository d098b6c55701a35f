"""Distributed summary statistics.

Exact quantiles come from ``select``. ``Ranked`` gives every row its rank: values are
range-partitioned on (group, value, tie-break), every task counts its slice, and a tiny prefix
sum over the per-slice counts turns local positions into global ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, safe_corr
from ..session import checkpointed
from .select import Selection

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


class Ranked:
    """Values of ``value`` per group, range-partitioned and sorted, with frozen positions.

    ``frame`` has the group columns (``_g`` when ungrouped), ``_v``, ``_pid`` and ``_pos``.
    Built once, so that ranks do not change when a stage is repeated."""

    def __init__(self, df: DataFrame, value: str | Column, by: Sequence[str] = (),
                 tie_break: Column | None = None, num_partitions: int | None = None,
                 keep: Sequence[str] = ()):
        spark = df.sparkSession
        self.by = list(by)
        self.keep = list(keep)
        v = F.col(value) if isinstance(value, str) else value
        vtype = df.select(v.alias("_t")).schema["_t"].dataType.simpleString()
        if vtype in ("double", "float"):
            v = nan_to_null(v)
        # A unique tie-break spreads even a value repeated in a third of all rows over
        # many range partitions. Ranks do not depend on it (equal values are
        # interchangeable), so a retry that renumbers rows cannot change any result.
        tb = tie_break if tie_break is not None else F.monotonically_increasing_id()
        x = df.select(*[F.col(c) for c in self.by], *[F.col(c) for c in self.keep],
                      v.alias("_v"), tb.alias("_tb")).where(F.col("_v").isNotNull())
        if not self.by:
            x = x.withColumn("_g", F.lit(0))
        self.gcols = self.by or ["_g"]
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        s = (x.repartitionByRange(n, *self.gcols, "_v", "_tb")
              .sortWithinPartitions(*self.gcols, "_v", "_tb")
              .withColumn("_mid", F.monotonically_increasing_id())
              .select(*self.gcols, *self.keep, "_v",
                      F.shiftright("_mid", _POS_BITS).alias("_pid"),
                      (F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))).alias("_pos")))
        # Positions depend on the physical layout (range bounds come from a sample, AQE
        # may coalesce reads), so freeze them once in the shared checkpoint folder: every
        # consumer then sees identical (_pid, _pos), and a lost executor re-reads files
        # instead of recomputing a different layout.
        self.frame = checkpointed(s)

    def _slices(self) -> DataFrame:
        """Per (range partition, group): first local position, row count, rows before it
        in the group and the group size. At most partitions x groups rows."""
        gcols = self.gcols
        slices = self.frame.groupBy("_pid", *gcols).agg(F.min("_pos").alias("_first"),
                                                       F.count(F.lit(1)).alias("_cnt"))
        wg = Window.partitionBy(*gcols)
        return (slices
                .withColumn("_before", F.coalesce(F.sum("_cnt").over(
                    wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("_n", F.sum("_cnt").over(wg)))

    def positions(self) -> DataFrame:
        """Every row with its 0-based rank within its group (``_rank``) and the group
        size (``_n``): a distributed row_number that never sends a group to one task."""
        sl = self._slices().select("_pid", *self.gcols, "_first", "_before", "_n")
        out = self.frame.join(sl, ["_pid", *self.gcols])
        out = out.select(*self.by, *self.keep, "_v",
                         (F.col("_before") + F.col("_pos") - F.col("_first")).alias("_rank"),
                         "_n")
        return out


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact linearly-interpolated quantiles (pandas ``quantile`` / SQL ``quantile_cont``).

    Returns long form: ``by..., prob, quantile``. Null and NaN values are ignored. Two passes
    over the input, no sort of it (see ``select``)."""
    return Selection(df, value, by, probs).quantiles()


def quantiles_wide(df: DataFrame, value: str | Column, named: Mapping[str, float],
                   by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles as one column per name: ``by..., <name>...``."""
    return Selection(df, value, by, list(named.values())).quantiles_wide(named)


def _join_by(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        # both sides are single-row aggregates with disjoint columns: stack and fold
        cols = left.columns + [c for c in right.columns if c not in left.columns]
        return left.unionByName(right, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in cols])
    r = right
    for c in by:
        r = r.withColumnRenamed(c, "_r_" + c)
    cond = None
    for c in by:
        t = left[c].eqNullSafe(r["_r_" + c])
        cond = t if cond is None else cond & t
    return left.join(r, cond, "left").drop(*["_r_" + c for c in by])


def summary_stats(df: DataFrame, value: str, by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """count, min, q1, median, mean, q3, max, std (sample) per group, optionally rounded.
    The first pass of the quantiles takes the plain aggregates along."""
    by = list(by)
    s = Selection(df, value, by, QUARTILES.values(), [
        F.count("_v").alias("count"), F.min("_v").alias("min"), F.avg("_v").alias("mean"),
        F.max("_v").alias("max"), F.stddev_samp("_v").alias("std")])
    out = _join_by(s.aggregate(), s.quantiles_wide(QUARTILES), by)
    cols = ["count", "min", "q1", "median", "mean", "q3", "max", "std"]
    if digits is not None:
        return out.select(*by, "count", *[F.round(c, digits).alias(c) for c in cols[1:]])
    return out.select(*by, *cols)


def long_form(df: DataFrame, series: Mapping[str, str | Column], keep: Sequence[str] = ()
              ) -> DataFrame:
    """Unpivot named value expressions into (keep..., series, value) rows with ``stack``-like
    explode of a literal-keyed array (one pass, no union of scans)."""
    arr = F.array(*[F.struct(F.lit(name).alias("series"),
                             (F.col(e) if isinstance(e, str) else e).cast("double").alias("value"))
                    for name, e in series.items()])
    return df.select(*keep, F.explode(arr).alias("_s")).select(*keep, "_s.series", "_s.value")


def moment_table(df: DataFrame, series: Mapping[str, str | Column]) -> DataFrame:
    """Per series: count, mean, median, std, min, q1, q3, max, skew, kurtosis (bias-corrected
    like pandas: G1 = g1*sqrt(n(n-1))/(n-2), G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6))."""
    s = Selection(long_form(df, series), "value", ["series"], QUARTILES.values(), [
        F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"), F.skewness("_v").alias("_g1"),
        F.kurtosis("_v").alias("_g2")])
    m = s.aggregate()
    n = F.col("count").cast("double")
    m = m.select("series", "count", "mean", "std", "min", "max",
                 F.try_divide(F.col("_g1") * F.sqrt(n * (n - 1)), n - 2).alias("skew"),
                 (F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6))
                 .alias("kurtosis"))
    return _join_by(m, s.quantiles_wide(QUARTILES), ["series"]).select(
        "series", "count", "mean", "median", "std", "min", "q1", "q3", "max", "skew", "kurtosis")


def iqr(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    q = quantiles_wide(df, value, {"q1": 0.25, "q3": 0.75}, by)
    return q.withColumn("iqr", F.col("q3") - F.col("q1"))


def sign_counts(df: DataFrame, diff: str) -> DataFrame:
    """Rows with positive / negative / zero difference and their share in %."""
    s = df.where(F.col(diff).isNotNull()).select(
        F.when(F.col(diff) > 0, "positive").when(F.col(diff) < 0, "negative")
        .otherwise("zero").alias("sign"))
    counts = s.groupBy("sign").agg(F.count(F.lit(1)).alias("n"))  # three rows at most
    return counts.withColumn("pct", F.try_divide(
        F.col("n") * 100.0, F.sum("n").over(Window.partitionBy()).cast("double")))


def corr_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson r on the raw and on the log10(x+1) scale, and which is stronger."""
    r_lin = safe_corr(F.col(a), F.col(b))
    r_log = safe_corr(F.log10(F.col(a) + 1), F.log10(F.col(b) + 1))
    return (df.agg(r_lin.alias("r_linear"), r_log.alias("r_log"))
            .withColumn("stronger", F.when(F.abs("r_log") > F.abs("r_linear"), "log")
                        .otherwise("linear")))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(feature, corr) for many columns in one aggregate pass, unpivoted."""
    row = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols])
    return row.select(F.explode(arr).alias("_c")).select("_c.feature", "_c.corr")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every pair of columns, both ways and with themselves, from one
    aggregate pass over the upper triangle (A10)."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[safe_corr(F.col(cols[i]), F.col(cols[j])).alias(f"_{i}_{j}") for i, j in pairs])
    cell = lambda a, b, i, j: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                       F.col(f"_{i}_{j}").alias("corr"))
    cells = [cell(cols[x], cols[y], i, j) for i, j in pairs for x, y in {(i, j), (j, i)}]
    return row.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def describe_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas-style describe (count, mean, std, min, 25%, 50%, 75%, max) per column,
    exact quantiles, one row per column."""
    lf = long_form(df, {c: c for c in cols})
    return summary_stats(lf, "value", ["series"], digits=None).withColumnRenamed("series", "column")


def group_mean_std(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.col(value)).alias("n"), F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("std"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.sum("n").cast("double").alias("_total"))  # one row, from the grouped rows
    return c.crossJoin(F.broadcast(total)).select(
        col, "n", F.try_divide(F.col("n"), F.col("_total")).alias("share"))


def range_two_sets(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: min and max across the union of two tables."""
    u = a.select(*cols).unionByName(b.select(*cols))
    lf = long_form(u, {c: c for c in cols})
    return lf.groupBy("series").agg(F.min("value").alias("min"), F.max("value").alias("max")) \
             .withColumnRenamed("series", "column")


def max_abs_diff(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.max(F.abs(F.col(a) - F.col(b))).alias("max_abs_diff"))


def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares slope, intercept, r, and ``points`` evenly spaced fitted values
    from min(x) to max(x)."""
    fit = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                 F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                 safe_corr(F.col(x), F.col(y)).alias("r"), F.min(x).alias("_lo"),
                 F.max(x).alias("_hi"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    g = fit.select("slope", "intercept", "r", "_lo", "_hi", steps)
    xx = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i") / F.lit(float(points - 1))
    return g.select("i", xx.alias("x"), (F.col("intercept") + F.col("slope") * xx).alias("y_fit"),
                    "slope", "intercept", "r")


def group_premium(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Mean of ``value`` in flag=1 vs flag=0, difference, % of the base mean, and the
    implied price ratio when ``value`` is a log price (exp(diff) - 1)."""
    m1 = F.avg(F.when(F.col(flag) == 1, F.col(value)))
    m0 = F.avg(F.when(F.col(flag) == 0, F.col(value)))
    return (df.agg(m1.alias("mean_flagged"), m0.alias("mean_other"))
            .withColumn("diff", F.col("mean_flagged") - F.col("mean_other"))
            .withColumn("pct_of_mean", F.try_divide(F.col("diff"), F.col("mean_other")) * 100)
            .withColumn("price_ratio_pct", (F.exp("diff") - 1) * 100))


def trend_direction(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean per group; compare first and last group (by key) -> 'increasing'/'decreasing'."""
    g = df.groupBy(group).agg(F.avg(value).alias("mean"))
    return (g.agg(F.min_by("mean", group).alias("first_mean"),
                  F.max_by("mean", group).alias("last_mean"))
            .withColumn("direction", F.when(F.col("last_mean") > F.col("first_mean"), "increasing")
                        .when(F.col("last_mean") < F.col("first_mean"), "decreasing")
                        .otherwise("flat")))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Top-k rows (TakeOrderedAndProject: each task keeps k, the driver merges k x tasks)."""
    return df.orderBy(*order).limit(k)
