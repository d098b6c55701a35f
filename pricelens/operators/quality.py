"""Data-quality audits in single aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_positive, is_valid_price


def _valid(c: str):
    return is_valid_price(c)


def _invalid(c: str):
    return F.col(c).isNull() | (F.col(c) <= 0)


def quality_audit(df: DataFrame, a: str, b: str) -> DataFrame:
    """Null / zero / valid counts for two price columns and the 4-way cross tab, one pass."""
    cnt = lambda cond: F.count_if(cond)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        cnt(F.col(a).isNull()).alias("a_null"), cnt(F.col(a) == 0).alias("a_zero"),
        cnt(_valid(a)).alias("a_valid"),
        cnt(F.col(b).isNull()).alias("b_null"), cnt(F.col(b) == 0).alias("b_zero"),
        cnt(_valid(b)).alias("b_valid"),
        cnt(_valid(a) & _valid(b)).alias("both_valid"),
        cnt(_valid(a) & _invalid(b)).alias("a_only_valid"),
        cnt(_invalid(a) & _valid(b)).alias("b_only_valid"),
        cnt(_invalid(a) & _invalid(b)).alias("both_invalid"),
    )


def valid_crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per (a valid?, b valid?) cell."""
    return (df.select(_valid(a).alias("a_valid"), _valid(b).alias("b_valid"))
            .groupBy("a_valid", "b_valid").agg(F.count(F.lit(1)).alias("n")))


def missing_strategy(df: DataFrame, a: str, b: str) -> DataFrame:
    """Remaining / dropped rows and % dropped for: drop rows with any invalid price,
    take the first positive of the two, keep each source's valid rows separately."""
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(_valid(a) & _valid(b)).alias("drop_any_invalid"),
                 F.count_if(first_positive(a, b).isNotNull()).alias("coalesce_first_positive"),
                 F.count_if(_valid(a)).alias("keep_separate_a"),
                 F.count_if(_valid(b)).alias("keep_separate_b"))
    names = ["drop_any_invalid", "coalesce_first_positive", "keep_separate_a", "keep_separate_b"]
    arr = F.array(*[F.struct(F.lit(n).alias("strategy"), F.col(n).alias("remaining")) for n in names])
    s = agg.select("total", F.explode(arr).alias("_s")).select("total", "_s.strategy", "_s.remaining")
    return (s.withColumn("dropped", F.col("total") - F.col("remaining"))
             .withColumn("pct_dropped", F.try_divide(F.col("dropped") * 100.0, F.col("total"))))


def coalesced_price(df: DataFrame, key: str, a: str, b: str, out: str = "price") -> DataFrame:
    return df.select(key, first_positive(a, b).alias(out))


def missing_gate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, rows that are null or NaN (one aggregate pass)."""
    def bad(c):
        t = dict(df.dtypes)[c]
        cond = F.col(c).isNull()
        if t in ("double", "float"):
            cond = cond | F.isnan(c)
        return F.count_if(cond)
    row = df.agg(*[bad(c).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in cols])
    return row.select(F.explode(arr).alias("_m")).select("_m.column", "_m.missing")


def assert_no_missing(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise ValueError listing every column with missing values (one job, one row per column)."""
    bad = [(r["column"], r["missing"]) for r in missing_gate(df, cols).collect() if r["missing"]]
    if bad:
        raise ValueError("missing values: " + ", ".join(f"{c}={n}" for c, n in bad))
