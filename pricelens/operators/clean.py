"""Standardising, deduplicating and cleaning listing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_valid_price, parse_currency


def standardise(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Select + cast + rename: ``spec = {new_name: (source_col, type)}``.

    Uses ``try_cast`` so dirty text becomes null instead of failing the job (ANSI mode).
    """
    return df.select(*[F.col(src).try_cast(t).alias(dst) for dst, (src, t) in spec.items()])


def freshest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (e.g. newest scrape, then a tie-break).

    Expressed as ``row_number() = 1`` so Spark plans a partial WindowGroupLimit before
    the shuffle: every map task keeps only its best row per key, which bounds a hot key
    to one row per input partition before it reaches the reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_keys(df: DataFrame, key: str, tie_break: Sequence[str]) -> DataFrame:
    """Key dedup with a deterministic survivor (smallest ``tie_break`` values)."""
    return freshest_per_key(df, key, [F.col(c).asc_nulls_last() for c in tie_break])


def parse_price(df: DataFrame, text_col: str = "price", raw_name: str = "raw_price_str",
                out: str = "price_usd", fx: float = 1.17, digits: int = 3) -> DataFrame:
    """Rename the text price to ``raw_name`` and add the parsed, converted price."""
    return (df.withColumnRenamed(text_col, raw_name)
              .withColumn(out, parse_currency(F.col(raw_name), fx, digits)))


def keep_valid(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is not null and > 0."""
    return df.where(is_valid_price(col))


def add_log_price(df: DataFrame, price_col: str, out: str = "log_price") -> DataFrame:
    return df.withColumn(out, F.log1p(F.col(price_col)))


def local_silver(raw: DataFrame, key: str = "id", ts: str = "last_scraped",
                 tie_break: str = "row_key", fx: float = 1.17) -> DataFrame:
    """Freshest row per key -> parse price -> keep valid -> log price.

    Dedup runs before the validity filter on purpose: a key whose newest row has an
    invalid price is dropped, not replaced by an older row.
    """
    fresh = freshest_per_key(raw, key, [F.col(ts).desc_nulls_last(), F.col(tie_break).desc()])
    return add_log_price(keep_valid(parse_price(fresh, fx=fx), "price_usd"), "price_usd")


def global_silver(raw: DataFrame, key_src: str = "property_id", key: str = "id",
                  price: str = "price", tie_break: Sequence[str] = ("listing_title", "price")
                  ) -> DataFrame:
    """Rename key -> dedup per key (deterministic survivor) -> keep valid -> log price."""
    df = raw.withColumnRenamed(key_src, key)
    return add_log_price(keep_valid(dedup_keys(df, key, list(tie_break)), price), price)


def regex_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Case-folded regular-expression filter, e.g. ``^paris``."""
    return df.where(F.lower(F.col(col)).rlike(pattern))


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows whose ``col`` starts with ``prefix`` (case matters); pushed down to the scan."""
    return df.where(F.col(col).startswith(prefix))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup: equal rows are one row."""
    return df.dropDuplicates()


def open_range(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> DataFrame:
    """lo < c < hi for every column."""
    cond = None
    for c in cols:
        t = (F.col(c) > F.lit(lo)) & (F.col(c) < F.lit(hi))
        cond = t if cond is None else cond & t
    return df.where(cond)
