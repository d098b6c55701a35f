"""Leak-free, partition-independent train/test splitting and leak checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket
from ..session import checkpointed
from .bloom import anti_join, semi_join


class LeakError(Exception):
    """Raised when a training set shares keys with the test set."""


def hash_split(df: DataFrame, key: str = "id", test_pct: int = 20, seed: int = 42
               ) -> tuple[DataFrame, DataFrame]:
    """(test, train) by md5 bucket of the key: the same key always lands on the same side,
    whatever the partitioning, row order or cluster size. No join, no shuffle."""
    b = hash_bucket(F.col(key), seed)
    return df.where(b < test_pct), df.where(b >= test_pct)


def test_ids(df: DataFrame, key: str = "id", test_pct: int = 20, seed: int = 42) -> DataFrame:
    """Distinct keys selected for hold-out (the reference's sampled id list)."""
    return df.select(key).where(hash_bucket(F.col(key), seed) < test_pct).distinct()


def remove_ids(df: DataFrame, ids: DataFrame, key: str = "id", test_pct: int | None = None,
               seed: int = 42) -> DataFrame:
    """Anti join: drop rows whose key is in ``ids``.

    When ``ids`` were drawn by :func:`test_ids` with ``test_pct``, only rows in the low
    buckets can match, so only that slice is shuffled for the anti join; the rest passes
    straight through (saves (100 - test_pct) % of the shuffle on the large side). Of any other
    id list a Bloom filter tells which rows may match.
    """
    if test_pct is None:
        return anti_join(df, ids, key)
    b = hash_bucket(F.col(key), seed)
    maybe = df.where(b < test_pct).join(ids, key, "left_anti")
    return df.where(b >= test_pct).unionByName(maybe)


def leak_counts(sets: Mapping[str, DataFrame], test: DataFrame, key: str = "id") -> DataFrame:
    """One row per named set: rows of that set whose key appears in ``test``.

    A semi join (not inner), so duplicate test keys cannot inflate counts. A Bloom filter of
    the test keys goes before it: of a clean set hardly a row is shuffled.
    """
    ids = checkpointed(test.select(key).where(F.col(key).isNotNull()).distinct())
    parts = [semi_join(s, ids, key).agg(F.count(F.lit(1)).alias("leaked_rows"))
               .select(F.lit(name).alias("set_name"), "leaked_rows")
             for name, s in sets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_no_leak(sets: Mapping[str, DataFrame], test: DataFrame, key: str = "id") -> None:
    """Raise :class:`LeakError` naming every set that shares keys with ``test``."""
    rows = leak_counts(sets, test, key).collect()  # one row per set
    bad = [(r["set_name"], r["leaked_rows"]) for r in rows if r["leaked_rows"] > 0]
    if bad:
        raise LeakError("; ".join(f"data leak in {n}: {c:,} test keys found" for n, c in bad))
