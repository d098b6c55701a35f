"""Deterministic sampling and group blocks.

Every choice is a function of (key, seed) through md5, so it does not depend on
partitioning, task retries or cluster size, and any SQL engine can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket, hash_order_key
from .stats import Ranked


_HASH_SPACE = 1 << 32


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42,
                 oversample: float = 1.1) -> DataFrame:
    """Exactly min(n, rows) rows without replacement: the n smallest md5(key || seed).

    The md5 prefix is uniform, so rows whose first 32 bits fall under a threshold sized
    for ~1.1 n rows contain the n smallest keys (checked by a count, widened if short);
    only those candidates are ordered, so the final top-n merge handles about n rows
    however many partitions the input has."""
    total = df.count()
    order = [hash_order_key(F.col(key), seed), F.col(key)]
    if total <= n:
        return df
    prefix = F.conv(F.substring(hash_order_key(F.col(key), seed), 1, 8), 16, 10).cast("long")
    t = min(_HASH_SPACE, int((n * oversample + 64) / total * _HASH_SPACE) + 1)
    while True:
        cand = df.where(prefix < F.lit(t))
        if t >= _HASH_SPACE or cand.count() >= n:
            break
        t = min(_HASH_SPACE, t * 2)
    return cand.orderBy(*order).limit(n)


def fraction_sample(df: DataFrame, key: str, pct: int, seed: int = 42) -> DataFrame:
    """Bernoulli-like sample of ``pct`` % by hash bucket (no shuffle). The bucket has a salt
    of its own: any side of a hash split is sampled at the same rate."""
    return df.where(hash_bucket(F.col(key), seed, purpose="sample") < pct)


def sample_then_cap(df: DataFrame, key: str, pct: int, cap: int, seed: int = 42) -> DataFrame:
    """pct % hash sample, then at most ``cap`` rows in hash order (T5)."""
    return exact_sample(fraction_sample(df, key, pct, seed), key, cap, seed)


def group_blocks(df: DataFrame, group: str, block_size: int, seed: int = 42) -> DataFrame:
    """The distinct groups in a seeded pseudo-random order, cut into consecutive blocks
    of ``block_size`` (the last may be short). Returns group, block, position.

    The order is computed by a distributed rank (range partitions + prefix counts), so
    even a very long group list never goes through a single task."""
    groups = df.select(group).where(F.col(group).isNotNull()).distinct()
    r = Ranked(groups, hash_order_key(F.col(group), seed), tie_break=F.col(group), keep=[group])
    ranked = r.positions().select(group, F.col("_rank").cast("int").alias("position"))
    return ranked.withColumn("block", F.floor(F.col("position") / block_size).cast("int"))


def choose_blocks(blocks: DataFrame, r: int, seed: int = 42) -> DataFrame:
    """R distinct blocks without replacement (hash order), or all when fewer."""
    ids = blocks.select("block").distinct()
    return exact_sample(ids, "block", r, seed)


def rows_in_groups(df: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """Rows whose group is in the chosen list (semi join; AQE picks broadcast
    when the list is small at run time)."""
    return df.join(groups.select(group).distinct(), group, "left_semi")


def block_sample(df: DataFrame, group: str, block_size: int, r: int, seed: int = 42
                 ) -> DataFrame:
    """Rows of r pseudo-randomly chosen blocks of groups (spatial sampling)."""
    b = group_blocks(df, group, block_size, seed)
    chosen = choose_blocks(b, r, seed)
    gl = b.join(chosen, "block", "left_semi")
    return rows_in_groups(df, gl, group)


def in_groups(df: DataFrame, group: str, values: Sequence) -> DataFrame:
    """Rows whose group is one of a short literal list."""
    return df.where(F.col(group).isin(list(values)))
