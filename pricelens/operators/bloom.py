"""Bloom reduction before a join on keys (J2-J4, S6): the large side shuffles only the rows
whose key may be in the other side.

The filter is a table of 64-bit words with the bits of all keys, two per key, made by one
aggregation (``bit_or`` merges) and broadcast. Its size follows the number of keys, 16 bits
each (1.4 % of other keys pass), up to ``MOST_BITS``: 1,048,576 words. With still more keys
more rows pass; what passes is joined exactly, so results never depend on the filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_BITS = 1 << 10
MOST_BITS = 1 << 26


def _slot(key: Column, which: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(f"bloom {which}"), key), F.lit(bits))


def bloom_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(word, bits) of the keys' filter, and its number of bits. Null keys are no keys."""
    known = keys.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull())
    n = known.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * n - 1).bit_length() if n else 0))
    slots = known.select(F.explode(F.array(*[_slot(F.col("_key"), w, bits) for w in (0, 1)])).alias("slot"))
    return (slots.groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))), bits


def marked(df: DataFrame, key: str, words: DataFrame, bits: int, out: str = "_maybe") -> DataFrame:
    """``df`` with ``out``: false where the key is surely not among the filter's keys. Two
    lookups in the broadcast words, no shuffle."""
    hit = F.col(key).isNotNull()
    for w in (0, 1):
        table = F.broadcast(words.select(F.col("word").alias(f"_word{w}"), F.col("bits").alias(f"_bits{w}")))
        slot = _slot(F.col(key), w, bits)
        df = df.withColumn(f"_slot{w}", slot).withColumn(f"_word{w}", F.expr(f"_slot{w} div 64")) \
            .join(table, f"_word{w}", "left")
        hit = hit & F.expr(f"coalesce(shiftrightunsigned(_bits{w}, cast(_slot{w} % 64 as int)) & 1, 0) = 1")
    return df.withColumn(out, hit).drop(*[f"_{x}{w}" for x in ("slot", "word", "bits") for w in (0, 1)])


def semi_join(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``; only those that may be are shuffled."""
    words, bits = bloom_filter(keys, key)
    maybe = marked(df, key, words, bits).where("_maybe").drop("_maybe")
    return maybe.join(keys.select(key), key, "left_semi").select(*df.columns)


def anti_join(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (null keys stay)."""
    words, bits = bloom_filter(keys, key)
    told = marked(df, key, words, bits)
    rest = told.where("_maybe").drop("_maybe").join(keys.select(key), key, "left_anti").select(*df.columns)
    return told.where("not _maybe").select(*df.columns).unionByName(rest)
