"""Row keys, scratch tables and bounded samples shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reach_package, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text; with the document id it names a row. Rows that agree in both
    are copies of one row and always get the same result."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new folder under the shared checkpoint folder and read it
    back: later jobs reread the table, a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_unit(*cols: Column) -> Column:
    """A uniform number in [0, 1) that depends on the values only."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(df: DataFrame, stratum: str, rows: int, *cols: Column) -> DataFrame:
    """About ``rows`` rows of each value of ``stratum``, chosen by a hash of ``cols``: each
    row stands under rows / (size of its stratum). No ordering and no shuffle of ``df``:
    the strata are class labels, so their sizes are a short list that is broadcast."""
    sizes = df.groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("_n"))
    share = F.lit(float(rows)) / F.col("_n")
    return (df.withColumn("_u", hash_unit(F.lit("sample"), *cols))
            .join(F.broadcast(sizes), F.col(stratum) == F.col("_s"))
            .where(F.col("_u") < share).drop("_u", "_s", "_n"))


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2 (an id that is null is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def join_rows(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the keys of ``left`` remain."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])
