"""Results kept by key: a table of folders, one per key, each replaced as a whole.

A job that is repeated, or that starts again after it died, leaves one copy of its rows and
can see which keys are done. A folder whose write did not finish holds no rows yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def content_id(*frames: DataFrame) -> str:
    """An id of the rows' values, whatever their order or partitioning: the same data give
    the same id, changed data another. Doubles count with the digits of a float, as sums that
    were added up in another order differ in the last ones. One pass over each frame."""
    parts = []
    for df in frames:
        cols = [F.col(f"`{f.name}`").cast("float") if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
                for f in sorted(df.schema.fields, key=lambda f: f.name)]
        r = df.select(F.xxhash64(*cols).alias("h"), F.xxhash64(F.lit("second"), *cols).alias("g")).agg(
            F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("g")).first()
        parts.append("-".join(f"{int(x or 0) & (1 << 64) - 1:x}" for x in r))
    return ".".join(parts)


def write_keyed(rows: DataFrame, path: str, key: str, value) -> None:
    """Replace the rows of ``value``; the key becomes a column of the table."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{key}={value}")


def keyed_table(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The table as it is now; empty where nothing has been written."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def done_keys(table: DataFrame, key: str) -> set:
    """The keys that have rows (a short list: one entry per finished piece of work)."""
    return {r[0] for r in table.select(key).distinct().collect()}
