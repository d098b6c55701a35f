"""Storage layout audits over file metadata.

``binaryFile`` lists files as a DataFrame; only ``path`` and ``length`` are selected,
so file contents are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024.0 * 1024.0

# Fixed verdict thresholds.
SMALL_FILE_COUNT, SMALL_FILE_MB = 100, 10.0
SKEW_FACTOR = 3.0
LARGE_FILE_MB = 100.0


def file_listing(spark: SparkSession, path: str, glob: str = "*.parquet",
                 recursive: bool = False) -> DataFrame:
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).select("path", "length")


def analyze_storage_layout(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """File count, total / average / max size and the layout verdicts:
    small-files (> 100 files and avg < 10 MB), skewed (max > 3 x avg), good (avg > 100 MB)."""
    files = file_listing(spark, path, glob)
    a = files.agg(F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_bytes"),
                  F.avg("length").alias("_avg"), F.max("length").alias("max_bytes"))
    avg_mb = F.col("_avg") / MB
    max_mb = F.col("max_bytes") / MB
    return a.select(
        "file_count", "total_bytes", (F.col("total_bytes") / (MB * 1024)).alias("total_gb"),
        avg_mb.alias("avg_mb"), max_mb.alias("max_mb"),
        ((F.col("file_count") > SMALL_FILE_COUNT) & (avg_mb < SMALL_FILE_MB)).alias("small_files"),
        (max_mb > SKEW_FACTOR * avg_mb).alias("skewed_sizes"),
        (~(max_mb > SKEW_FACTOR * avg_mb) & (avg_mb > LARGE_FILE_MB)).alias("good_layout"))


def layer_inventory(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Per layer (first folder under ``root``) and artefact (second folder): files and MB."""
    files = file_listing(spark, root, glob, recursive=True)
    rel = F.regexp_replace(F.col("path"), r"^.*?" + root.rstrip("/").split("/")[-1] + "/", "")
    return (files.select(F.regexp_extract(rel, r"^([^/]+)/", 1).alias("layer"),
                         F.regexp_extract(rel, r"^[^/]+/([^/]+)/", 1).alias("artefact"),
                         "length")
            .groupBy("layer", "artefact")
            .agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / MB).alias("mb")))
