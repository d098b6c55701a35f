"""Readers, sinks and the leak-checked loader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.split import assert_no_leak, leak_counts


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None
                 ) -> DataFrame:
    """Parquet scan; an explicit schema skips footer-based inference of the schema."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_listings_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with quoted multi-line records (escape '"'), explicit schema.

    multiLine files cannot be split, so one file is one task: convert once to Parquet
    (:func:`save_data_set`) and read that from then on."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .csv(path))


def save_data_set(data: DataFrame, save_path: str, num_files: int | None = None,
                  base_path: str = "", shuffle: bool = True) -> str:
    """Overwrite Parquet. Without ``num_files`` Spark balances the rows into files of
    its advisory size, whatever the scale. With it, rows are dealt evenly to that many
    files; ``shuffle=False`` only merges partitions (no shuffle, but the stage before runs
    in that many tasks, and no partition is split)."""
    if not isinstance(data, DataFrame):
        raise TypeError("save_data_set expects a Spark DataFrame")
    path = f"{base_path.rstrip('/')}/{save_path}" if base_path else save_path
    if num_files is None:
        out = data.hint("rebalance")
    else:
        out = data.repartition(num_files) if shuffle else data.coalesce(num_files)
    out.write.mode("overwrite").parquet(path)
    return path


def save(data: DataFrame, path: str) -> str:
    """Uncoalesced overwrite (one file per task)."""
    data.write.mode("overwrite").parquet(path)
    return path


def save_bucketed(data: DataFrame, path: str, table: str, key: str, buckets: int) -> str:
    """A table of ``buckets`` files, each sorted, by a hash of ``key``. Tables of the same
    key and number of buckets join and group on the key without an exchange, on every read;
    the one shuffle is paid here. Returns the table's name; ``open_bucketed`` finds the files
    again in another session."""
    (data.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return table


def open_bucketed(spark: SparkSession, path: str, table: str, schema: str, key: str, buckets: int) -> DataFrame:
    """The bucketed table whose files lie under ``path``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def load_data_and_check_leak(spark: SparkSession, base_path: str,
                             global_path: str = "global_train.parquet",
                             local_path: str = "local_train.parquet",
                             test_path: str = "test_set.parquet",
                             test_needed: bool = False, key: str = "id") -> dict:
    """Read the optional train sets and the test set (empty path = skip), then raise
    if any train set shares keys with the test set; returns the DataFrames by name."""
    def full(p):
        return f"{base_path.rstrip('/')}/{p}" if (base_path and p) else p
    out = {}
    if global_path:
        out["global_train"] = spark.read.parquet(full(global_path))
    if local_path:
        out["local_train"] = spark.read.parquet(full(local_path))
    test = spark.read.parquet(full(test_path)) if test_path else None
    if test is not None:
        trains = {k: v for k, v in out.items()}
        if trains:
            assert_no_leak(trains, test, key)
        if test_needed:
            out["test"] = test
    return out


def load_counts(sets: dict, test: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Row count per loaded set (one job), plus leaked rows when a test set is given."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("set_name"), "rows")
             for n, df in sets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if test is not None:
        out = out.join(leak_counts(sets, test, key), "set_name", "left")
    return out


def profile(df: DataFrame, name: str, baseline: DataFrame | None = None) -> DataFrame:
    """Rows, column count, sorted column list, columns added relative to ``baseline``."""
    cols = sorted(df.columns)
    added = sorted(set(df.columns) - set(baseline.columns)) if baseline is not None else []
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(cols)).alias("n_columns"),
        F.lit(",".join(cols)).alias("columns"), F.lit(",".join(added)).alias("added_columns"))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """N rows, stable when an order is given (top-n per task, merged on the driver)."""
    return (df.orderBy(*order) if order else df).limit(n)
