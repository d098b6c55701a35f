"""Registered queries: sinks, CSV ingest, leak-checked loading, layout audits (step 11)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import io, layout
from . import common as C
from .common import round_doubles as r6, sql_with

LOCAL_RAW_SCHEMA = ("id long, row_key long, latitude double, longitude double, name string, "
                    "listing_url string, price string, last_scraped timestamp_ntz")


def _area(spark: SparkSession, d: str, what: str) -> str:
    tag = hashlib.md5(d.encode()).hexdigest()[:10]
    return scratch_path(spark, f"pricelens/{what}/{tag}")


#: Artefacts that layer_inventory writes.
LAYERS = {"bronze": ["local_raw", "global_raw"],
          "silver": ["local_silver", "local_train", "test_set", "global_train"],
          "gold": ["local_gold"], "diamond": ["geo_features"]}


def _save_splits(spark: SparkSession, d: str, base: str) -> None:
    """Write the silver table once and cut the split artefacts from the written table."""
    silver = io.read_parquet(spark, io.save_data_set(C.local_silver(spark, d), "local_silver",
                                                     base_path=base))
    test, local_train, global_train = C.splits(spark, d, silver)
    for name, df in (("local_train", local_train), ("test_set", test), ("global_train", global_train)):
        io.save_data_set(df, name, base_path=base)


def layout_audit(spark: SparkSession, d: str) -> DataFrame:
    return r6(layout.analyze_storage_layout(spark, d))


BUCKETS = 8


def bucketed_match(spark: SparkSession, d: str) -> DataFrame:
    """S4, S6, J1-J4 on bucketed storage: fresh local listings matched with the global ones and
    parted from the hold-out ids; no join moves a row."""
    tag = hashlib.md5(d.encode()).hexdigest()[:10]
    tables = {}
    for name, df in (("local", C.local_fresh(spark, d).select("id", "row_key", "price")),
                     ("global", fx.global_raw(spark, d).select(F.col("property_id").alias("id"), F.col("price").alias("asked"))),
                     ("held", split.test_ids(C.local_silver(spark, d), "id", C.TEST_PCT, C.SEED))):
        at = _area(spark, d, f"bucketed/{name}")
        tables[name] = spark.table(io.save_bucketed(df, at, f"pricelens_{name}_{tag}", "id", BUCKETS))
    both = tables["local"].join(tables["global"], "id").join(tables["held"], "id", "left_anti")
    return r6(both.select("id", "row_key", "price", "asked"))


def layer_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Write the bronze / silver / gold / diamond artefacts, then inventory the folders."""
    root = _area(spark, d, "layers")
    io.save_data_set(fx.local_raw(spark, d), "bronze/local_raw", base_path=root)
    io.save_data_set(fx.global_raw(spark, d), "bronze/global_raw", base_path=root)
    _save_splits(spark, d, f"{root}/silver")
    io.save_data_set(fx.local_gold(spark, d), "gold/local_gold", base_path=root)
    io.save(C.flagged(spark, d), f"{root}/diamond/geo_features")
    sizes = layout.layer_inventory(spark, root)
    rows = [spark.read.parquet(f"{root}/{layer}/{name}").agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(layer).alias("layer"), F.lit(name).alias("artefact"), "rows")
            for layer, names in LAYERS.items() for name in names]
    counted = rows[0]
    for r in rows[1:]:
        counted = counted.unionByName(r)
    return counted.join(sizes, ["layer", "artefact"], "left").select(
        "layer", "artefact", "rows", ((F.col("files") > 0) & (F.col("mb") > 0)).alias("has_files"))


def csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Round trip through quoted CSV (header, escape '"') with an explicit schema; names hold
    quotes, commas and line breaks."""
    path = _area(spark, d, "csv") + "/local_raw"
    raw = fx.local_raw(spark, d)
    named = raw.withColumn("name", F.concat(F.lit('A "nice", '), F.col("name"), F.lit("\nsecond line")))
    (named.write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
    back = io.read_listings_csv(spark, path, LOCAL_RAW_SCHEMA)
    return back.agg(F.count(F.lit(1)).alias("rows"), F.sum("row_key").alias("sum_row_key"),
                    F.count("price").alias("priced_rows"),
                    F.sum(F.length("price")).alias("price_chars"),
                    F.sum(F.length("name")).alias("name_chars"),
                    F.max("last_scraped").alias("last_scraped"))


def save_and_profile(spark: SparkSession, d: str) -> DataFrame:
    """Save the local silver table in 2 files, read it back, profile it against raw."""
    path = io.save_data_set(C.local_silver(spark, d), "local_silver", base_path=_area(spark, d, "silver"))
    back = io.read_parquet(spark, path)
    return io.profile(back, "local_silver", baseline=fx.local_raw(spark, d))


def load_check_leak(spark: SparkSession, d: str) -> DataFrame:
    """Persist the three split artefacts, reload them through the leak gate, count rows."""
    base = _area(spark, d, "splits")
    _save_splits(spark, d, base)
    sets = io.load_data_and_check_leak(spark, base, "global_train", "local_train", "test_set",
                                       test_needed=True)
    t = sets.pop("test")
    return io.load_counts({**sets, "test": t}, t)


QUERIES = {
    "layout_audit": layout_audit,
    "layer_inventory": layer_inventory,
    "csv_ingest": csv_ingest,
    "save_and_profile": save_and_profile,
    "load_check_leak": load_check_leak,
    "bucketed_match": bucketed_match,
}

_SILVER_COLS = sorted(["id", "row_key", "latitude", "longitude", "name", "listing_url",
                       "raw_price_str", "last_scraped", "price_usd", "log_price"])
_RAW_COLS = {"id", "row_key", "latitude", "longitude", "name", "listing_url", "price",
             "last_scraped"}

ORACLE = {
    # file metadata of the oracle's own table folder (the driver compares at sf0.01)
    "layout_audit": """
        SELECT count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes,
               round(sum(size) / (1024.0 * 1024 * 1024), 6) AS total_gb,
               round(avg(size) / (1024.0 * 1024), 6) AS avg_mb,
               round(max(size) / (1024.0 * 1024), 6) AS max_mb,
               count(*) > 100 AND avg(size) / (1024.0 * 1024) < 10.0 AS small_files,
               max(size) / (1024.0 * 1024) > 3.0 * avg(size) / (1024.0 * 1024) AS skewed_sizes,
               NOT (max(size) / (1024.0 * 1024) > 3.0 * avg(size) / (1024.0 * 1024))
                 AND avg(size) / (1024.0 * 1024) > 100.0 AS good_layout
        FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
    "layer_inventory": sql_with("""
        SELECT layer, artefact, rows, TRUE AS has_files FROM (
          SELECT 'bronze' AS layer, 'local_raw' AS artefact, count(*) AS rows FROM local_raw
          UNION ALL SELECT 'bronze', 'global_raw', count(*) FROM global_raw
          UNION ALL SELECT 'silver', 'local_silver', count(*) FROM local_silver
          UNION ALL SELECT 'silver', 'local_train', count(*) FROM local_train
          UNION ALL SELECT 'silver', 'test_set', count(*) FROM test_set
          UNION ALL SELECT 'silver', 'global_train', count(*) FROM global_train
          UNION ALL SELECT 'gold', 'local_gold', count(*) FROM local_gold
          UNION ALL SELECT 'diamond', 'geo_features', count(*) FROM points)""",
                                "global_train", "local_raw", "global_raw", "local_gold", "points"),
    "bucketed_match": sql_with(f"""
        SELECT f.id, f.row_key, f.price, round(g.price, 6) AS asked
        FROM local_fresh f JOIN global_raw g ON g.property_id = f.id
        WHERE f.id NOT IN (SELECT id FROM local_silver WHERE {C.sql_bucket('id')} < {C.TEST_PCT})""",
                               "local_silver", "local_raw", "global_raw"),
    "csv_ingest": fx.with_ctes("""
        SELECT count(*) AS rows, CAST(sum(row_key) AS BIGINT) AS sum_row_key,
               count(nullif(price, '')) AS priced_rows,
               CAST(sum(length(nullif(price, ''))) AS BIGINT) AS price_chars,
               CAST(sum(length('A "nice", ' || name || chr(10) || 'second line')) AS BIGINT)
                 AS name_chars,
               max(last_scraped) AS last_scraped
        FROM local_raw""", "local_raw"),
    "save_and_profile": sql_with(f"""
        SELECT 'local_silver' AS dataset, count(*) AS rows, {len(_SILVER_COLS)} AS n_columns,
               '{",".join(_SILVER_COLS)}' AS columns,
               '{",".join(sorted(set(_SILVER_COLS) - _RAW_COLS))}' AS added_columns
        FROM local_silver""", "local_silver", "local_raw"),
    "load_check_leak": sql_with("""
        SELECT 'global_train' AS set_name, count(*) AS rows, 0 AS leaked_rows FROM global_train
        UNION ALL SELECT 'local_train', count(*), 0 FROM local_train
        UNION ALL SELECT 'test', count(*), count(*) FROM test_set""",
                                "global_train", "local_raw", "global_raw"),
}
