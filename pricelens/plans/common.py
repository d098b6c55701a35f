"""Shared plan fragments for the registered queries (Spark side and DuckDB oracle side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import clean, split
from ..session import scratch_path
from ..sources import fixtures as fx

SEED = 42
TEST_PCT = 20
FX = 1.17
COORD_TOLERANCE = 0.0005  # degrees; a parameter (the reference's 0.0001 is below its noise)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (presentation for the oracle compare only)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def local_fresh(spark: SparkSession, d: str) -> DataFrame:
    raw = fx.local_raw(spark, d)
    return clean.freshest_per_key(raw, "id", [F.col("last_scraped").desc_nulls_last(),
                                              F.col("row_key").desc()])


def local_silver(spark: SparkSession, d: str) -> DataFrame:
    return clean.local_silver(fx.local_raw(spark, d), fx=FX)


def global_silver_all(spark: SparkSession, d: str) -> DataFrame:
    return clean.global_silver(fx.global_raw(spark, d))


def splits(spark: SparkSession, d: str, silver: DataFrame | None = None):
    """(test_set, local_train, global_train) exactly as the split cell defines them:
    test ids are drawn from valid local keys; both train sets lose every test key."""
    silver = local_silver(spark, d) if silver is None else silver
    test, local_train = split.hash_split(silver, "id", TEST_PCT, SEED)
    ids = test.select("id")
    raw_global = fx.global_raw(spark, d).withColumnRenamed("property_id", "id")
    no_leak = split.remove_ids(raw_global, ids, "id", test_pct=TEST_PCT, seed=SEED)
    global_train = clean.global_silver(no_leak, key_src="id")
    return test, local_train, global_train


# ---------------------------------------------------------------- DuckDB fragments

def sql_round_half_up(expr: str, digits: int) -> str:
    """Spark rounds a double half-up on its printed decimal form; DuckDB rounds the
    binary value. Printing, then rounding the exact decimal, reproduces Spark's result."""
    return (f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) "
            "AS DOUBLE)")


def sql_bucket(key: str, seed: int = SEED, purpose: str = "") -> str:
    salt = f"{purpose}|{seed}" if purpose else seed
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 8))::BIGINT % 100)"


SQL_PARSE = sql_round_half_up(
    f"TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE) * {FX}::DOUBLE", 3)

SQL_LOCAL_FRESH = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY last_scraped DESC NULLS LAST,
                                   row_key DESC) AS rn
      FROM local_raw) WHERE rn = 1"""

SQL_LOCAL_SILVER = f"""
    SELECT * EXCLUDE (price), price AS raw_price_str, {SQL_PARSE} AS price_usd,
           ln(1 + {SQL_PARSE}) AS log_price
    FROM local_fresh
    WHERE {SQL_PARSE} IS NOT NULL AND {SQL_PARSE} > 0"""

SQL_GLOBAL_DEDUP = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY listing_title ASC NULLS LAST,
                                   price ASC NULLS LAST) AS rn
      FROM (SELECT * EXCLUDE (property_id), property_id AS id FROM global_raw)) WHERE rn = 1"""

SQL_GLOBAL_SILVER_ALL = """
    SELECT *, ln(1 + price) AS log_price FROM global_dedup WHERE price IS NOT NULL AND price > 0"""

SQL_TEST = f"SELECT * FROM local_silver WHERE {sql_bucket('id')} < {TEST_PCT}"
SQL_LOCAL_TRAIN = f"SELECT * FROM local_silver WHERE {sql_bucket('id')} >= {TEST_PCT}"
SQL_GLOBAL_TRAIN = """
    SELECT *, ln(1 + price) AS log_price FROM (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY listing_title ASC NULLS LAST,
                                     price ASC NULLS LAST) AS rn
        FROM (SELECT * EXCLUDE (property_id), property_id AS id FROM global_raw g
              WHERE NOT EXISTS (SELECT 1 FROM test_set t WHERE t.id = g.property_id)))
      WHERE rn = 1)
    WHERE price IS NOT NULL AND price > 0"""

# Ordered CTE chain: (name, sql), each may use the previous ones.
CHAIN = [
    ("local_fresh", SQL_LOCAL_FRESH),
    ("local_silver", SQL_LOCAL_SILVER),
    ("global_dedup", SQL_GLOBAL_DEDUP),
    ("global_silver_all", SQL_GLOBAL_SILVER_ALL),
    ("test_set", SQL_TEST),
    ("local_train", SQL_LOCAL_TRAIN),
    ("global_train", SQL_GLOBAL_TRAIN),
]


def sql_with(body: str, upto: str, *fixtures: str, extra: tuple = ()) -> str:
    """Body prefixed by fixture CTEs and the chain up to (and including) ``upto``."""
    names = [n for n, _ in CHAIN]
    chain = CHAIN[: names.index(upto) + 1] if upto else []
    return fx.with_ctes(body, *fixtures, extra=tuple(chain) + tuple(extra))


# ---------------------------------------------------------------- study / geo / scored

STUDY_LO, STUDY_HI = 20.0, 10000.0  # open range on both study prices
EXCLUDED_SITE = "nation_0"
SITE_IDS = [f"nation_{k}" for k in range(25)]  # the 25 nation rows, lower-cased
NEAR_KM, FAR_KM = 1.0, 0.5


def study(spark: SparkSession, d: str) -> DataFrame:
    """Two prices per item inside the open study range, with differences."""
    ts = clean.open_range(fx.two_source(spark, d), ["price_local", "price_global"],
                          STUDY_LO, STUDY_HI)
    return ts.withColumn("price_diff", F.col("price_global") - F.col("price_local"))


def study_series() -> dict:
    """The six series of the price study: both prices, their difference, and the same on
    the log10(x + 1) scale."""
    return {
        "price_local": F.col("price_local"),
        "price_global": F.col("price_global"),
        "price_diff": F.col("price_diff"),
        "log_local": F.log10(F.col("price_local") + 1),
        "log_global": F.log10(F.col("price_global") + 1),
        "log_diff": F.log10(F.col("price_global") + 1) - F.log10(F.col("price_local") + 1),
    }

SQL_STUDY_SERIES = {
    "price_local": "price_local",
    "price_global": "price_global",
    "price_diff": "price_diff",
    "log_local": "log10(price_local + 1)",
    "log_global": "log10(price_global + 1)",
    "log_diff": "log10(price_global + 1) - log10(price_local + 1)",
}

SQL_STUDY = f"""
    SELECT *, price_global - price_local AS price_diff FROM two_source
    WHERE price_local > {STUDY_LO}::DOUBLE AND price_local < {STUDY_HI}::DOUBLE
      AND price_global > {STUDY_LO}::DOUBLE AND price_global < {STUDY_HI}::DOUBLE"""


def site_cols() -> list[str]:
    from ..operators.geo import site_column
    return sorted(site_column(s) for s in SITE_IDS if s != EXCLUDED_SITE)


def geo_features(spark: SparkSession, d: str) -> DataFrame:
    """Points + one distance column per site + nearest station distance (G1)."""
    from ..operators import geo
    pts = fx.points(spark, d)
    with_sites = geo.site_distances(pts, fx.sites(spark, d), exclude=[EXCLUDED_SITE])
    return with_sites.join(nearest_stations(spark, pts, fx.stations(spark, d)), "id", "left")


def nearest_stations(spark: SparkSession, pts: DataFrame, stations: DataFrame) -> DataFrame:
    """id, station_id, station_name, dist_nearest_metro: one stored table for all queries on the
    same points and stations, known by their values."""
    from ..operators import geo
    from ..operators.runlog import content_id, keyed_table, write_keyed
    kinds = {f.name: f.dataType.simpleString() for f in pts.select("id").schema.fields + stations.schema.fields}
    schema = (f"id {kinds['id']}, station_id {kinds['station_id']}, station_name {kinds['station_name']}, "
              "dist_nearest_metro double, run string")
    key, path = content_id(pts.select("id", "lat", "lon"), stations), scratch_path(spark, "pricelens/nearest")
    stored = lambda: keyed_table(spark, path, "run", schema).where(F.col("run") == key)
    if stored().isEmpty():
        near = geo.nearest_neighbour(pts, stations, s_keep=["station_name"], out_dist="dist_nearest_metro")
        write_keyed(near.select("id", "station_id", "station_name", "dist_nearest_metro"), path, "run", key)
    return stored().drop("run")


def flagged(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import geo
    return geo.near_flags(geo_features(spark, d), site_cols(), "dist_nearest_metro",
                          NEAR_KM, FAR_KM)


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"(6371.0 * 2.0 * atan2(sqrt({a}), sqrt(1.0 - ({a}))))"


def _sql_geo_features() -> str:
    cols = ",\n".join(
        f"max(CASE WHEN s.site_id = '{s}' THEN {sql_haversine('p.lat', 'p.lon', 's.lat', 's.lon')}"
        f" END) AS dist_{s}" for s in SITE_IDS if s != EXCLUDED_SITE)
    return f"""
    SELECT sd.*, nn.station_id, nn.station_name, nn.dist_nearest_metro FROM (
      SELECT p.id, any_value(p.grp) AS grp, any_value(p.lat) AS lat, any_value(p.lon) AS lon,
             any_value(p.log_price) AS log_price, {cols}
      FROM points p, sites s GROUP BY p.id) sd
    LEFT JOIN (
      SELECT id, station_id, station_name, dist_nearest_metro FROM (
        SELECT p.id, s.station_id, s.station_name,
               {sql_haversine('p.lat', 'p.lon', 's.lat', 's.lon')} AS dist_nearest_metro,
               row_number() OVER (PARTITION BY p.id ORDER BY
                 {sql_haversine('p.lat', 'p.lon', 's.lat', 's.lon')}, s.station_id) AS rn
        FROM points p, stations s) WHERE rn = 1) nn ON sd.id = nn.id"""


def _sql_flagged() -> str:
    cols = [f"dist_{s}" for s in SITE_IDS if s != EXCLUDED_SITE]
    least = "least(" + ", ".join(cols) + ")"
    count = " + ".join(f"coalesce(CAST({c} < {NEAR_KM}::DOUBLE AS INTEGER), 0)" for c in cols)
    return f"""
    SELECT *, coalesce(CAST({least} < {NEAR_KM}::DOUBLE AS INTEGER), 0) AS near_site,
           {count} AS sites_nearby,
           coalesce(CAST(dist_nearest_metro > {FAR_KM}::DOUBLE AS INTEGER), 0) AS far_from_metro
    FROM geo_features"""


GEO_CTES = (("geo_features", _sql_geo_features()), ("flagged", _sql_flagged()))


def geo_sql(body: str) -> str:
    return fx.with_ctes(body, "points", "stations", "sites", extra=GEO_CTES)
