"""Domain tables derived from the provided TPC-H-style Parquet tables.

The library's operators expect listing-shaped tables (see FIXTURES.md). These functions
derive them lazily from the given tables, so every query's work grows with the data.
Each Spark builder has a DuckDB twin (``SQL``) used by the correctness oracle; both are
plain arithmetic and must stay in step.

Mapping (fixed choices):

* local listings (``local_raw``): one row per order. id = customer key, scrape time =
  order date, raw row key = order key, price text = '$' + thousands-formatted total
  price; pending orders carry dirty price text (null for 5-LOW, blank for
  4-NOT SPECIFIED, 'n/a' for 3-MEDIUM). Coordinates come from the customer key.
* global listings (``global_raw``): one row per customer; price = account balance
  (zero or negative balances are natural invalid prices); coordinates shifted north by
  0.00015 degrees per nation key; location = market segment.
* two price sources for one item (``two_source``): part retail price vs the mean unit
  price of the part's line items.
* points / stations / sites: customers, suppliers, nations with computed coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed coordinate rule: a 0.1 x 0.2 degree box south-west of Paris centre.
LAT0, LON0 = 48.80, 2.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(key: str, mult: int, modulus: int) -> F.Column:
    return F.lit(LAT0) + F.pmod(F.col(key) * mult, F.lit(modulus)) * F.lit(0.0001)


def _lon(key: str, mult: int, modulus: int) -> F.Column:
    return F.lit(LON0) + F.pmod(F.col(key) * mult, F.lit(modulus)) * F.lit(0.0002)


def local_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price_text = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"),
               F.lit(None).cast("string"))
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED"),
              F.lit(""))
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "3-MEDIUM"),
              F.lit("n/a"))
        .otherwise(F.concat(F.lit("$"), F.format_number(
            F.col("o_totalprice").cast("decimal(14,2)"), 2)))
    )
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("row_key"),
        _lat("o_custkey", 37, 1000).alias("latitude"),
        _lon("o_custkey", 91, 1000).alias("longitude"),
        F.concat(F.lit("Listing "), F.col("o_orderkey").cast("string")).alias("name"),
        F.concat(F.lit("https://listings.example/rooms/"),
                 F.col("o_orderkey").cast("string")).alias("listing_url"),
        price_text.alias("price"),
        F.col("o_orderdate").alias("last_scraped"),
    )


def global_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("property_id"),
        (_lat("c_custkey", 37, 1000) + F.col("c_nationkey") * F.lit(0.00015)).alias("lat"),
        _lon("c_custkey", 91, 1000).alias("long"),
        F.col("c_name").alias("listing_title"),
        F.col("c_acctbal").alias("price"),
        F.col("c_mktsegment").alias("location"),
    )


def two_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, price_local (retail price), price_global (mean unit price of its line items)."""
    li = table(spark, sf_dir, "lineitem")
    unit = (li.groupBy("l_partkey")
            .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price_global")))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                            F.col("p_retailprice").alias("price_local"))
    return p.join(unit, p.id == unit.l_partkey, "inner").select("id", "price_local", "price_global")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as points: id, grp (neighbourhood), lat, lon, log_price."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("grp"),
        _lat("c_custkey", 37, 1000).alias("lat"),
        _lon("c_custkey", 91, 1000).alias("lon"),
        F.log1p(F.abs(F.col("c_acctbal"))).alias("log_price"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        _lat("s_suppkey", 53, 997).alias("lat"),
        _lon("s_suppkey", 29, 997).alias("lon"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named sites (monuments): one per nation, site_id = lower-case nation name."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lower(F.col("n_name")).alias("site_id"),
        F.col("n_name").alias("name"),
        (F.lit(LAT0) + F.pmod(F.col("n_nationkey") * 7, F.lit(25)) * F.lit(0.004)).alias("lat"),
        (F.lit(LON0) + F.pmod(F.col("n_nationkey") * 11, F.lit(25)) * F.lit(0.008)).alias("lon"),
    )


def amenity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, amenities: JSON array text = a run of the shared amenity names chosen by the
    part size (start p_size % 19, length p_size % 7 + 1) followed by the part-name words."""
    from ..operators.features import SHARED_AMENITIES
    p = table(spark, sf_dir, "part")
    vocab = F.array(*[F.lit(a) for a in SHARED_AMENITIES])
    run = F.slice(vocab, F.pmod(F.col("p_size"), F.lit(19)) + 1, F.pmod(F.col("p_size"), F.lit(7)) + 1)
    words = F.concat(run, F.split(F.col("p_name"), " "))
    return p.select(F.col("p_partkey").alias("id"), F.to_json(words).alias("amenities"))


def local_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing feature table (gold v4 contract) with one row per customer with orders.

    Order history stands in for listing attributes (fixed rules, see SQL twin)."""
    o = table(spark, sf_dir, "orders")
    agg = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("nf"),
        F.count_if(F.col("o_orderstatus") == "O").alias("no"),
        F.count_if(F.col("o_orderstatus") == "P").alias("np"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("nu"),
        F.avg("o_totalprice").alias("avg_tp"), F.max("o_totalprice").alias("max_tp"),
        F.min("o_totalprice").alias("min_tp"),
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")  # fixed 25-row dimension
    j = agg.join(c, agg.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("c_custkey").alias("id"),
        (F.lit(3.0) + F.lit(0.25) * F.log1p(F.col("n")) + F.lit(0.8) * F.col("avg_tp") / F.lit(100000.0)
         + F.lit(0.3) * F.col("np") / F.col("n")
         + (F.pmod(F.col("c_custkey") * 7919, F.lit(101)) - 50) * F.lit(0.004)).alias("log_price"),
        _lat("c_custkey", 37, 1000).alias("latitude"),
        _lon("c_custkey", 91, 1000).alias("longitude"),
        F.col("n").alias("accommodates"),
        F.col("nf").alias("beds"),
        F.col("no").alias("bedrooms"),
        (F.col("np") * F.lit(0.5)).alias("bathrooms"),
        F.col("n").alias("number_of_reviews"),
        (F.col("n") / F.lit(12.0)).alias("reviews_per_month"),
        F.pmod(F.datediff(F.col("last"), F.col("first")), F.lit(366)).alias("availability_365"),
        (F.col("nf") % 7 + 3).alias("amenities_count"),
        (F.col("np") > 0).cast("int").alias("has_dishwasher"),
        (F.col("no") > 2).cast("int").alias("has_washer"),
        F.when(F.col("nu") >= 2, F.lit("t")).otherwise(F.lit("f")).alias("host_is_superhost"),
        F.year(F.col("first")).alias("host_since"),
        (F.col("avg_tp") / F.lit(100000.0)).alias("review_scores_rating"),
        (F.col("max_tp") / F.lit(100000.0)).alias("review_scores_accuracy"),
        (F.col("min_tp") / F.lit(100000.0)).alias("review_scores_cleanliness"),
        (F.col("avg_tp") / F.lit(50000.0)).alias("review_scores_checkin"),
        (F.col("nf") / F.col("n")).alias("review_scores_communication"),
        (F.col("no") / F.col("n")).alias("review_scores_location"),
        (F.col("np") / F.col("n")).alias("review_scores_value"),
        F.col("n_name").alias("neighbourhood_cleansed"),
        F.col("c_mktsegment").alias("listing_type"),
        F.when(F.col("np") > 3, F.lit("within an hour")).when(F.col("np") > 1, F.lit("within a day"))
        .alias("host_response_time"),
    )


def _amenity_sql_list() -> str:
    from ..operators.features import SHARED_AMENITIES
    return "[" + ", ".join("'" + a + "'" for a in SHARED_AMENITIES) + "]"


_AMENITY_LIST = _amenity_sql_list()

# DuckDB twins, as CTE bodies over the pre-registered views.
SQL = {
    "amenity_text": f"""
        SELECT p_partkey AS id,
               to_json(list_concat(list_slice({_AMENITY_LIST}, p_size % 19 + 1,
                                              p_size % 19 + p_size % 7 + 1),
                                   string_split(p_name, ' '))) AS amenities
        FROM part""",
    "local_gold": """
        SELECT c_custkey AS id,
               3.0::DOUBLE + 0.25::DOUBLE * ln(1 + n) + 0.8::DOUBLE * avg_tp / 100000.0::DOUBLE
                 + 0.3::DOUBLE * np / n + ((c_custkey * 7919) % 101 - 50) * 0.004::DOUBLE AS log_price,
               48.80::DOUBLE + ((c_custkey * 37) % 1000) * 0.0001::DOUBLE AS latitude,
               2.25::DOUBLE + ((c_custkey * 91) % 1000) * 0.0002::DOUBLE AS longitude,
               n AS accommodates, nf AS beds, no AS bedrooms, np * 0.5::DOUBLE AS bathrooms,
               n AS number_of_reviews, n / 12.0::DOUBLE AS reviews_per_month,
               CAST(date_diff('day', CAST(first AS DATE), CAST(last AS DATE)) % 366 AS INTEGER)
                 AS availability_365,
               nf % 7 + 3 AS amenities_count,
               CAST(np > 0 AS INTEGER) AS has_dishwasher, CAST(no > 2 AS INTEGER) AS has_washer,
               CASE WHEN nu >= 2 THEN 't' ELSE 'f' END AS host_is_superhost,
               CAST(year(first) AS INTEGER) AS host_since,
               avg_tp / 100000.0::DOUBLE AS review_scores_rating,
               max_tp / 100000.0::DOUBLE AS review_scores_accuracy,
               min_tp / 100000.0::DOUBLE AS review_scores_cleanliness,
               avg_tp / 50000.0::DOUBLE AS review_scores_checkin,
               nf / n AS review_scores_communication, no / n AS review_scores_location,
               np / n AS review_scores_value,
               n_name AS neighbourhood_cleansed, c_mktsegment AS listing_type,
               CASE WHEN np > 3 THEN 'within an hour' WHEN np > 1 THEN 'within a day' END
                 AS host_response_time
        FROM (SELECT o_custkey, count(*) AS n, count_if(o_orderstatus = 'F') AS nf,
                     count_if(o_orderstatus = 'O') AS no, count_if(o_orderstatus = 'P') AS np,
                     count_if(o_orderpriority = '1-URGENT') AS nu, avg(o_totalprice) AS avg_tp,
                     max(o_totalprice) AS max_tp, min(o_totalprice) AS min_tp,
                     min(o_orderdate) AS first, max(o_orderdate) AS last
              FROM orders GROUP BY o_custkey) a
        JOIN customer ON a.o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "local_raw": """
        SELECT o_custkey AS id, o_orderkey AS row_key,
               48.80::DOUBLE + ((o_custkey * 37) % 1000) * 0.0001::DOUBLE AS latitude,
               2.25::DOUBLE + ((o_custkey * 91) % 1000) * 0.0002::DOUBLE AS longitude,
               'Listing ' || CAST(o_orderkey AS VARCHAR) AS name,
               'https://listings.example/rooms/' || CAST(o_orderkey AS VARCHAR) AS listing_url,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN ''
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'n/a'
                    ELSE '$' || format('{:,.2f}', o_totalprice) END AS price,
               o_orderdate AS last_scraped
        FROM orders""",
    "global_raw": """
        SELECT c_custkey AS property_id,
               48.80::DOUBLE + ((c_custkey * 37) % 1000) * 0.0001::DOUBLE
                 + c_nationkey * 0.00015::DOUBLE AS lat,
               2.25::DOUBLE + ((c_custkey * 91) % 1000) * 0.0002::DOUBLE AS long,
               c_name AS listing_title, c_acctbal AS price, c_mktsegment AS location
        FROM customer""",
    "two_source": """
        SELECT p_partkey AS id, p_retailprice AS price_local, u.price_global
        FROM part JOIN (SELECT l_partkey, avg(l_extendedprice / l_quantity) AS price_global
                        FROM lineitem GROUP BY l_partkey) u ON p_partkey = u.l_partkey""",
    "points": """
        SELECT c_custkey AS id, c_nationkey AS grp,
               48.80::DOUBLE + ((c_custkey * 37) % 1000) * 0.0001::DOUBLE AS lat,
               2.25::DOUBLE + ((c_custkey * 91) % 1000) * 0.0002::DOUBLE AS lon,
               ln(1 + abs(c_acctbal)) AS log_price
        FROM customer""",
    "stations": """
        SELECT s_suppkey AS station_id, s_name AS station_name,
               48.80::DOUBLE + ((s_suppkey * 53) % 997) * 0.0001::DOUBLE AS lat,
               2.25::DOUBLE + ((s_suppkey * 29) % 997) * 0.0002::DOUBLE AS lon
        FROM supplier""",
    "sites": """
        SELECT lower(n_name) AS site_id, n_name AS name,
               48.80::DOUBLE + ((n_nationkey * 7) % 25) * 0.004::DOUBLE AS lat,
               2.25::DOUBLE + ((n_nationkey * 11) % 25) * 0.008::DOUBLE AS lon
        FROM nation""",
}


def with_ctes(sql_body: str, *names: str, extra: tuple = ()) -> str:
    """Prefix a query with the named fixture CTEs, then ``extra`` (name, sql) CTEs."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({q})" for n, q in extra]
    if sql_body.lstrip().upper().startswith("WITH"):
        sql_body = f"SELECT * FROM ({sql_body})"
    return "WITH " + ",\n".join(parts) + "\n" + sql_body
