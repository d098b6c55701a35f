"""Registered queries: learning curve of local, hybrid and calibrated models (step 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells as cl
from ..operators import curve, geo, metrics, model, sampling, split
from ..operators.features import GLOBAL_CATEGORICAL, GLOBAL_NUMERIC
from ..sources import fixtures as fx
from . import common as C
from .models import _GLOBAL as GLOBAL_SOURCE
from .models import _fit, _numeric_flags, sources
from ..operators import features
from ..operators.runlog import content_id
from ..session import checkpointed, scratch_path

# Local preprocessor inputs (fixed lists): 19 listing columns, distances to six major
# sites, and three categories (missing -> 'other', lower-cased inside the pipeline).
MAJOR_SITES = ["nation_1", "nation_2", "nation_3", "nation_4", "nation_5", "nation_6"]
BASE_NUMERIC = ["host_is_superhost", "bedrooms", "beds", "bathrooms", "latitude", "longitude",
                "accommodates", "availability_365", "host_since", "number_of_reviews",
                "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                "review_scores_checkin", "review_scores_communication",
                "review_scores_location", "review_scores_value", "amenities_count",
                "reviews_per_month"]
LOCAL_NUMERIC = BASE_NUMERIC + [f"dist_{s}" for s in MAJOR_SITES]
GROUP = "neighbourhood_cleansed"
LOCAL_CATEGORICAL = ["neighbourhood_cleansed", "listing_type", "host_response_time"]

def diamond(spark: SparkSession, d: str):
    """Local train pool and hold-out, both with the global model's prediction (v7)."""
    _, _, path = _fit(spark, d)
    m = model.load_model(path)
    g = _numeric_flags(sources(spark, d)[1])
    g = geo.site_distances(g, fx.sites(spark, d), lat="latitude", lon="longitude",
                           only=MAJOR_SITES)  # v5: gold + distance features
    g = g.withColumns({c: g[c].cast("double") for c in LOCAL_NUMERIC})
    adapted = features.clean_cast(features.adapt_to_global(g), select=False)
    scored = model.score(m, adapted.select("id", *GLOBAL_NUMERIC, *GLOBAL_CATEGORICAL), ["id"])
    v7 = checkpointed(g.join(scored, "id"))
    test, train = split.hash_split(v7, "id", C.TEST_PCT, C.SEED)
    return train, test


def _run(spark: SparkSession, d: str) -> DataFrame:
    """The full grid. The log's folder follows from the rows themselves: on the same data a
    second query, or a run after a failure, finds the cells that are done."""
    train, test = diamond(spark, d)
    cols = ["id", "log_price", "global_pred_log", *LOCAL_NUMERIC, *LOCAL_CATEGORICAL]
    train, test = train.select(*cols), test.select(*cols)
    cfg = curve.CurveConfig()
    log = scratch_path(spark, f"pricelens/curve/{cfg.tag()}-{content_id(train, test)}")
    return curve.run_learning_curve(train, test, LOCAL_NUMERIC, LOCAL_CATEGORICAL, cfg, log=log)


def learning_curve(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)


def learning_curve_agg(spark: SparkSession, d: str) -> DataFrame:
    return curve.curve_means(_run(spark, d))


# What SQL can tell of the curve, on the same local pool with a fixed stand-in for the global
# model's prediction: the cells, the preparation each of them fits, and the baseline's means.

def _pool(spark: SparkSession, d: str):
    g = _numeric_flags(sources(spark, d)[1])
    g = g.withColumns({c: g[c].cast("double") for c in BASE_NUMERIC})
    test, train = split.hash_split(g.withColumn("global_pred_log", F.col("log_price") * 0.9 + 0.5), "id",
                                   C.TEST_PCT, C.SEED)
    return train, test


def _grid(spark: SparkSession, d: str):
    train, test = (checkpointed(x) for x in _pool(spark, d))
    drawn, cells = curve.grid(train, test, "id", GROUP, curve.CurveConfig())
    return test, drawn, cells


def curve_cells(spark: SparkSession, d: str) -> DataFrame:
    """Per cell of the full grid the rows drawn (their number and the sum
    of their ids) and the rows it is tested on."""
    _, drawn, cells = _grid(spark, d)
    about = spark.createDataFrame(
        [(c.cell, c.method, c.iteration, c.rows, c.test_rows) for c in cells],
        "cell int, sampling_method string, iteration int, n_size long, test_rows long")
    return about.join(drawn.groupBy("cell").agg(F.sum("id").alias("id_sum")), "cell", "left")


def curve_preparation(spark: SparkSession, d: str) -> DataFrame:
    """Median, mean and deviation of every numeric column in every cell."""
    _, drawn, _ = _grid(spark, d)
    p = cl.fit_preparation(drawn, BASE_NUMERIC, LOCAL_CATEGORICAL)
    rows = F.arrays_zip(F.array(*[F.lit(c) for c in BASE_NUMERIC]).alias("name"), "medians", "means", "deviations")
    r = p.select("cell", F.explode(rows).alias("r"))
    return C.round_doubles(r.select("cell", F.col("r.name").alias("column_name"), F.col("r.medians").alias("median"),
                                    F.col("r.means").alias("mean"), F.col("r.deviations").alias("deviation")))


def curve_categories(spark: SparkSession, d: str) -> DataFrame:
    """The category index of every cell."""
    _, drawn, _ = _grid(spark, d)
    p = cl.fit_preparation(drawn, BASE_NUMERIC, LOCAL_CATEGORICAL)
    names = F.array(*[F.lit(c) for c in LOCAL_CATEGORICAL])
    each = p.select("cell", F.posexplode("categories").alias("j", "m")).select(
        "cell", names[F.col("j")].alias("column_name"), F.explode("m").alias("value", "at"))
    return each.select("cell", "column_name", "value", F.col("at").cast("int").alias("position"))


def curve_baseline(spark: SparkSession, d: str) -> DataFrame:
    """Means of the baseline's metrics over the cells, as the chart shows them."""
    test, _, cells = _grid(spark, d)
    chosen = [c for c in cells if c.rows and c.test_rows >= curve.CurveConfig().min_test_rows]
    about = spark.createDataFrame([(c.cell, c.method, c.iteration, c.rows) for c in chosen],
                                  "cell int, sampling_method string, iteration int, n_size long")
    m = metrics.dollar_metrics(cl.tested_rows(test, chosen, GROUP), "log_price", "global_pred_log", ["cell"])
    full = curve.result_rows(curve.baseline_predictions(test, "log_price", "global_pred_log"), 0, "baseline_full", 0)
    rows = m.join(F.broadcast(about), "cell").withColumn("model", F.lit(curve.BASELINE)).select(*full.columns)
    shown = sampling.in_groups(rows.unionByName(full), "sampling_method", ["random", "spatial"])  # P16
    return C.round_doubles(curve.curve_means(shown))


QUERIES = {"learning_curve": learning_curve, "learning_curve_agg": learning_curve_agg, "curve_cells": curve_cells,
           "curve_preparation": curve_preparation, "curve_categories": curve_categories,
           "curve_baseline": curve_baseline}

_GRID = curve.CurveConfig()
_LOCAL = (f"SELECT * REPLACE (CASE WHEN host_is_superhost = 't' THEN 1.0 ELSE 0.0 END AS host_is_superhost), "
          f"log_price * 0.9 + 0.5 AS global_pred_log FROM local_gold WHERE NOT ({GLOBAL_SOURCE})")
_CELLS = (
    ("pool", _LOCAL),
    ("train", f"SELECT * FROM pool WHERE {C.sql_bucket('id')} >= {C.TEST_PCT}"),
    ("test", f"SELECT * FROM pool WHERE {C.sql_bucket('id')} < {C.TEST_PCT}"),
    ("sized", "SELECT * FROM (VALUES " + ", ".join(
        f"({it}, {n}, {b})" for it, (n, b) in enumerate(zip(_GRID.sizes, _GRID.block_sizes), 1)) + ") v(it, n, size)"),
    ("place", f"""SELECT {GROUP} AS g, row_number() OVER (ORDER BY md5({GROUP} || '|{C.SEED}'), {GROUP}) - 1 AS pos
        FROM (SELECT DISTINCT {GROUP} FROM train WHERE {GROUP} IS NOT NULL)"""),
    ("blocks", "SELECT it, CAST(floor(pos / size) AS INTEGER) AS block, g FROM sized, place"),
    ("chosen", f"""SELECT it, block, row_number() OVER (PARTITION BY it ORDER BY block) - 1 AS i FROM (
        SELECT it, block, row_number() OVER (PARTITION BY it ORDER BY md5(block || '|{C.SEED}'), block) AS r
        FROM (SELECT DISTINCT it, block FROM blocks)) WHERE r <= {_GRID.repetitions}"""),
    ("asked", f"""SELECT it, n, i, {_GRID.seed} * 1000 + it * 10 + i AS seed, kind FROM sized,
          range({_GRID.repetitions}) AS r(i), (VALUES ('random'), ('spatial')) k(kind)
        WHERE kind = 'random' OR (it, i) IN (SELECT (it, i) FROM chosen)"""),
    ("cells", """SELECT CAST(row_number() OVER (ORDER BY it, i, kind) - 1 AS INTEGER) AS cell, *
        FROM asked"""),
    ("has", """SELECT cell, g FROM cells JOIN chosen USING (it, i) JOIN blocks USING (it, block)
        WHERE kind = 'spatial'"""),
    ("drawn", f"""SELECT * FROM (SELECT cell, n, t.*, row_number() OVER (PARTITION BY cell
          ORDER BY md5(id || '|' || seed), id) AS rank FROM cells c JOIN train t ON c.kind = 'random'
          OR t.{GROUP} IN (SELECT g FROM has h WHERE h.cell = c.cell)) WHERE rank <= n"""),
    ("tested", f"""SELECT cell, t.* FROM cells c JOIN test t ON c.kind = 'random'
          OR t.{GROUP} IN (SELECT g FROM has h WHERE h.cell = c.cell)"""),
    ("about", """SELECT cell, kind AS sampling_method, CAST(it AS INTEGER) AS iteration,
          (SELECT count(*) FROM drawn d WHERE d.cell = c.cell) AS n_size,
          (SELECT count(*) FROM tested d WHERE d.cell = c.cell) AS test_rows FROM cells c"""),
)


def _sql(body: str, *more: tuple) -> str:
    return fx.with_ctes(body, "local_gold", extra=(*_CELLS, *more))


def _per_column(c: str) -> str:
    return f"""SELECT cell, '{c}' AS column_name, round(m, 6) AS median, round(avg(coalesce({c}, m)), 6) AS mean,
        round(stddev_pop(coalesce({c}, m)), 6) AS deviation
      FROM (SELECT cell, CAST({c} AS DOUBLE) AS {c}, median(CAST({c} AS DOUBLE)) OVER (PARTITION BY cell) AS m
            FROM drawn) GROUP BY cell, m"""


ORACLE = {
    "curve_cells": _sql("""
        SELECT a.cell, sampling_method, iteration, n_size, test_rows, CAST(s AS BIGINT) AS id_sum
        FROM about a LEFT JOIN (SELECT cell, sum(id) AS s FROM drawn GROUP BY cell) USING (cell)"""),
    "curve_preparation": _sql(" UNION ALL ".join(_per_column(c) for c in BASE_NUMERIC)),
    "curve_categories": _sql(" UNION ALL ".join(f"""
        SELECT cell, '{c}' AS column_name, value, CAST(row_number() OVER (
          PARTITION BY cell ORDER BY count(*) DESC, value) - 1 AS INTEGER) AS position
        FROM (SELECT cell, lower(coalesce({c}, 'other')) AS value FROM drawn) GROUP BY cell, value"""
                                                for c in LOCAL_CATEGORICAL)),
    "curve_baseline": _sql(f"""
        SELECT sampling_method, '{curve.BASELINE}' AS model, iteration, round(avg(n_size), 6) AS n_size,
               round(avg(mae), 6) AS dollar_mae, round(avg(rmse), 6) AS dollar_rmse,
               round(avg(r2), 6) AS dollar_r2, round(avg(mape), 6) AS dollar_mape,
               '{curve.DISPLAY_NAMES[curve.BASELINE]}' AS display_name
        FROM about JOIN (
          SELECT cell, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
                 1 - sum((y - p) * (y - p)) / nullif(count(*) * var_pop(y), 0) AS r2,
                 avg(CASE WHEN y > 0 THEN abs(y - p) / y END) AS mape
          FROM (SELECT cell, exp(log_price) - 1 AS y, greatest(exp(global_pred_log) - 1, 0) AS p FROM tested)
          GROUP BY cell) USING (cell)
        WHERE n_size > 0 AND test_rows >= {_GRID.min_test_rows} GROUP BY 1, 3"""),
}
