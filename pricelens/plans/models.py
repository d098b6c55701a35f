"""Registered queries: global price model and calibration (build step 9, rows-only check)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, model, split
from ..operators.features import GLOBAL_CATEGORICAL, GLOBAL_NUMERIC, LOCAL_TO_GLOBAL
from ..operators.runlog import content_id
from ..session import checkpointed, scratch_path
from ..sources import fixtures as fx
from . import common as C

GLOBAL_PCT, ORIGIN_SEED = 50, 11  # which listings stand for the global source
SELECTION_SEED = 7  # model-selection split; differs from the hold-out seed on purpose


def _tag(d: str) -> str:
    return hashlib.md5(d.encode()).hexdigest()[:10]


def _numeric_flags(df: DataFrame) -> DataFrame:
    """H3: the superhost text flag becomes 1.0 / 0.0 before modelling."""
    return df.withColumn("host_is_superhost", features.superhost_flag("host_is_superhost"))


def sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(global listings, local listings): two sources that share no listing."""
    return split.hash_split(fx.local_gold(spark, d), "id", GLOBAL_PCT, ORIGIN_SEED)


def global_gold(spark: SparkSession, d: str) -> DataFrame:
    """Global-source feature table in the global model's names, with the location taken from
    the data (nation / segment). It shares no listing with the local pool, so the global
    model's predictions for local rows are out of sample."""
    a = features.adapt_to_global(_numeric_flags(sources(spark, d)[0]), literals={})
    a = a.withColumns({"country": F.lower("neighbourhood_cleansed"),
                       "city": F.lower("neighbourhood_cleansed"),
                       "region": F.lower("listing_type")})
    return features.clean_cast(a)


def local_test(spark: SparkSession, d: str) -> DataFrame:
    """Hold-out listings of the local source, adapted to the global names (location
    literals are categories the global model never saw -> all-zero one-hot)."""
    g = _numeric_flags(sources(spark, d)[1])
    test, _ = split.hash_split(g, "id", C.TEST_PCT, C.SEED)
    return features.clean_cast(features.adapt_to_global(test), select=False)


LOG = "pricelens/run_log"
VERSION = 2  # of the settings of the fit


def _fit(spark: SparkSession, d: str):
    """(rows of the leaderboard, name of the best, path of its model). A run is known by the
    values of its rows: it is fitted once, and found in the run log after that."""
    gg = checkpointed(global_gold(spark, d))
    run = f"{VERSION}-{content_id(gg)}"
    path, log = scratch_path(spark, f"pricelens/models/{run}"), scratch_path(spark, LOG)
    rows = model.run_log(spark, log).where(F.col("run_id") == run).collect()  # one per candidate
    if not rows:
        # Feature columns by type after the cleaning cast (every numeric is double by now)
        numeric = features.columns_of_type(gg, numeric=True, exclude=["log_price", "id"])
        categorical = features.columns_of_type(gg, numeric=False, exclude=["log_price", "id"])
        sel_test, sel_train = split.hash_split(gg, "id", 20, SELECTION_SEED)
        board = model.compare_candidates(sel_train, sel_test, numeric, categorical, model.reference_candidates(C.SEED))
        best = board.first()["model"]
        cand = {c.name: c for c in model.reference_candidates(C.SEED)}[best]
        model.save_model(model.fit_pipeline(gg, numeric, categorical, cand), path)
        model.log_run(board, log, run)  # last: a run in the log has its model
        rows = model.run_log(spark, log).where(F.col("run_id") == run).collect()
    rows = sorted(rows, key=lambda r: (r["mae"], r["model"]))
    return rows, rows[0]["model"], path


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """The run of these data as the log has it, after it has been logged once more."""
    rows, _, path = _fit(spark, d)
    log, run = scratch_path(spark, LOG), path.rstrip("/").split("/")[-1]
    mine = lambda: model.run_log(spark, log).where(F.col("run_id") == run)
    model.log_run(spark.createDataFrame(rows, mine().schema).drop("run_id", "logged_at"), log, run)
    return mine().groupBy("model", "params", "n", "skipped_train_rows").agg(
        F.count("*").alias("copies"), (F.min("mae") > 0).alias("has_metrics"),
        F.max("logged_at").isNotNull().alias("has_time"))


def model_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    rows, _, _ = _fit(spark, d)
    return spark.createDataFrame(rows).select("model", "n", "mae", "medae", "mape_pct", "rmse",
                                              "r2_log", "skipped_train_rows")


def score_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Reload the saved best model and evaluate it on the local hold-out."""
    _, best, path = _fit(spark, d)
    m = model.load_model(path)
    pred = m.transform(local_test(spark, d))
    from ..operators.metrics import log_model_metrics
    return log_model_metrics(pred, "log_price", "prediction", exact_median=False) \
        .withColumn("model", F.lit(best))


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    _, _, path = _fit(spark, d)
    m = model.load_model(path)
    t = model.transformed_features(m, global_gold(spark, d))
    return model.feature_importance(m, t, 10)


def batch_score(spark: SparkSession, d: str) -> DataFrame:
    """Hold-out rows keep their original columns and gain global_pred_log."""
    _, _, path = _fit(spark, d)
    m = model.load_model(path)
    test, _ = split.hash_split(sources(spark, d)[1], "id", C.TEST_PCT, C.SEED)
    cleaned = local_test(spark, d).select("id", *GLOBAL_NUMERIC, *GLOBAL_CATEGORICAL)
    scored = model.score(m, cleaned, ["id"])
    return test.join(scored, "id")


def model_preparation(spark: SparkSession, d: str) -> DataFrame:
    """What the saved model has learnt to prepare its inputs with: the median of
    every numeric column and the position of every category (the most frequent first)."""
    from pyspark.ml.feature import ImputerModel, StringIndexerModel
    _, _, path = _fit(spark, d)
    rows: list[tuple] = []
    for stage in model.load_model(path).stages:  # fitted parameters
        if isinstance(stage, ImputerModel):
            rows += [(c, None, None, float(v)) for c, v in stage.surrogateDF.first().asDict().items()]
        if isinstance(stage, StringIndexerModel):
            rows += [(stage.getInputCol(), label, i, None) for i, label in enumerate(stage.labels)]
    return C.round_doubles(spark.createDataFrame(
        rows, "column_name string, label string, position int, median double"))


def calibration_report(spark: SparkSession, d: str) -> DataFrame:
    """M17 + A24: robust calibration of one source's price onto the other's."""
    ts = fx.two_source(spark, d)
    test, train = split.hash_split(ts, "id", C.TEST_PCT, C.SEED)
    cal = model.calibrate(train, test, "price_global", "price_local")
    return model.calibration_summary(cal)


def visual_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Chart tables of the chosen model on the local hold-out, written to the shared
    scratch area; returns one row per written table with its row count."""
    _, best, path = _fit(spark, d)
    m = model.load_model(path)
    pred = m.transform(local_test(spark, d))
    out = scratch_path(spark, f"pricelens/visuals/{_tag(d)}")
    paths = model.log_visualizations(pred, m, model.transformed_features(m, global_gold(spark, d)),
                                     out)
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, p in paths.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def batch_score_rows(spark: SparkSession, d: str) -> DataFrame:
    """M11, what SQL can tell: every hold-out listing is scored once, its label and category
    untouched, with a prediction within the range of the labels that the model has seen, and the
    mean of the squared errors is under the variance of the labels."""
    s = checkpointed(batch_score(spark, d))
    seen = global_gold(spark, d).agg(F.min("log_price").alias("least"), F.max("log_price").alias("most"))
    fit = s.agg((F.avg(F.pow(F.col("global_pred_log") - F.col("log_price"), 2)) < F.var_pop("log_price")).alias("better"))
    s = s.crossJoin(F.broadcast(seen)).crossJoin(F.broadcast(fit))  # one row each
    near = F.col("global_pred_log").between(F.col("least") - 0.05, F.col("most") + 0.05) & F.col("better")
    return s.select("id", F.round("log_price", 6).alias("log_price"), "neighbourhood_cleansed",
                    near.alias("near_label"))


def model_checks(spark: SparkSession, d: str) -> DataFrame:
    """M5-M9, what SQL can tell: each candidate is scored on all rows of the selection slice,
    mae is what its rank says, it beats the mean of the log price, and the best one also does
    in dollars (those errors of the mean are returned; the candidate with the absolute loss
    need not beat them on few rows)."""
    rows, _, _ = _fit(spark, d)
    maes = sorted(r["mae"] for r in rows)
    sel_test, _ = split.hash_split(global_gold(spark, d), "id", 20, SELECTION_SEED)
    level = sel_test.agg(F.avg("log_price").alias("level"))
    y = F.expm1("log_price")
    plain = sel_test.crossJoin(F.broadcast(level)).agg(  # one row
        F.avg(F.abs(y - F.expm1("level"))).alias("mean_mae"), F.sqrt(F.avg(F.pow(y - F.expm1("level"), 2))).alias("mean_rmse"))
    out = spark.createDataFrame([(r["model"], r["n"], r["mae"], r["rmse"], r["r2_log"] > 0, maes.index(r["mae"]) == i)
                                 for i, r in enumerate(rows)],
                                "model string, n long, mae double, rmse double, beats_mean boolean, in_order boolean")
    return C.round_doubles(out.crossJoin(F.broadcast(plain)).select(
        "model", "n", "mean_mae", "mean_rmse", "beats_mean", "in_order",
        ((F.col("mae") < F.col("mean_mae")) & (F.col("rmse") < F.col("mean_rmse")) | (F.col("mae") > maes[0]))
        .alias("best_bounded")))


def importance_check(spark: SparkSession, d: str) -> DataFrame:
    """D9, what SQL can tell: importances are shares of one, the price level leads."""
    _, _, path = _fit(spark, d)
    m = model.load_model(path)
    t = model.transformed_features(m, global_gold(spark, d))
    every = model.feature_importance(m, t, 100_000)
    return every.agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
                     (F.min("importance") >= 0).alias("no_negative")).crossJoin(
        global_gold(spark, d).agg(F.count(F.lit(1)).alias("train_rows")))


def calibration_check(spark: SparkSession, d: str) -> DataFrame:
    """M17 and A24, what SQL can tell: errors before calibration, and that the robust fit
    lowers the mean absolute error."""
    c = calibration_report(spark, d)
    return C.round_doubles(c.select("rmse_raw", "mae_raw", "bias_raw",
                                    (F.col("mae_cal") < F.col("mae_raw")).alias("improves")))


QUERIES = {
    "batch_score_rows": batch_score_rows,
    "model_checks": model_checks,
    "importance_check": importance_check,
    "calibration_check": calibration_check,
    "run_log": run_log,
    "model_preparation": model_preparation,
    "visual_bundle": visual_bundle,
    "model_leaderboard": model_leaderboard,
    "score_holdout": score_holdout,
    "feature_importance": feature_importance,
    "batch_score": batch_score,
    "calibration_report": calibration_report,
}

_GLOBAL = f"{C.sql_bucket('id', ORIGIN_SEED)} < {GLOBAL_PCT}"



def _source(c: str) -> str:
    return "CASE WHEN host_is_superhost = 't' THEN 1.0 ELSE 0.0 END" if c == "host_is_superhost" else c


# Fits are iterative: their values are tested, SQL checks what it can tell of them.
ORACLE = {
    "batch_score_rows": fx.with_ctes(f"""
        SELECT id, round(log_price, 6) AS log_price, neighbourhood_cleansed, TRUE AS near_label
        FROM local_gold WHERE NOT ({_GLOBAL}) AND {C.sql_bucket('id')} < {C.TEST_PCT}""",
                                     "local_gold"),
    "model_checks": fx.with_ctes(f"""
        SELECT model, n, round(mean_mae, 6) AS mean_mae, round(mean_rmse, 6) AS mean_rmse,
               TRUE AS beats_mean, TRUE AS in_order, TRUE AS best_bounded
        FROM (SELECT unnest(['GBT_Deep', 'GBT_Shallow', 'GBT_Robust_MAE', 'RandomForest_Baseline'])
                AS model),
             (SELECT count(*) AS n, avg(abs(y - m)) AS mean_mae, sqrt(avg(pow(y - m, 2))) AS mean_rmse
              FROM (SELECT exp(log_price) - 1 AS y, exp(avg(log_price) OVER ()) - 1 AS m FROM local_gold
                    WHERE {_GLOBAL} AND {C.sql_bucket('id', SELECTION_SEED)} < 20))""", "local_gold"),
    "visual_bundle": fx.with_ctes(f"""
        SELECT 'importance' AS table_name, CAST(10 AS BIGINT) AS rows
        UNION ALL SELECT 'residuals', CAST(50 AS BIGINT)
        UNION ALL SELECT 'scatter', least(10000, count(*)) FROM local_gold
        WHERE NOT ({_GLOBAL}) AND {C.sql_bucket('id')} < {C.TEST_PCT}
          AND {C.sql_bucket('id', purpose='sample')} < 5""", "local_gold"),
    "model_preparation": fx.with_ctes(" UNION ALL ".join([
        f"""SELECT '{dst}' AS column_name, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS INTEGER) AS position,
              round(quantile_disc(CAST({_source(src)} AS DOUBLE), 0.5), 6) AS median
            FROM local_gold WHERE {_GLOBAL}""" for dst, src in ((c, LOCAL_TO_GLOBAL.get(c, c)) for c in GLOBAL_NUMERIC)] + [
        f"""SELECT '{c}', v, CAST(row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS INTEGER), NULL
            FROM (SELECT lower(coalesce({src}, 'other')) AS v FROM local_gold WHERE {_GLOBAL}) GROUP BY v"""
        for c, src in (("country", "neighbourhood_cleansed"), ("city", "neighbourhood_cleansed"),
                       ("region", "listing_type"), ("listing_type", "listing_type"))]), "local_gold"),
    "run_log": fx.with_ctes(f"""
        SELECT model, params, n, CAST(0 AS BIGINT) AS skipped_train_rows, CAST(1 AS BIGINT) AS copies,
               TRUE AS has_metrics, TRUE AS has_time
        FROM (VALUES {", ".join(f"('{c.name}', '{json.dumps(c.params, sort_keys=True)}')"
                                for c in model.reference_candidates(C.SEED))}) v(model, params),
             (SELECT count(*) AS n FROM local_gold
              WHERE {_GLOBAL} AND {C.sql_bucket('id', SELECTION_SEED)} < 20)""", "local_gold"),
    "importance_check": fx.with_ctes(f"""
        SELECT TRUE AS sums_to_one, TRUE AS no_negative, count(*) AS train_rows
        FROM local_gold WHERE {_GLOBAL}""", "local_gold"),
    "calibration_check": fx.with_ctes(f"""
        SELECT round(sqrt(avg(pow(e, 2))), 6) AS rmse_raw, round(avg(abs(e)), 6) AS mae_raw,
               round(avg(e), 6) AS bias_raw, TRUE AS improves
        FROM (SELECT price_global - price_local AS e FROM two_source
              WHERE {C.sql_bucket('id')} < {C.TEST_PCT})""", "two_source"),
}
