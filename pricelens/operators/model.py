"""Price models on Spark ML.

Preparation stages are fitted once and shared by every candidate; candidates are
distributed Spark ML estimators; metrics are single aggregate passes; the run log is
an append-only Parquet table. Only fitted parameters and one-row metrics reach the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metrics import calibration_report, log_model_metrics
from .runlog import keyed_table, write_keyed


@dataclass
class Candidate:
    name: str
    kind: str  # "gbt" | "rf"
    params: dict = field(default_factory=dict)

    def estimator(self, label: str = "log_price", features: str = "features"):
        # Node-id caching changes no result (same trees, same predictions) but saves
        # shipping the growing trees to executors at every level of deep trees.
        opts = {"cacheNodeIds": True, **self.params}
        if self.kind == "gbt":
            return GBTRegressor(featuresCol=features, labelCol=label, **opts)
        if self.kind == "rf":
            return RandomForestRegressor(featuresCol=features, labelCol=label, **opts)
        raise ValueError(self.kind)


def reference_candidates(seed: int = 42) -> list[Candidate]:
    """The four global-model candidates (fixed settings)."""
    return [
        Candidate("GBT_Deep", "gbt", {"maxIter": 50, "maxDepth": 7, "seed": seed}),
        Candidate("GBT_Shallow", "gbt", {"maxIter": 20, "maxDepth": 3, "seed": seed}),
        Candidate("GBT_Robust_MAE", "gbt", {"lossType": "absolute", "maxIter": 50,
                                            "maxDepth": 7, "seed": seed}),
        Candidate("RandomForest_Baseline", "rf", {"numTrees": 50, "maxDepth": 10, "seed": seed}),
    ]


def prep_stages(numeric: Sequence[str], categorical: Sequence[str],
                out: str = "features", scale: bool = False, clean_categories: bool = False,
                fill: str = "other") -> list:
    """Median imputation (null and NaN), index + one-hot (unseen -> all-zero vector),
    assembly that skips rows still invalid; optional standard scaling of the numerics and
    optional category cleaning (missing -> ``fill``, then lower case) inside the pipeline,
    so a fitted model applies the same cleaning to new rows."""
    stages: list = []
    if clean_categories and categorical:
        from pyspark.ml.feature import SQLTransformer
        exprs = ", ".join(f"lower(coalesce(CAST(`{c}` AS STRING), '{fill}')) AS `{c}__clean`"
                          for c in categorical)
        stages.append(SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__"))
        categorical = [f"{c}__clean" for c in categorical]
    imputed = [f"imputed_{c}" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=imputed, strategy="median",
                              relativeError=0.0001))
    num_vec = imputed
    if scale and numeric:
        from pyspark.ml.feature import StandardScaler
        stages.append(VectorAssembler(inputCols=imputed, outputCol="_num_raw", handleInvalid="skip"))
        stages.append(StandardScaler(inputCol="_num_raw", outputCol="_num_scaled",
                                     withMean=True, withStd=True))
        num_vec = ["_num_scaled"]
    enc = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_vec"]))
        enc.append(f"{c}_vec")
    stages.append(VectorAssembler(inputCols=num_vec + enc, outputCol=out, handleInvalid="skip"))
    return stages


def compare_candidates(train: DataFrame, test: DataFrame, numeric: Sequence[str],
                       categorical: Sequence[str], candidates: Sequence[Candidate],
                       label: str = "log_price") -> DataFrame:
    """Fit shared preparation once, then each candidate; score the test slice; one metrics
    row per candidate (n, mae, medae, mape_pct, rmse, r2_log, train_seconds). Returns the
    leaderboard sorted by MAE."""
    prep = Pipeline(stages=prep_stages(numeric, categorical)).fit(train)
    tr = right_sized(prep.transform(train).select(label, "features"))
    te = prep.transform(test).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    # M3: rows the assembler skipped (still invalid after imputation), reported per run
    skipped = train.count() - tr.count()

    def run(cand: Candidate) -> dict:
        t0 = time.perf_counter()
        model = cand.estimator(label).fit(tr)
        secs = time.perf_counter() - t0
        # approximate median error, as in the original evaluation (one pass, no sort)
        m = log_model_metrics(model.transform(te), label, "prediction",
                              exact_median=False).first().asDict()
        m.update(model=cand.name, params=json.dumps(cand.params, sort_keys=True),
                 train_seconds=round(secs, 3), skipped_train_rows=skipped)
        return m

    try:
        rows = run_concurrently([lambda c=c: run(c) for c in candidates])
    finally:
        tr.unpersist()
        te.unpersist()
    spark = train.sparkSession
    cols = ["model", "params", "n", "mae", "medae", "mape_pct", "rmse", "r2_log", "train_seconds",
            "skipped_train_rows"]
    res = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                "model string, params string, n long, mae double, medae double, "
                                "mape_pct double, rmse double, r2_log double, train_seconds double, "
                                "skipped_train_rows long")
    return res.orderBy("mae", "model")


TARGET_PARTITION_BYTES = 64 * 1024 * 1024
SMALL_PARTITION_BYTES = 8 * 1024 * 1024
SMALL_PARTITIONS = 256


def training_partitions(rows: int, width: int) -> int:
    """Partitions of a training table. Tree learners run one job per level: a table of a few
    thousand rows stays in one task, beyond that a level's rows are spread over the cores
    (~8 MB each, estimated from the row count and the feature-vector width). Every partition
    sends its node statistics at every level, so past 256 of them they grow to ~64 MB first."""
    est = rows * (8 * width + 32)
    return 1 + max(min(est // SMALL_PARTITION_BYTES, SMALL_PARTITIONS), est // TARGET_PARTITION_BYTES)


def right_sized(df: DataFrame, features: str = "features") -> DataFrame:
    """Cache a training table in ``training_partitions``."""
    n = df.count()
    first = df.select(features).first()
    width = first[0].size if first is not None else 1
    return df.repartition(training_partitions(n, width)).persist(StorageLevel.MEMORY_AND_DISK)


def run_concurrently(tasks, max_workers: int = 4) -> list:
    """Run independent Spark actions from driver threads so their jobs share the cluster
    (small model fits are dominated by per-job latency, not by data volume). Results
    come back in task order; the first failure is re-raised."""
    from concurrent.futures import ThreadPoolExecutor
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


RUN_LOG = ("model string, params string, n long, mae double, medae double, mape_pct double, rmse double, "
           "r2_log double, train_seconds double, skipped_train_rows long, logged_at timestamp, run_id string")


def log_run(results: DataFrame, path: str, run_id: str) -> None:
    """Keep the rows of a run (time, model, params, metrics) in the run log. A run that is
    logged again replaces its rows, so that a retry leaves one copy."""
    write_keyed(results.withColumn("logged_at", F.current_timestamp()).coalesce(1), path, "run_id", run_id)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs that were logged; the key column is ``run_id``."""
    return keyed_table(spark, path, "run_id", RUN_LOG)


def fit_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 candidate: Candidate, label: str = "log_price") -> PipelineModel:
    """M8: preparation + chosen estimator fitted on all given rows."""
    prep = Pipeline(stages=prep_stages(numeric, categorical)).fit(train)
    tr = right_sized(prep.transform(train))
    try:
        est = candidate.estimator(label).fit(tr)
    finally:
        tr.unpersist()
    return PipelineModel(stages=list(prep.stages) + [est])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], out: str = "global_pred_log"
          ) -> DataFrame:
    """Transform and keep the caller's original columns plus the prediction.

    Model inputs are read from the columns the pipeline expects; callers that must keep
    original values (e.g. un-lowered categories) pass cleaned copies and keep originals."""
    return model.transform(df).select(*keep, F.col("prediction").alias(out))


def feature_importance(model: PipelineModel, transformed: DataFrame, k: int = 10,
                       features: str = "features") -> DataFrame:
    """Importances of the last stage named from the vector's ML attribute metadata
    (``Feature_i`` when a slot has no name); top k by importance."""
    spark = transformed.sparkSession
    imps = model.stages[-1].featureImportances.toArray().tolist()
    names = {}
    meta = transformed.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    rows = [(names.get(i, f"Feature_{i}"), float(v)) for i, v in enumerate(imps)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def huber_fit(train: DataFrame, features: Sequence[str], label: str, epsilon: float = 1.35,
              alpha: float = 1e-4):
    """Robust (Huber) linear regression. A penalty ``alpha`` on the squared weights as in
    the usual sum-form objective maps to Spark's mean-form regParam = alpha / n."""
    n = train.count()
    va = VectorAssembler(inputCols=list(features), outputCol="_hx", handleInvalid="skip")
    lr = LinearRegression(featuresCol="_hx", labelCol=label, loss="huber", epsilon=epsilon,
                          regParam=alpha / max(n, 1), elasticNetParam=0.0,
                          standardization=False, maxIter=200, tol=1e-8)
    return Pipeline(stages=[va, lr]).fit(train)


def calibrate(train: DataFrame, test: DataFrame, source_price: str, true_price: str,
              key: str = "id") -> DataFrame:
    """Huber fit of log1p(true) on log1p(source) on ``train``; returns the test rows
    with raw and calibrated dollar predictions."""
    def prep(df):
        return df.select(key, F.col(true_price).alias("true_price"),
                         F.col(source_price).alias("raw_price"),
                         F.log1p(source_price).alias("_lx"), F.log1p(true_price).alias("_ly"))
    model = huber_fit(prep(train), ["_lx"], "_ly")
    scored = model.transform(prep(test))
    return scored.select(key, "true_price", "raw_price",
                         F.expm1("prediction").alias("calibrated_price"))


def calibration_summary(calibrated: DataFrame) -> DataFrame:
    return calibration_report(calibrated, "true_price", "raw_price", "calibrated_price")


def transformed_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Run only the preparation stages of a fitted pipeline (for importance names)."""
    return PipelineModel(stages=model.stages[:-1]).transform(df)


def log_visualizations(predictions: DataFrame, fitted: PipelineModel, transformed: DataFrame,
                       out_dir: str, key: str = "id", label: str = "log_price",
                       pred: str = "prediction", sample_pct: int = 5, cap: int = 10000,
                       bins: int = 50) -> dict:
    """Write the series behind the model charts as Parquet tables under ``out_dir``:
    top-10 importances (D9), a capped hash sample of actual vs predicted dollars (D7, T5)
    and the residual histogram in dollars (D1). Returns {table: path}."""
    from .dist import histogram
    from .sampling import sample_then_cap
    dollars = predictions.select(key, F.expm1(label).alias("actual_usd"),
                                 F.expm1(pred).alias("predicted_usd"))
    tables = {
        "importance": feature_importance(fitted, transformed, 10),
        "scatter": sample_then_cap(dollars, key, sample_pct, cap),
        "residuals": histogram(dollars.withColumn(
            "residual_usd", F.col("actual_usd") - F.col("predicted_usd")),
            {"residual_usd": "residual_usd"}, bins),
    }
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
