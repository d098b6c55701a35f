"""Learning-curve experiment.

Every (size, sampling method, repetition) cell is a slice of ONE DataFrame keyed by
``cell`` (see ``cells``), which also fits the preparations of all cells in one table. The
robust regressions of all cells are fitted together (see ``robust``). The forest of a cell
whose rows fit one task grows inside tasks (see ``forest``), that of a larger one is a Spark ML
fit; both give the same trees. It is scored on the cell's test rows at once and let go. A cell's
result rows are written to a log keyed by cell: a run that starts again goes on with the cells
that are not there yet.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, scratch_path
from . import cells as cl
from .forest import with_forest
from .metrics import dollar_metrics
from .model import TARGET_PARTITION_BYTES, run_concurrently
from .robust import huber_groups
from .runlog import done_keys, keyed_table, write_keyed

# Fixed display names of the compared models.
BASELINE = "Global (Baseline)"
LOCAL = "Local Standalone"
HYBRID = "Hybrid (Residuals)"
CALIBRATED = "Global Calibrated (POC)"

WORKERS = 4                # cells at work side by side, several tasks each (12 took 280 MB more of the driver)
TASK_ROWS = 50_000         # rows of a cell whose trees grow inside tasks; larger ones take turns
NODES_AT_ONCE = 1_000_000  # tree nodes that a fit may bring to the driver


@dataclass
class CurveConfig:
    sizes: Sequence[int] = (250, 1000, 2500, 5000, 10000, 20000, 40000)
    block_sizes: Sequence[int] = (1, 1, 2, 4, 5, 10, 20)
    repetitions: int = 3
    seed: int = 42
    rf_trees: int = 200
    rf_depth: int = 30  # Spark's maximum (the original asked for 50)
    min_test_rows: int = 5
    huber_epsilon: float = 1.35
    huber_alpha: float = 1e-4

    def tag(self) -> str:
        """Names the settings (and the version of the method) in the path of a log."""
        return hashlib.md5(f"3 {self}".encode()).hexdigest()[:12]


RESULT = ("n_size long, sampling_method string, model string, dollar_rmse double, dollar_mae double, "
          "dollar_r2 double, dollar_mape double, iteration int")


def grid(train: DataFrame, test: DataFrame, key: str, group: str, cfg: CurveConfig
         ) -> tuple[DataFrame, list[cl.Cell]]:
    """Training rows of all cells (keyed by ``cell``) and the cells with the rows drawn (a
    size above the pool draws the whole pool) and the rows they are tested on."""
    planned = cl.plan_cells(train, group, cfg.sizes, cfg.block_sizes, cfg.repetitions, cfg.seed)
    drawn, cells = cl.draw_cells(train, planned, key, group)
    tested = cl.rows_per_cell(test, cells, group)
    return drawn, [cl.replace(c, test_rows=tested[c.cell]) for c in cells]


def baseline_predictions(test: DataFrame, label: str, global_pred: str) -> DataFrame:
    return test.select(F.col(label).alias("y"), F.col(global_pred).alias("pred"), F.lit(BASELINE).alias("model"))


def result_rows(predictions: DataFrame, n: int, method: str, iteration: int) -> DataFrame:
    """Metrics per model of the (y, pred, model) rows of one cell, in the columns of the log."""
    m = dollar_metrics(predictions, "y", "pred", ["model"])
    return m.select(F.lit(n).cast("long").alias("n_size"), F.lit(method).alias("sampling_method"), "model",
                    "dollar_rmse", "dollar_mae", "dollar_r2", "dollar_mape",
                    F.lit(iteration).cast("int").alias("iteration"))


def robust_fits(prepared: DataFrame, label: str, global_pred: str, cfg: CurveConfig) -> dict:
    """{cell: (hybrid weights, intercept, calibration slope, intercept)} of all cells."""
    both = prepared.select((F.col("cell") * 2).alias("fit"), "x", (F.col(label) - F.col(global_pred)).alias("y")) \
        .unionByName(prepared.select((F.col("cell") * 2 + 1).alias("fit"), F.array(global_pred).alias("x"),
                                     F.col(label).alias("y")))
    fits = huber_groups(both, cfg.huber_epsilon, cfg.huber_alpha)
    return {f // 2: (fits[f][0], fits[f][1], float(fits[f + 1][0][0]), fits[f + 1][1]) for f in fits if f % 2 == 0}


def forest_predictions(train: DataFrame, test: DataFrame, rows: int, label: str, cfg: CurveConfig,
                       partitions: int = 1) -> DataFrame:
    """``test`` with ``forest`` in place of its ``features`` vector: the mean of ``rf_trees``
    trees fitted on ``train``. Trees are grown in lots that fit NODES_AT_ONCE. Up to TASK_ROWS in
    one partition, a lot is a task. Beyond that it is a Spark ML fit, and with more than one
    lot the sums so far are written before the next lot grows; the nodes that the rows are in
    are kept between levels: same trees, but the growing ones are not shipped with every job."""
    lot = min(cfg.rf_trees, max(1, NODES_AT_ONCE // (2 * max(rows, 1))))
    if rows <= TASK_ROWS and partitions == 1:
        lots = [(cfg.seed + done, min(lot, cfg.rf_trees - done)) for done in range(0, cfg.rf_trees, lot)]
        return with_forest(train, test, rows, label, lots, cfg.rf_depth)
    done, out = 0, test.withColumn("forest", F.lit(0.0))
    while done < cfg.rf_trees:
        trees = min(lot, cfg.rf_trees - done)
        model = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees,
                                      maxDepth=cfg.rf_depth, featureSubsetStrategy="all",
                                      cacheNodeIds=True, seed=cfg.seed + done).fit(train)
        out = model.transform(out).withColumn("forest", F.col("forest") + F.col("prediction") * trees).drop("prediction")
        done += trees
        if done < cfg.rf_trees:
            out = checkpointed(out)
    return out.withColumn("forest", F.col("forest") / cfg.rf_trees).drop("features")


def run_learning_curve(train: DataFrame, test: DataFrame, numeric: Sequence[str],
                       categorical: Sequence[str], cfg: CurveConfig, key: str = "id",
                       group: str = "neighbourhood_cleansed", label: str = "log_price",
                       global_pred: str = "global_pred_log", log: str | None = None) -> DataFrame:
    """Results table: n_size, sampling_method, model, dollar_rmse, dollar_mae, dollar_r2,
    dollar_mape, iteration (one row per evaluated model and cell, plus the full baseline),
    kept in ``log`` (a folder of this run; a scratch folder if not given)."""
    spark = train.sparkSession
    log = log or scratch_path(spark, f"curve-{uuid.uuid4().hex}")
    schema = f"cell int, {RESULT}"
    finished = done_keys(keyed_table(spark, log, "cell", schema), "cell")
    if -2 in finished:  # the whole grid is there
        return keyed_table(spark, log, "cell", schema).where("cell >= -1").drop("cell")
    # Both inputs are used by every cell; freezing them first also keeps the optimizer
    # away from re-deriving constraints through the long upstream lineage for each use.
    train, test = checkpointed(train), checkpointed(test)
    drawn, cells = grid(train, test, key, group, cfg)
    todo = [c for c in cells if c.cell not in finished and c.rows and c.test_rows >= cfg.min_test_rows]
    if -1 not in finished:
        full = result_rows(baseline_predictions(test, label, global_pred), 0, "baseline_full", 0)
        write_keyed(full, log, "cell", -1)
    if todo:
        # a size above the pool draws the whole pool in every repetition: one fit serves them
        same: dict[tuple, list[cl.Cell]] = {}
        for c in todo:
            same.setdefault(c.draw, []).append(c)
        first = [cells_of[0] for cells_of in same.values()]
        mine = drawn.where(F.col("cell").isin([c.cell for c in first]))
        preparation = checkpointed(cl.fit_preparation(mine, numeric, categorical))
        prepared = checkpointed(cl.apply_preparation(mine, preparation, numeric, categorical)
                                .select("cell", label, global_pred, "x"))
        fits = robust_fits(prepared, label, global_pred, cfg)
        partitions = {c.cell: 1 + c.rows * (8 * len(fits[c.cell][0]) + 32) // TARGET_PARTITION_BYTES for c in first}

        # the test rows as each cell sees them: one plan, of which every cell takes its own
        robust = spark.createDataFrame([(c, [float(v) for v in w], b, slope, shift) for c, (w, b, slope, shift) in fits.items()],
                                       "cell int, weights array<double>, hybrid_b double, slope double, shift double")
        dot = F.aggregate(F.zip_with("x", "weights", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        asked_by_all = cl.apply_preparation(test, checkpointed(preparation.join(robust, "cell")), numeric, categorical, by=None) \
            .select("cell", group, label, global_pred, (F.col(global_pred) + dot + F.col("hybrid_b")).alias("hybrid"),
                    (F.col(global_pred) * F.col("slope") + F.col("shift")).alias("calibrated"),
                    array_to_vector("x").alias("features"))
        trained_by_all = prepared.select("cell", label, array_to_vector("x").alias("features"))

        def evaluate(c: cl.Cell) -> None:
            asked = (cl.test_rows(asked_by_all.where(F.col("cell") == c.cell), c, group)
                     .drop("cell", group).persist(StorageLevel.MEMORY_AND_DISK))
            rows = (trained_by_all.where(F.col("cell") == c.cell).drop("cell")
                    .repartition(partitions[c.cell]).persist(StorageLevel.MEMORY_AND_DISK))
            try:
                scored = forest_predictions(rows, asked, c.rows, label, cfg, partitions[c.cell])
                models = {BASELINE: F.col(global_pred), LOCAL: F.col("forest"),
                          HYBRID: F.col("hybrid"), CALIBRATED: F.col("calibrated")}
                each = scored.select(F.col(label).alias("y"), F.explode(F.array(*[
                    F.struct(F.lit(m).alias("model"), p.alias("pred")) for m, p in models.items()])).alias("m"))
                found = result_rows(each.select("y", "m.pred", "m.model"), c.rows, c.method, c.iteration).collect()
                for twin in same[c.draw]:  # four rows each
                    of_twin = spark.createDataFrame(found, RESULT).withColumn("iteration", F.lit(twin.iteration))
                    write_keyed(of_twin.coalesce(1), log, "cell", twin.cell)
            finally:
                rows.unpersist()
                asked.unpersist()

        # the largest first, so that the last ones to end are short
        small = sorted((c for c in first if c.rows <= TASK_ROWS and partitions[c.cell] == 1), key=lambda c: -c.rows)
        run_concurrently([lambda c=c: evaluate(c) for c in small], WORKERS)
        for c in (c for c in first if c not in small):
            evaluate(c)
    write_keyed(spark.createDataFrame([(0, "complete", "", 0.0, 0.0, 0.0, 0.0, 0)], RESULT), log, "cell", -2)
    return keyed_table(spark, log, "cell", schema).where("cell >= -1").drop("cell")


# Fixed display names for the learning-curve chart.
DISPLAY_NAMES = {BASELINE: "Global model", LOCAL: "Local model", HYBRID: "Hybrid model",
                 CALIBRATED: "Calibrated global model"}


def curve_means(results: DataFrame) -> DataFrame:
    """Mean metrics over repetitions by method, model and iteration (D11 series),
    with the chart's display name (F19; keys match the model labels exactly)."""
    from ..functions.columns import map_values
    return (results.groupBy("sampling_method", "model", "iteration")
            .agg(F.avg("n_size").alias("n_size"), F.avg("dollar_mae").alias("dollar_mae"),
                 F.avg("dollar_rmse").alias("dollar_rmse"), F.avg("dollar_r2").alias("dollar_r2"),
                 F.avg("dollar_mape").alias("dollar_mape"))
            .withColumn("display_name", map_values("model", DISPLAY_NAMES)))
