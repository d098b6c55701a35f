"""Model and learning-curve structure on the smallest fixture (rows-only queries)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF0001
from pricelens.operators import cells as cl
from pricelens.operators import curve, model, sampling, split
from pricelens.operators.robust import huber_groups
from pricelens.operators.runlog import content_id
from pricelens.plans import curveplan
from pricelens.plans.models import _numeric_flags
from pricelens.sources import fixtures as fx


def _pool(spark):
    g = _numeric_flags(fx.local_gold(spark, SF0001))
    g = g.withColumns({c: F.col(c).cast("double") for c in curveplan.BASE_NUMERIC})
    # a deterministic stand-in for the global model's prediction
    g = g.withColumn("global_pred_log", F.col("log_price") * 0.9 + 0.5)
    return split.hash_split(g, "id", 20, 42)


def test_learning_curve_cells_and_models(spark):
    test, train = _pool(spark)
    cfg = curve.CurveConfig(sizes=(40, 10000), block_sizes=(2, 3), repetitions=2, rf_trees=5,
                            rf_depth=4, min_test_rows=1)
    res = curve.run_learning_curve(train, test, curveplan.BASE_NUMERIC,
                                   curveplan.LOCAL_CATEGORICAL, cfg).collect()
    full = [r for r in res if r.sampling_method == "baseline_full"]
    assert len(full) == 1 and full[0].model == curve.BASELINE
    models = {r.model for r in res if r.sampling_method == "random"}
    assert models == {curve.BASELINE, curve.LOCAL, curve.HYBRID, curve.CALIBRATED}
    pool = train.count()
    sizes = {r.n_size for r in res if r.sampling_method == "random"}
    assert sizes == {40, pool}  # a request above the pool gets the whole pool
    agg = curve.curve_means(spark.createDataFrame(res)).collect()
    assert all(r.display_name for r in agg)


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    """Cells in the log are not fitted again; equal draws are fitted once; the rows of a run
    that was broken off and resumed equal those of a run in one go."""
    test, train = _pool(spark)
    cfg = curve.CurveConfig(sizes=(30, 10000), block_sizes=(2, 3), repetitions=2, rf_trees=4,
                            rf_depth=4, min_test_rows=1)
    args = (train, test, curveplan.BASE_NUMERIC, curveplan.LOCAL_CATEGORICAL, cfg)
    fitted = []
    forest = curve.forest_predictions

    def counted(rows, *rest):
        fitted.append(rows.count())
        if len(fitted) == 3 and not resumed:
            raise RuntimeError("lost")
        return forest(rows, *rest)

    monkeypatch.setattr(curve, "forest_predictions", counted)
    resumed, log = False, str(tmp_path / "log")
    with pytest.raises(RuntimeError):
        curve.run_learning_curve(*args, log=log)
    at_first, resumed = len(fitted), True
    plain = lambda df: sorted(tuple(x if not isinstance(x, float) else round(x, 6) for x in r)
                              for r in df.collect())
    got = plain(curve.run_learning_curve(*args, log=log))
    in_all = len(fitted)
    assert plain(curve.run_learning_curve(*args, log=log)) == got and len(fitted) == in_all
    fitted.clear()
    assert plain(curve.run_learning_curve(*args, log=str(tmp_path / "other"))) == got
    whole = train.count()
    assert fitted.count(whole) == 1  # two repetitions drew the whole pool
    assert in_all - at_first < len(fitted)


def test_forests_grow_without_shipping_their_trees(spark, monkeypatch):
    """Node ids are kept between levels, and the predictions are those of a fit without."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import RandomForestRegressor
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = x[:, 0] - x[:, 1] ** 2 + rng.normal(size=300) * 0.1
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["y", "features"]).coalesce(1).cache()
    cfg, seen = curve.CurveConfig(rf_trees=7, rf_depth=30), []

    def forest(keep):
        def make(**k):
            seen.append(k.get("cacheNodeIds", False))
            return RandomForestRegressor(**{**k, **keep})
        monkeypatch.setattr(curve, "RandomForestRegressor", make)
        return [r.forest for r in curve.forest_predictions(df, df, 100_000, "y", cfg).collect()]

    assert forest({}) == forest({"cacheNodeIds": False})
    assert len(seen) == 4 and all(seen)  # lots of 5 and 2 trees


def test_drawn_cells_equal_one_sample_each(spark):
    _, train = _pool(spark)
    cells = [cl.Cell(0, "random", 1, 25, 7), cl.Cell(1, "random", 1, 10 ** 6, 8),
             cl.Cell(2, "spatial", 1, 5, 9, ("france", "FRANCE", "CHINA", "JAPAN", "PERU", "IRAN"))]
    drawn, cells = cl.draw_cells(train, cells, "id", curveplan.GROUP)
    assert [c.whole for c in cells] == [False, True, cells[2].rows < 5]
    for c in cells:
        pool = train.where(F.col(curveplan.GROUP).isin(list(c.groups))) if c.groups else train
        want = {r.id for r in sampling.exact_sample(pool, "id", c.n, c.seed).collect()}
        assert {r.id for r in drawn.where(F.col("cell") == c.cell).collect()} == want and c.rows == len(want)


def test_prepared_cells_see_their_own_rows_only(spark):
    rows = [(0, 1.0, None, "A"), (0, float("nan"), None, "a"), (0, 3.0, None, "b"), (0, 9.0, None, None),
            (1, 5.0, 2.0, "z")]
    df = spark.createDataFrame(rows, "cell int, p double, q double, c string")
    prep = cl.fit_preparation(df, ["p", "q"], ["c"])
    a, b = prep.orderBy("cell").collect()
    assert a.medians == [3.0, None] and a.means[0] == 4.0 and a.categories == [{"a": 0, "b": 1, "other": 2}]
    assert b.medians == [5.0, 2.0] and b.deviations == [0.0, 0.0] and b.categories == [{"z": 0}]
    new = spark.createDataFrame([(0, 4.0, 7.0, "B"), (0, None, 7.0, "new"), (1, 6.0, 2.0, "z")], df.schema)
    x = [r.x for r in cl.apply_preparation(new, prep, ["p", "q"], ["c"]).orderBy("cell", "p").collect()]
    sd = 9.0 ** 0.5
    assert x[0] == pytest.approx([-1 / sd, 0, 0, 0, 0]) and x[1] == pytest.approx([0, 0, 0, 1, 0])
    assert x[2] == [0.0, 0.0, 1.0]


def huber_brute(x, y, epsilon=1.35, alpha=1e-4):
    """The same objective for one matrix at once, to full convergence."""
    n, p = x.shape
    xa = np.hstack([x, np.ones((n, 1))])
    ridge = np.diag(np.append(np.full(p, alpha), 0.0))
    beta = np.linalg.lstsq(xa, y, rcond=None)[0]
    sigma = max(float(np.std(y - xa @ beta)), 1e-9)
    for _ in range(20_000):
        r = y - xa @ beta
        a = np.abs(r) / sigma
        w = np.where(a <= epsilon, 1.0, epsilon / np.maximum(a, 1e-300))
        new = np.linalg.solve((xa.T * w) @ xa + ridge * sigma, (xa.T * w) @ y)
        r = y - xa @ new
        inlier = np.abs(r) <= epsilon * sigma
        scale = np.sqrt(np.sum(r[inlier] ** 2) / (n - epsilon ** 2 * (~inlier).sum()))
        still = np.max(np.abs(new - beta)) < 1e-13 and abs(scale - sigma) < 1e-13
        beta, sigma = new, scale
        if still:
            break
    return beta[:-1], beta[-1], sigma


def test_grouped_huber_equals_one_matrix_at_a_time(spark):
    rng = np.random.default_rng(2)
    data, rows = {}, []
    for fit, (n, p) in enumerate([(400, 5), (60, 12), (900, 1), (30, 2)]):
        x = rng.normal(size=(n, p))
        y = x @ rng.normal(size=p) + 2 + rng.normal(size=n) * 0.3 + (rng.random(n) < 0.1) * 20
        data[fit] = (x, y)
        rows += [(fit, [float(v) for v in a], float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "fit int, x array<double>, y double").repartition(6)
    got = huber_groups(df)
    assert got.keys() == data.keys()
    for fit, (x, y) in data.items():
        w, b, sigma = huber_brute(x, y)
        assert np.allclose(got[fit][0], w, atol=1e-6) and abs(got[fit][1] - b) < 1e-6
        assert abs(got[fit][2] - sigma) < 1e-6


def test_huber_runs_through_exact_points(spark):
    rows = [(7, [float(i)], 3.0 * i + 1) for i in range(20)]
    w, b, sigma, steps = huber_groups(spark.createDataFrame(rows, "fit int, x array<double>, y double"))[7]
    assert abs(w[0] - 3) < 1e-5 and abs(b - 1) < 1e-4 and sigma < 1e-4 and steps < 100


def test_calibration_beats_raw_on_biased_source(spark):
    ts = fx.two_source(spark, SF0001)
    test, train = split.hash_split(ts, "id", 20, 42)
    rep = model.calibration_summary(
        model.calibrate(train, test, "price_global", "price_local")).first()
    assert rep.mae_cal < rep.mae_raw and rep.rmse_cal < rep.rmse_raw


def test_training_rows_are_spread_over_the_cores():
    assert model.training_partitions(7_500, 79) == 1    # one task: less than a job's overhead
    assert model.training_partitions(75_000, 79) >= 4   # one task before
    assert model.training_partitions(450_000, 79) >= 24
    assert model.training_partitions(10 ** 7, 79) == 257
    assert model.training_partitions(10 ** 9, 79) * model.TARGET_PARTITION_BYTES >= 10 ** 9 * (8 * 79 + 32)


def test_save_reload_gives_identical_predictions(spark, tmp_path):
    g = _numeric_flags(fx.local_gold(spark, SF0001))
    cand = model.Candidate("GBT_Shallow", "gbt", {"maxIter": 5, "maxDepth": 3, "seed": 42})
    num = ["accommodates", "beds", "review_scores_rating", "host_is_superhost"]
    g = g.withColumns({c: F.col(c).cast("double") for c in num})
    m = model.fit_pipeline(g, num, ["listing_type"], cand)
    model.save_model(m, str(tmp_path / "m"))
    back = model.load_model(str(tmp_path / "m"))
    a = {r.id: r.prediction for r in m.transform(g).select("id", "prediction").collect()}
    b = {r.id: r.prediction for r in back.transform(g).select("id", "prediction").collect()}
    assert a == b and len(a) > 0
    imp = model.feature_importance(m, model.transformed_features(m, g), 3).collect()
    assert len(imp) == 3 and imp[0].importance >= imp[-1].importance


def test_visual_tables_written(spark, tmp_path):
    g = _numeric_flags(fx.local_gold(spark, SF0001))
    num = ["accommodates", "beds", "review_scores_rating"]
    g = g.withColumns({c: F.col(c).cast("double") for c in num})
    cand = model.Candidate("RF", "rf", {"numTrees": 3, "maxDepth": 3, "seed": 42})
    m = model.fit_pipeline(g, num, ["listing_type"], cand)
    paths = model.log_visualizations(m.transform(g), m, model.transformed_features(m, g),
                                     str(tmp_path / "viz"), sample_pct=50, cap=20)
    assert set(paths) == {"importance", "scatter", "residuals"}
    assert 0 < spark.read.parquet(paths["scatter"]).count() <= 20
    hist = spark.read.parquet(paths["residuals"])
    assert hist.agg(F.sum("count")).first()[0] == g.count()


def test_a_run_logged_twice_has_one_copy(spark, tmp_path):
    g = _numeric_flags(fx.local_gold(spark, SF0001))
    num = ["accommodates", "beds"]
    g = g.withColumns({c: g[c].cast("double") for c in num})
    board = model.compare_candidates(g, g, num, ["listing_type"], [
        model.Candidate("RF", "rf", {"numTrees": 3, "maxDepth": 3, "seed": 42})])
    log = str(tmp_path / "log")
    assert model.run_log(spark, log).count() == 0
    for run in ("a", "a", "b"):
        model.log_run(board, log, run)
    assert sorted(r.run_id for r in model.run_log(spark, log).collect()) == ["a", "b"]


def test_content_ids_follow_the_values(spark):
    a = spark.createDataFrame([(1, 0.1, "x"), (2, None, None), (2, None, None)], "id long, v double, s string")
    assert content_id(a) == content_id(a.repartition(3).orderBy(F.desc("id")))
    assert content_id(a) == content_id(a.withColumn("v", F.col("v") + 1e-17))
    assert len({content_id(a), content_id(a.distinct()), content_id(a.fillna("", ["s"])), content_id(a, a)}) == 4
