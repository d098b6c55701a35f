"""Property tests: split invariants, nearest neighbour vs brute force, distribution sums."""

import pytest
from pyspark.sql import functions as F

from paths import SF001
from pricelens.functions.columns import haversine_km
from pricelens.operators import dist, geo, split
from pricelens.sources import fixtures as fx


def brute_force_nearest(points, stations):
    """All pairs: only for checking the grid join on a small fixture."""
    p = points.select(F.col("id").alias("_pid"), F.col("lat").alias("_plat"),
                      F.col("lon").alias("_plon"))
    s = stations.select(F.col("station_id").alias("_sid"), F.col("lat").alias("_slat"),
                        F.col("lon").alias("_slon"))
    c = p.crossJoin(s).withColumn("_d", haversine_km("_plat", "_plon", "_slat", "_slon"))
    return (c.groupBy("_pid").agg(F.min_by(F.struct("_sid", "_d"), F.struct("_d", "_sid")).alias("b"))
            .select(F.col("_pid").alias("id"), F.col("b._sid").alias("station_id"),
                    F.col("b._d").alias("dist_km")))


def test_split_is_partition_independent_and_disjoint(spark):
    df = fx.points(spark, SF001)
    t1, r1 = split.hash_split(df, "id", 20, 42)
    t2, _ = split.hash_split(df.repartition(7), "id", 20, 42)
    a = {r.id for r in t1.select("id").collect()}
    b = {r.id for r in t2.select("id").collect()}
    rest = {r.id for r in r1.select("id").collect()}
    assert a == b
    assert not (a & rest)
    assert len(a) + len(rest) == df.count()


def test_remove_ids_bucket_shortcut_equals_plain_anti_join(spark):
    df = fx.points(spark, SF001)
    ids = split.test_ids(df.where(F.col("grp") < 10), "id", 20, 42)
    fast = {r.id for r in split.remove_ids(df, ids, "id", test_pct=20).select("id").collect()}
    plain = {r.id for r in split.remove_ids(df, ids, "id").select("id").collect()}
    assert fast == plain


def test_nearest_equals_brute_force(spark):
    pts = fx.points(spark, SF001)
    sts = fx.stations(spark, SF001)
    # few regions, so that every one holds several stations
    grid = {r.id: (r.station_id, r.dist_km)
            for r in geo.nearest_neighbour(pts, sts, region=8, part=40).collect()}
    brute = {r.id: (r.station_id, r.dist_km) for r in brute_force_nearest(pts, sts).collect()}
    assert grid.keys() == brute.keys()
    for k, (sid, d) in brute.items():
        assert grid[k][0] == sid and abs(grid[k][1] - d) < 1e-9


def test_histogram_counts_sum_to_n(spark):
    df = fx.two_source(spark, SF001)
    h = dist.histogram(df, {"a": "price_local", "b": "price_global"}, 50)
    tot = {r.series: r.s for r in h.groupBy("series").agg(F.sum("count").alias("s")).collect()}
    n = df.count()
    assert tot == {"a": n, "b": n}


def test_kde_integrates_to_about_one(spark):
    df = fx.two_source(spark, SF001)
    k = dist.kde_1d(df, {"a": F.log10(F.col("price_local") + 1)}, 200).orderBy("i").collect()
    xs = [r.x for r in k]
    ys = [r.density for r in k]
    area = sum((xs[i + 1] - xs[i]) * (ys[i] + ys[i + 1]) / 2 for i in range(len(xs) - 1))
    assert 0.8 < area < 1.05


@pytest.mark.parametrize("accuracy,sorted_rows", [(2000, 1 << 20), (50, 1 << 20), (50, 40), (100, 10)])
def test_selection_is_exact_with_a_hot_value(spark, accuracy, sorted_rows):
    """A third of the rows share one group and one value; brackets that hold too much are
    narrowed until they hold little; values that repeat are one row each."""
    import pandas as pd
    from pricelens.operators.select import Selection
    rows = [("hot", 7.0)] * 3000 + [("hot", i / 7.0) for i in range(3000)] + \
           [("cold", float(i % 97)) for i in range(3000)] + [(None, 5.0), (None, 6.5), ("one", 1.0)]
    df = spark.createDataFrame(rows + [("void", None), ("hot", float("nan"))], "g string, v double").repartition(8)
    probs = [0.0, 0.1, 0.5, 0.75, 0.99, 1.0]
    got = {(x.g, x.prob): x.quantile for x in
           Selection(df, "v", ["g"], probs, accuracy=accuracy, sorted_rows=sorted_rows).quantiles().collect()}
    assert got.keys() == {(g, p) for g in ("hot", "cold", None, "one") for p in probs}
    for (g, p), q in got.items():
        assert q == pytest.approx(pd.Series([v for k, v in rows if k == g]).quantile(p))


def test_selection_of_integers_that_doubles_cannot_tell_apart(spark):
    from pricelens.operators.select import Selection
    big = 1 << 60
    df = spark.range(0, 500, 1, 4).select((F.lit(big) + F.col("id")).alias("v"))
    s = Selection(df, "v", probs=[0.5], accuracy=100)
    assert s.quantiles().first()["quantile"] == big + 249.5


def test_selection_does_not_sort_its_input(spark):
    from pricelens.operators.select import Selection
    s = Selection(fx.points(spark, SF001), "log_price", ["grp"], [0.5], accuracy=50)
    plan = s._marked(s._first_brackets())._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort " not in plan and "customer.parquet" in plan
    assert "customer.parquet" not in s.quantiles()._jdf.queryExecution().executedPlan().toString()


def test_kde_1d_is_within_its_bound_of_the_exact_sum(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=400), rng.normal(5, 0.1, 200), [3.0] * 200, [40.0]])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = dist.kde_1d(df, {"a": "v"}, 300).orderBy("i").toPandas()
    h = v.std(ddof=1) * len(v) ** -0.2
    z = (got["x"].to_numpy()[:, None] - v[None]) / h
    top = 1 / (h * np.sqrt(2 * np.pi))
    exact = np.exp(-0.5 * z * z).sum(axis=1) / len(v) * top
    assert np.max(np.abs(got["density"] - exact)) <= top / (8 * dist.CELLS_PER_WIDTH ** 2) + 1e-12
    flat = dist.kde_1d(spark.createDataFrame([(1.0,), (1.0,)], "v double"), {"a": "v"}, 5).collect()
    assert len(flat) == 5 and all(r.density is None for r in flat)


def test_kde_1d_is_the_sum_over_all_values(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=300), rng.normal(4, 0.2, 100), [2.0] * 50])
    rows = [(float(x),) for x in v] + [(None,), (float("nan"),)]
    got = dist.kde_1d(spark.createDataFrame(rows, "v double"), {"a": "v"}, 50).orderBy("i").toPandas()
    h = v.std(ddof=1) * len(v) ** -0.2
    z = (got["x"].to_numpy()[:, None] - v[None]) / h
    exact = np.exp(-0.5 * z * z).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["density"], exact, rtol=1e-9, atol=0)


def test_kde_2d_with_finer_cells_comes_closer(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    xy = rng.normal(size=(600, 2)) @ np.array([[1.0, 0.8], [0.0, 0.3]])  # strongly correlated
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, x double, y double")
    cov = np.cov(xy.T) * len(xy) ** (-2.0 / 6.0)
    diff = xy[:, None] - xy[None]
    exact = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", diff, np.linalg.inv(cov), diff)).sum(axis=1) / (
        2 * np.pi * np.sqrt(np.linalg.det(cov)) * len(xy))
    off = []
    for cells in (5, 25):
        got = {r.id: r.density for r in dist.kde_2d_binned(df, "x", "y", "id", per_width=cells).collect()}
        off.append(np.median(np.abs(np.array([got[i] for i in range(len(xy))]) - exact) / exact))
    assert off[1] < off[0] / 2 and off[0] < 0.05


def test_kde_2d_binned_close_to_exact(spark):
    """Binned 2-D KDE against the exact all-pairs density on a small fixture."""
    import numpy as np
    pts = fx.points(spark, "/root/testdata/sf0.001")
    got = {r.id: r.density for r in dist.kde_2d_binned(pts, "lon", "lat", "id").collect()}
    pdf = pts.select("id", "lon", "lat").toPandas()
    xy = pdf[["lon", "lat"]].to_numpy()
    n = len(xy)
    cov = np.cov(xy.T) * n ** (-2.0 / 6.0)
    inv, det = np.linalg.inv(cov), np.linalg.det(cov)
    diff = xy[:, None, :] - xy[None, :, :]
    q = np.einsum("ijk,kl,ijl->ij", diff, inv, diff)
    exact = np.exp(-0.5 * q).sum(axis=1) / (2 * np.pi * np.sqrt(det) * n)
    approx = np.array([got[i] for i in pdf["id"]])
    rel = np.abs(approx - exact) / exact
    assert np.median(rel) < 0.05
    assert np.corrcoef(approx, exact)[0, 1] > 0.99


def test_nearest_with_a_hot_station_cluster(spark):
    """A third of the stations piled into one spot (some exactly co-located)."""
    pts = fx.points(spark, SF001)
    sts = fx.stations(spark, SF001)
    pile = sts.select((F.col("station_id") + 100000).alias("station_id"),
                      F.concat(F.lit("pile-"), F.col("station_name")).alias("station_name"),
                      (F.lit(48.85) + (F.col("station_id") % 5) * F.lit(1e-6)).alias("lat"),
                      F.lit(2.35).alias("lon")).limit(50)
    allst = sts.unionByName(pile)
    grid = {r.id: (r.station_id, r.dist_km) for r in geo.nearest_neighbour(pts, allst).collect()}
    brute = {r.id: (r.station_id, r.dist_km) for r in brute_force_nearest(pts, allst).collect()}
    assert grid.keys() == brute.keys()
    for k, (sid, d) in brute.items():
        assert grid[k][0] == sid and abs(grid[k][1] - d) < 1e-9


def test_nearest_with_300_close_stations_far_points_and_the_date_line(spark):
    """Regions follow the stations' density, so a dense cluster costs far points nothing."""
    pts = fx.points(spark, SF001).select("id", "lat", "lon")
    cluster = [(i, 48.85 + (i % 20) * 1e-6, 2.35 + (i // 20) * 1e-6) for i in range(300)]
    extra = [(90001, -17.0, 179.999), (90002, 89.99, 10.0), (90003, 48.85, 2.3500071)]
    sts = spark.createDataFrame(cluster + [(1000, -17.0, -179.999), (1001, 89.99, -170.0)],
                                "station_id long, lat double, lon double")
    pts = pts.unionByName(spark.createDataFrame(extra, "id long, lat double, lon double"))
    for leaves in (8, 4096):
        got = {r.id: (r.station_id, r.dist_km)
               for r in geo.nearest_neighbour(pts, sts, region=leaves, part=60).collect()}
        brute = {r.id: (r.station_id, r.dist_km) for r in brute_force_nearest(pts, sts).collect()}
        assert got.keys() == brute.keys()
        assert all(abs(got[k][1] - d) < 1e-9 for k, (_, d) in brute.items())


def test_nearest_drops_nan_like_null_and_keeps_rows_of_a_repeated_id(spark):
    nan = float("nan")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (1, 5.0, 5.0), (2, 1.0, 1.0), (2, 1.0, 1.0),
                                 (3, nan, 1.0), (4, None, 1.0)], "id long, lat double, lon double")
    sts = spark.createDataFrame([(7, 1.0, 1.1), (8, 5.0, 5.1), (9, nan, 0.0), (10, None, None)],
                                "station_id long, lat double, lon double")
    got = sorted((r.id, r.station_id) for r in geo.nearest_neighbour(pts, sts).collect())
    assert got == [(1, 7), (1, 8), (2, 7), (2, 7)]
    assert geo.nearest_neighbour(pts, sts.where("station_id > 8")).count() == 0
    assert geo.nearest_neighbour(pts.where("id > 2"), sts).count() == 0


def test_samples_of_both_sides_of_a_split_have_the_asked_rate(spark):
    from pricelens.operators import sampling
    test, train = split.hash_split(spark.range(100_000), "id", 20, 42)
    for side in (test, train):
        share = sampling.fraction_sample(side, "id", 5).count() / side.count()
        assert 0.045 < share < 0.055


def test_what_a_place_is_compared_with_stays_flat_as_stations_grow():
    """100 times the stations: about as many distances per place, and the true nearest."""
    import numpy as np
    from pricelens.operators import nearest
    rng = np.random.default_rng(5)
    met = {}
    for n in (400, 40_000):
        stations = nearest.unit(rng.uniform(48, 49, n), rng.uniform(2, 3, n))
        places = nearest.unit(rng.uniform(48, 49, 500), rng.uniform(2, 3, 500))
        p, s, d2 = nearest.candidates(stations, places, np.full(500, np.inf))
        full = ((places[:, None] - stations[None]) ** 2).sum(axis=2)
        assert np.allclose(full.min(axis=1)[p], d2, rtol=1e-8) and set(p) == set(range(500))
        tree = nearest.Tree(stations, -(-n // nearest.BLOCK))
        leaf = tree.leaf(stations)
        order = np.argsort(leaf, kind="stable")
        leaves, first = np.unique(leaf[order], return_index=True)
        tree.set_boxes(leaves, np.minimum.reduceat(stations[order], first), np.maximum.reduceat(stations[order], first))
        met[n] = len(tree.within(places, full.min(axis=1))[0]) / 500
    assert met[40_000] < 2 * met[400] + 1
