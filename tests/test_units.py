"""Literal-row unit tests (hand-computed expectations)."""

import math

import pytest
from pyspark.sql import functions as F

from pricelens.functions import columns as fc
from pricelens.operators import clean, dist, metrics, quality, sampling, split, stats


def test_currency_parse(spark):
    df = spark.createDataFrame([("$1,234.50",), ("",), (None,), ("abc",), ("$0.00",)], "p string")
    got = [r[0] for r in df.select(fc.parse_currency("p")).collect()]
    assert got[0] == pytest.approx(1444.365)
    assert got[1:4] == [None, None, None]
    assert got[4] == 0.0
    valid = df.select(fc.parse_currency("p").alias("x")).where(fc.is_valid_price("x"))
    assert valid.count() == 1


def test_freshest_tie_break_is_stable(spark):
    rows = [(1, "2024-01-01", 10, "$5"), (1, "2024-01-01", 11, "$6"), (2, "2024-01-02", 1, "$7")]
    df = spark.createDataFrame(rows, "id long, last_scraped string, row_key long, price string")
    for _ in range(2):
        out = clean.freshest_per_key(df.repartition(3), "id",
                                     [F.col("last_scraped").desc(), F.col("row_key").desc()])
        got = sorted((r.id, r.row_key) for r in out.collect())
        assert got == [(1, 11), (2, 1)]


def test_dedup_before_validity(spark):
    rows = [(1, "2024-02-01", 2, None), (1, "2024-01-01", 1, "$10.00")]
    df = spark.createDataFrame(rows, "id long, last_scraped string, row_key long, price string")
    assert clean.local_silver(df).count() == 0


def test_coalesced_price(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, None, None), (3, 3.0, 9.0)],
                               "id long, a double, b double")
    got = dict(quality.coalesced_price(df, "id", "a", "b").collect())
    assert got == {1: 5.0, 2: None, 3: 3.0}


def test_haversine_known_and_zero(spark):
    df = spark.createDataFrame([(48.8566, 2.3522, 48.8584, 2.2945), (1.0, 2.0, 1.0, 2.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(fc.haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(4.226, abs=5e-4)
    assert got[1] == 0.0


def test_proximity_strict(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.999, 3.0)], "d1 double, d2 double")
    got = [r[0] for r in df.select(fc.flag_any_below(["d1", "d2"], 1.0)).collect()]
    assert got == [0, 1]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    h = dist.histogram(df, {"v": "v"}, bins=5).collect()
    counts = {r.bin: r["count"] for r in h}
    assert counts[4] == 1 and counts[0] == 1 and sum(counts.values()) == 3


def test_row_least_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(None, 2.0), (float("nan"), 2.0)], "a double, b double")
    got = [r[0] for r in df.select(F.least(fc.nan_to_null("a"), fc.nan_to_null("b"))).collect()]
    assert got == [2.0, 2.0]


def test_median_imputation(spark):
    from pyspark.ml.feature import Imputer
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,), (9.0,)], "x double")
    imp = Imputer(inputCols=["x"], outputCols=["y"], strategy="median", relativeError=0.0)
    vals = [r.y for r in imp.fit(df).transform(df).collect()]
    assert vals == [1.0, 4.0, 4.0, 4.0, 9.0]


def test_one_hot_unseen_is_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("z",)], "c string")
    p = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep"),
                         OneHotEncoder(inputCols=["i"], outputCols=["v"])]).fit(train)
    v = p.transform(test).first().v
    assert v.numNonzeros() == 0


def test_log_metrics_actual_zero(spark):
    df = spark.createDataFrame([(0.0, 0.1), (math.log1p(100.0), math.log1p(110.0))],
                               "y double, p double")
    m = metrics.log_model_metrics(df, "y", "p").first()
    assert m.mape_pct == pytest.approx(10.0)


def test_exact_sample_caps_at_pool(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    assert sampling.exact_sample(df, "k", 100).count() == 7


def test_blocks_7_groups_size_3(spark):
    df = spark.createDataFrame([(g,) for g in range(7)], "grp long")
    b = sampling.group_blocks(df, "grp", 3)
    sizes = sorted(r["count"] for r in b.groupBy("block").count().collect())
    assert sizes == [1, 3, 3]


def test_leak_check_raises_naming_set(spark):
    test = spark.createDataFrame([(1,), (2,)], "id long")
    clean_train = spark.createDataFrame([(3,)], "id long")
    leaky = spark.createDataFrame([(2,), (5,)], "id long")
    with pytest.raises(split.LeakError, match="global_train"):
        split.assert_no_leak({"local_train": clean_train, "global_train": leaky}, test)
    split.assert_no_leak({"local_train": clean_train}, test)


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    r2 = df.agg((1 - F.sum(F.pow(F.col("y") - F.col("p"), 2))
                 / (F.count(F.lit(1)) * F.var_pop("y"))).alias("r2")).first().r2
    assert r2 == pytest.approx(0.732142857)


def test_inverse_normal_accuracy():
    from statistics import NormalDist
    for p in [1e-6, 0.01, 0.02425, 0.1, 0.5, 0.9, 0.99, 1 - 1e-6]:
        # published relative error bound of the approximation: 1.15e-9
        assert fc.inverse_normal_py(p) == pytest.approx(NormalDist().inv_cdf(p), rel=1.2e-9)


def test_exact_quantiles_match_pandas(spark):
    import pandas as pd
    vals = [5.0, 1.0, 3.0, 3.0, 9.0, 2.0, 7.0, None, float("nan")]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vals)], "g int, v double")
    got = {(r.g, r.prob): r.quantile for r in
           stats.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], ["g"]).collect()}
    pdf = pd.DataFrame([(i % 2, v) for i, v in enumerate(vals)], columns=["g", "v"])
    for (g, p), q in got.items():
        assert q == pytest.approx(pdf[pdf.g == g].v.dropna().quantile(p))


def test_superhost_and_host_year(spark):
    from pricelens.operators.features import host_year, superhost_flag
    df = spark.createDataFrame([("t", "2016-05-03"), ("f", None), ("x", "2020-01-01")],
                               "s string, d string")
    got = [(r[0], r[1]) for r in df.select(superhost_flag("s"), host_year("d")).collect()]
    assert got == [(1.0, 2016.0), (0.0, None), (None, 2020.0)]


def test_adapt_keeps_originals_and_adds_literals(spark):
    from pricelens.operators.features import adapt_to_global, require_columns
    df = spark.createDataFrame([(1, 48.8, 2.3)], "id long, latitude double, longitude double")
    with pytest.raises(ValueError, match="accommodates"):
        adapt_to_global(df)
    a = adapt_to_global(df, {"lat": "latitude", "long": "longitude"})
    r = a.first()
    assert (r.latitude, r.lat, r.long, r.city) == (48.8, 48.8, 2.3, "paris")
    with pytest.raises(ValueError, match="guests"):
        require_columns(a, ["lat", "guests"])


def test_csv_multiline_quoted(spark, tmp_path):
    from pricelens.sources.io import read_listings_csv
    p = tmp_path / "l.csv"
    p.write_text('id,name,price\n1,"two\nlines, and ""quotes""","$1,000.00"\n2,plain,$5.00\n')
    df = read_listings_csv(spark, str(p), "id long, name string, price string")
    rows = sorted(df.collect())
    assert rows[0].name == 'two\nlines, and "quotes"' and rows[0].price == "$1,000.00"
    assert rows[1].price == "$5.00"


def test_leak_counts_use_keys_not_pairs(spark):
    """Duplicate test keys do not inflate the count (semi join, not inner join)."""
    test = spark.createDataFrame([(1,), (1,), (1,)], "id long")
    train = spark.createDataFrame([(1,), (2,)], "id long")
    got = {r.set_name: r.leaked_rows for r in split.leak_counts({"t": train}, test).collect()}
    assert got == {"t": 1}


def test_remove_ids_with_a_hot_key(spark):
    """A key holding a third of the rows is removed whole, the rest is kept whole."""
    rows = [(7,)] * 300 + [(i,) for i in range(100, 700)]
    df = spark.createDataFrame(rows, "id long")
    ids = spark.createDataFrame([(7,), (150,)], "id long")
    out = split.remove_ids(df, ids, "id")
    assert out.count() == 599 and out.where("id = 7").count() == 0
