"""Plan-shape and skew checks: what the operators promise about shuffles and hot keys."""

from pyspark.sql import functions as F

from paths import SF001
from pricelens.operators import clean, split, stats
from pricelens.sources import fixtures as fx


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_freshest_per_key_limits_before_the_shuffle_and_handles_a_hot_key(spark):
    # key 0 holds a third of all rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"))
    out = clean.freshest_per_key(df, "k", [F.col("ts").desc()])
    got = {r.k: r.ts for r in out.collect()}
    assert got[0] == 29997 and len(got) == 20001
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hash_split_needs_no_exchange(spark):
    test, train = split.hash_split(fx.points(spark, SF001), "id", 20, 42)
    assert "Exchange" not in _plan(test) and "Exchange" not in _plan(train)


def test_scans_read_only_needed_columns(spark):
    q = fx.two_source(spark, SF001).select("id", "price_global")
    plan = _plan(q)
    assert "l_returnflag" not in plan and "l_shipdate" not in plan


def test_summary_is_kept_apart_from_its_input(spark):
    # both passes are over when the result is read: it comes from the brackets' values
    s = stats.summary_stats(fx.points(spark, SF001), "log_price", ["grp"])
    assert "customer.parquet" not in _plan(s)


def test_bloom_joins_are_exact_and_shuffle_little(spark):
    from pricelens.operators import bloom
    rows = [(7, "hot")] * 400 + [(i, "x") for i in range(2000)] + [(None, "none"), (None, "none")]
    df = spark.createDataFrame(rows, "id long, v string").repartition(6)
    for keys in ([7, 7, 55, 10 ** 12, None], [], list(range(0, 2000, 3))):
        ids = spark.createDataFrame([(k,) for k in keys], "id long")
        known = {k for k in keys if k is not None}
        assert sorted(r.id for r in bloom.semi_join(df, ids, "id").collect()) == sorted(
            i for i, _ in rows if i in known)
        rest = bloom.anti_join(df, ids, "id").collect()
        assert sorted((r.id, r.v) for r in rest if r.id is not None) == sorted(
            r for r in rows if r[0] is not None and r[0] not in known)
        assert sum(r.id is None for r in rest) == 2
        words, bits = bloom.bloom_filter(ids, "id")
        passed = bloom.marked(df, "id", words, bits).where("_maybe").count()
        assert passed <= sum(i in known for i, _ in rows) + 0.05 * len(rows)
        assert {r.id for r in bloom.marked(df, "id", words, bits).where("_maybe").collect()} >= {
            i for i, _ in rows if i in known}


def test_a_clean_set_is_not_shuffled_by_the_leak_check(spark):
    from pricelens.operators import bloom
    df, ids = fx.points(spark, SF001), spark.range(10 ** 6, 10 ** 6 + 50)
    words, bits = bloom.bloom_filter(ids, "id")
    plan = _plan(bloom.marked(df, "id", words, bits))
    assert "Exchange hashpartitioning(_word" not in plan.replace("BroadcastExchange", "") \
        and "SortMergeJoin" not in plan
    assert bloom.marked(df, "id", words, bits).where("_maybe").count() < 0.05 * df.count()
    assert {r.leaked_rows for r in split.leak_counts({"a": df}, ids).collect()} == {0}


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    from pricelens.sources import io
    a = spark.range(0, 3000, 1, 5).select("id", (F.col("id") * 2).alias("x"))
    b = spark.range(0, 3000, 3, 4).select("id", F.lit("y").alias("y"))
    for name, df in (("a", a), ("b", b)):
        io.save_bucketed(df, str(tmp_path / name), f"bucketed_{name}", "id", 4)
        spark.sql(f"DROP TABLE bucketed_{name}")  # another session has the files only
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = io.open_bucketed(spark, str(tmp_path / "a"), "bucketed_a", "id long, x long", "id", 4)
        y = io.open_bucketed(spark, str(tmp_path / "b"), "bucketed_b", "id long, y string", "id", 4)
        for how, n in (("inner", 1000), ("left_semi", 1000), ("left_anti", 2000)):
            joined = x.join(y, "id", how)
            assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
            assert joined.count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_a")
        spark.sql("DROP TABLE IF EXISTS bucketed_b")
