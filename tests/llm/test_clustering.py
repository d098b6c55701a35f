"""Equal-average equal-variance clustering against brute force."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm.clustering import LIMIT, cluster, integers, nearest


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 17), st.integers(1, 40), st.sampled_from([0, 1, 3, 60, LIMIT]),
       st.integers(0, 2 ** 32 - 1))
def test_search_is_exact_with_ties(d, k, n, most, seed):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-most, most + 1, (n, d)), rng.integers(-most, most + 1, (k, d))
    all_pairs = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    who, dist, _ = nearest(x, c)
    assert (who == all_pairs.argmin(axis=1)).all() and (dist == all_pairs.min(axis=1)).all()


def test_bounds_save_exact_distances():
    rng = np.random.default_rng(1)
    c = np.arange(16)[:, None] * 50 + rng.integers(0, 5, (16, 64))
    x = c[rng.integers(0, 16, 2000)] + rng.integers(-9, 10, (2000, 64))
    assert nearest(x, c)[2] < 2 * len(x)  # of 16 a vector


def brute(rows, centroids=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:centroids]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for step in range(rounds + 1):
        who = [min(range(len(cents)), key=lambda c: (dist(v, cents[c]), c)) for _, v in kept]
        if step < rounds:
            for c in set(who):
                mine = [v for w, (_, v) in zip(who, kept) if w == c]
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted((i, w, dist(v, cents[w]), cents[w]) for w, (i, v) in zip(who, kept))


SCHEMA = "vec_id long, embedding array<float>, id string, cluster int"


def test_rounds_equal_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=64)]) for i in range(120)]
    good += [(7, good[7][1]), (8, good[3][1])]  # a repeated row and an equal vector
    bad = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63),
           (205, [float("nan")] + [1.0] * 63), (206, [float("inf")] * 64)]
    df = spark.createDataFrame([(i, v, "x", 9) for i, v in good + bad], SCHEMA).repartition(5)
    got = cluster(df).collect()
    want = brute(good + bad)
    assert sorted((r["id"], r["cluster"], r["distance"], r["centroid"]) for r in got) == want
    assert {r["inertia"] for r in got} == {sum(w[2] for w in want)}
    for r in got:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])


def test_few_vectors_null_ids_and_empty_tables(spark):
    rows = [(1, [0.5] * 64, None, None), (None, [0.25] * 64, None, None)]
    got = cluster(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["id"]), r["cluster"], r["distance"]) for r in got) == [("1", 0, 0), ("None", 1, 0)]
    assert cluster(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("value,want", [(-0.001, -1), (0.0, 0), (1.9999, 127), (3e30, LIMIT), (-3e30, -LIMIT)])
def test_floor_and_limit(value, want):
    assert integers(np.array([value], np.float32))[0] == want
