"""Multi-index hashing against brute force: whole radii, exact scores, recall, odd rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelens.llm.neighbours import Slice, best_of, copies_kept, cosines, search, train


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.integers(0, 256), st.integers(1, 400), st.floats(0, 0.5))
def test_probing_retrieves_every_code_within_the_radius(seed, radius, n, flips):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2, (3, 256), dtype=np.uint8)
    def codes(rows):
        bits = base[rng.integers(0, 3, rows)] ^ (rng.random((rows, 256)) < flips)
        return np.packbits(bits, axis=1).view(np.uint16), bits
    mine, mine_bits = codes(n)
    asked, asked_bits = codes(5)
    rows = Slice(np.arange(n), np.arange(n, dtype=float)[:, None] + 1, mine, 5)
    radii = np.minimum(radius + np.arange(5), 256)
    got = set(zip(*(x.tolist() for x in rows.within(asked, radii))))
    apart = (asked_bits[:, None] != mine_bits[None]).sum(axis=2)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(apart <= radii[:, None]))))


def test_best_of_breaks_ties_by_id_and_counts_an_id_once():
    q, i, s = np.array([0, 0, 0, 0, 1]), np.array([9, 4, 4, 7, 1]), np.array([.5, .5, .4, .5, .1])
    assert best_of(q, i, s, 2).tolist() == [1, 3, 4]


def test_copies_kept():
    ids, v = np.array([5, 3, 9, 3, 1, 8]), np.array([[1.], [1.], [1.], [1.], [2.], [1.]])
    assert sorted(ids[copies_kept(ids, v, 1)].tolist()) == [1, 3, 5]


def brute(ids, v, asked, k=5):
    unit = v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(asked):
        near = unit @ unit[q]
        order = [j for j in np.lexsort((ids, -near)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), near[j]) for j in order]
    return out


def results(df):
    out = {}
    for r in df.orderBy("query", "rank").collect():
        out.setdefault(r["query"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("kind", ["spread", "clusters"])
def test_recall_with_a_small_sample(spark, kind):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(3000, 48))
    if kind == "clusters":
        v = v[rng.integers(0, 40, 3000)] + 0.3 * v
    ids = rng.permutation(3000) * 7
    df = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, v)],
                               "vec_id long, embedding array<double>").repartition(6)
    got = results(search(df, df.where(F.col("vec_id") % 50 == 0), sample=300))
    want = brute(ids, v, ids % 50 == 0)
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    hit = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert hit >= 0.9
    where = {int(i): r for i, r in zip(ids, v)}
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        for i, s in found:
            assert s == pytest.approx(cosines(where[q][None], where[i][None])[0], abs=1e-12)


SCHEMA = "vec_id long, embedding array<float>, id string, score double, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.5, 1) for i, v in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [(0, [1., 0.]), (1, [2., 0.]), (2, [0., 1.]), (3, [1., 1.]), (3, [1., 1.]), (4, None), (5, []),
            (6, [0., 0.]), (7, [None, 1.]), (8, [float("nan"), 1.]), (9, [float("inf"), 1.]),
            (10, [1., 2., 3.]), (None, [1., 0.]), (50, [-1., -0.])]
    df = frame(spark, rows)
    got = results(search(df, df.where(F.col("vec_id") % 50 == 0)))
    assert [i for i, _ in got[0]] == [1, 3, 2, 50] and [i for i, _ in got[50]] == [2, 3, 0, 1]
    assert got[0][0][1] == 1.0 and got[50][-1][1] == -1.0


def test_many_copies_answer_with_the_smallest_ids(spark):
    rows = [(i, [1., 2., 3.]) for i in range(200)] + [(i, [3., float(i), 1.]) for i in range(200, 220)]
    df = frame(spark, rows).repartition(7)
    got = results(search(df, df.where(F.col("vec_id").isin(0, 150)), sample=50))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[150]] == [0, 1, 2, 3, 4]


def test_empty_and_single(spark):
    none, one = frame(spark, []), frame(spark, [(0, [1., 2.])])
    assert search(none, none).count() == 0 and search(one, one).count() == 0


def test_codes_of_a_constant_sample():
    codes = train(np.arange(3), np.ones((3, 4)))
    assert codes.encode(np.ones((2, 4))).shape == (2, 16) and codes.radius(np.array([-2.0, 1.0])).tolist() == [256, 256]
