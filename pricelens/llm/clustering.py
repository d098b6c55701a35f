"""Centroid clustering of integer vectors by equal-average equal-variance search.

Rounds of assignment and exact integer means. Centroids are sorted by the sum of their
components. The search of a vector starts where its own sum falls in that order and scans
outward on both sides. With d components, sums s and deviations v = d sum(x^2) - s^2,
    d * distance >= (s_x - s_c)^2 + (sqrt(v_x) - sqrt(v_c))^2,
so a side ends when the first term alone exceeds d times the best distance (the sums beyond
are farther still), and a centroid whose two terms exceed it is passed over. What remains is
finished in exact integers; equal distances go to the smaller number.

A round ships the centroids to the tasks and brings back one sum per task, centroid and
component; Spark adds them, and centroids x components numbers reach the driver. No vector
leaves its task. The tasks read the input again in each round, so a lost executor costs the
tasks it ran.

Defined cases: vectors that are null, of another number of components, or that hold a null
or a value that is not finite take no part; components beyond +-2^24 after scaling count as
+-2^24, so that distances fit a long; repeated rows are vectors of their own and share a
hash, so they may start several equal centroids (the higher of them stays empty and keeps
its place); a null id has no hash, starts after all others and takes part; fewer vectors than centroids start fewer
centroids; an empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64.0
LIMIT = 1 << 24
FARTHEST = 1 << 56  # above any squared distance of 64 components within LIMIT


def usable(vec: str, dims: int) -> Column:
    """The vector has ``dims`` components, all of them finite numbers."""
    return ((F.size(vec) == dims)
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def integers(values: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) of every component, x taken as a double."""
    return np.clip(np.floor(scale * values.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every row of ``x``, and how
    many exact distances that took."""
    n, d = x.shape
    k = len(centroids)
    order = np.argsort(centroids.sum(axis=1), kind="stable")
    cents = centroids[order]
    c_sum = cents.sum(axis=1)
    c_dev = np.sqrt((d * (cents * cents).sum(axis=1) - c_sum ** 2).astype(np.float64))
    x_sum = x.sum(axis=1)
    x_dev = np.sqrt((d * (x * x).sum(axis=1) - x_sum ** 2).astype(np.float64))
    right = np.searchsorted(c_sum, x_sum)
    left = right - 1
    best, who = np.full(n, FARTHEST), np.full(n, k)
    live, finished, far = np.arange(n), 0, np.int64(1 << 31)  # above any gap of sums
    while len(live):
        lo, hi, at = left[live], right[live], x_sum[live]
        down = np.where(lo >= 0, at - c_sum[np.maximum(lo, 0)], far)
        up = np.where(hi < k, c_sum[np.minimum(hi, k - 1)] - at, far)
        gap = np.minimum(down, up)
        go_on = (gap < far) & (gap * gap <= d * best[live])
        live, lo, hi, gap = live[go_on], lo[go_on], hi[go_on], gap[go_on]
        below = down[go_on] <= up[go_on]
        c = np.where(below, lo, hi)
        left[live[below]] -= 1
        right[live[~below]] += 1
        # doubles: a margin above their rounding keeps every centroid that may win or tie
        bound = gap.astype(np.float64) ** 2 + (x_dev[live] - c_dev[c]) ** 2
        near = bound <= (d * best[live]).astype(np.float64) * (1 + 1e-9) + 1.0
        rows, c = live[near], c[near]
        diff = x[rows] - cents[c]
        dist = np.einsum("ij,ij->i", diff, diff)
        finished += len(rows)
        better = (dist < best[rows]) | ((dist == best[rows]) & (order[c] < who[rows]))
        best[rows[better]], who[rows[better]] = dist[better], order[c[better]]
    return who, best, finished


def _matrix(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(-1, dims), scale)


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def initial_centroids(kept: DataFrame, count: int, scale: float) -> np.ndarray:
    """The vectors whose ``1:<id>`` have the smallest SHA-256, in that order."""
    first = (kept.withColumn("h", F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256))
             .orderBy(F.col("h").asc_nulls_last(), "v").limit(count).collect())
    return np.array([integers(np.array(r["v"]), scale) for r in first], np.int64)


def _round(kept: DataFrame, centroids: np.ndarray, dims: int, scale: float) -> np.ndarray:
    """The centroids after one assignment of all vectors."""
    k = len(centroids)

    def partial(batches):
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in _batches(batches):
            x = _matrix(b.column("v"), dims, scale)
            who = nearest(x, centroids)[0]
            for c in np.unique(who):
                total[c] += x[who == c].sum(axis=0)
            count += np.bincount(who, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": np.repeat(some, dims), "component": np.tile(np.arange(dims), len(some)),
            "total": total[some].ravel(), "n": np.repeat(count[some], dims)})

    sums = (kept.select("v").mapInArrow(partial, "cluster long, component long, total long, n long")
            .groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
            .collect())  # at most centroids x components rows
    moved = centroids.copy()
    for r in sums:
        moved[r["cluster"], r["component"]] = r["total"] // r["n"]
    return moved


def cluster(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
            centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS,
            scale: float = SCALE) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes
    part; ``centroid`` is the array of its final centroid's components."""
    spark = df.sparkSession
    kept = df.where(usable(vec_col, dims)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    id_type = kept.schema["id"].dataType
    cents = initial_centroids(kept, centroids, scale)
    if not len(cents):
        return spark.createDataFrame([], f"id {id_type.simpleString()}, cluster int, distance long, "
                                         "cluster_inertia long, inertia long, centroid array<long>")
    for _ in range(rounds):
        cents = _round(kept, cents, dims, scale)

    def assign(batches):
        for b in _batches(batches):
            who, dist, _ = nearest(_matrix(b.column("v"), dims, scale), cents)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(who, pa.int32()), pa.array(dist, pa.int64())],
                ["id", "cluster", "distance"])

    found = kept.mapInArrow(assign, f"id {id_type.simpleString()}, cluster int, distance long")
    per = {r["cluster"]: r["s"] for r in  # one row per centroid
           found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    totals = spark.createDataFrame(
        [(c, s, sum(per.values()), cents[c].tolist()) for c, s in per.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(totals), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

