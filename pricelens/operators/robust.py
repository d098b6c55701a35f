"""Huber regressions of many groups at once by weighted Gram matrices.

Iteratively reweighted least squares with a concomitant scale: the objective per group is
sum(sigma + H(r / sigma) sigma) + alpha |w|^2. A group of up to TASK_ROWS is fitted by one
task, which holds its rows for all steps: one job for all such groups. For larger ones a step
is one aggregation: every task adds up w x x', w x y and the scale's sums of the groups it
holds (p^2 numbers per group) and the partial sums meet per group, where the next coefficients
are solved for. Rows never leave their tasks; the coefficients of the groups (groups x p
numbers) are all that the driver sees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

TASK_ROWS = 50_000  # rows of a group that one task fits

_PARTIAL = "fit int, p int, gram array<double>, moment array<double>, n double, inner double, outer double, yy double"


def _sums(x: np.ndarray, y: np.ndarray, state: tuple | None, epsilon: float) -> tuple:
    """The sums of one group's rows: Gram matrix and moments under the weights of ``state``
    (beta, sigma), squared residuals inside the bound, and rows outside."""
    xa = np.hstack([x, np.ones((len(x), 1))])
    if state is None:
        w, inner, outer = np.ones(len(y)), 0.0, 0.0
    else:
        beta, sigma = state
        r = y - xa @ beta
        a = np.abs(r)
        inlier = a <= epsilon * sigma
        w = np.where(inlier, 1.0, epsilon * sigma / np.maximum(a, 1e-300))
        inner, outer = float(np.sum(r[inlier] ** 2)), float((~inlier).sum())
    xw = xa.T * w
    return xw @ xa, xw @ y, float(len(y)), inner, outer, float(y @ y)


def _step(gram, moment, n, inner, outer, yy, state, epsilon: float, alpha: float) -> tuple:
    """(beta, sigma) that follow from a group's sums."""
    p = len(moment) - 1
    ridge = np.diag(np.append(np.full(p, alpha * (state[1] if state else 1.0)), 0.0))
    # least squares, not solve: with fewer rows than columns the least solution is defined
    beta = np.linalg.lstsq(gram + ridge, moment, rcond=None)[0]
    if state is None:
        sse = yy - 2 * beta @ moment + beta @ gram @ beta
        return beta, max(np.sqrt(max(sse, 0.0) / n), 1e-12)
    free = n - epsilon ** 2 * outer
    sigma = np.sqrt(inner / free) if free > 0 and inner > 0 else state[1]
    return beta, max(float(sigma), 1e-12)


def _ended(state: tuple, was: tuple, first: float, tol: float) -> bool:
    """Converged, or the scale fell to 1e-7 of its first one."""
    beta, sigma = state
    still = np.max(np.abs(beta - was[0])) <= tol * (1 + np.max(np.abs(beta))) and abs(sigma - was[1]) <= tol * was[1]
    return bool(still or sigma <= 1e-7 * first)


def _fitted(x: np.ndarray, y: np.ndarray, epsilon: float, alpha: float, max_steps: int, tol: float) -> tuple:
    """(beta, sigma, steps) of one group whose rows are here."""
    state = _step(*_sums(x, y, None, epsilon), None, epsilon, alpha)
    first, steps = state[1], 1
    while steps < max_steps:
        was, state = state, _step(*_sums(x, y, state, epsilon), state, epsilon, alpha)
        steps += 1
        if _ended(state, was, first, tol):
            break
    return *state, steps


def huber_groups(rows: DataFrame, epsilon: float = 1.35, alpha: float = 1e-4, max_steps: int = 100,
                 tol: float = 1e-8) -> dict[int, tuple[np.ndarray, float, float, int]]:
    """``rows`` (fit int, x array<double>, y double) -> {fit: (weights, intercept, sigma, steps)}.

    All x of a fit have the same length. A fit whose scale falls to 1e-7 of its first one runs
    through its points; it ends there."""
    rows = rows.select("fit", "x", "y")
    size = {r["fit"]: r["n"] for r in rows.groupBy("fit").agg(F.count("*").alias("n")).collect()}
    small = sorted(f for f, n in size.items() if n <= TASK_ROWS)
    large = sorted(size.keys() - set(small))
    found = {}
    if small:
        def whole(t: pa.Table) -> pa.Table:
            y = t.column("y").to_numpy()
            x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            beta, sigma, steps = _fitted(x, y, epsilon, alpha, max_steps, tol)
            return pa.table({"fit": pa.array([t.column("fit")[0].as_py()], pa.int32()),
                             "beta": pa.array([beta], pa.list_(pa.float64())), "sigma": [float(sigma)],
                             "steps": pa.array([steps], pa.int32())})

        # as many parts as the shuffle has, or merging small ones would leave few tasks
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        mine = (rows if not large else rows.where(F.col("fit").isin(small))).repartition(parts, "fit")
        for r in mine.groupBy("fit").applyInArrow(whole, "fit int, beta array<double>, sigma double, steps int").collect():
            found[r["fit"]] = np.array(r["beta"][:-1]), float(r["beta"][-1]), r["sigma"], r["steps"]
    if large:
        found |= _in_steps(rows.where(F.col("fit").isin(large)), large, epsilon, alpha, max_steps, tol)
    return found


def _in_steps(rows: DataFrame, fits: list, epsilon: float, alpha: float, max_steps: int, tol: float) -> dict:
    """The fits of groups that no task holds. Those that have converged leave the loop: later
    steps read the rows of the others only."""
    rows = checkpointed(rows.repartition("fit"))
    state: dict[int, tuple | None] = {f: None for f in fits}
    first: dict[int, float] = {}
    steps, taken, open_fits = 0, {}, sorted(state)
    while open_fits and steps < max_steps:
        steps += 1
        now = {f: state[f] for f in open_fits}

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            for b in batches:
                fit = b.column("fit").to_numpy()
                y = b.column("y").to_numpy()
                at = b.column("x").offsets.to_numpy()
                flat = b.column("x").values.to_numpy(zero_copy_only=False)
                for f in np.unique(fit):
                    mine = np.flatnonzero(fit == f)
                    p = at[mine[0] + 1] - at[mine[0]]
                    x = flat[at[mine][:, None] + np.arange(p)]
                    s = _sums(x, y[mine], now[int(f)], epsilon)
                    total[int(f)] = s if int(f) not in total else tuple(a + c for a, c in zip(total[int(f)], s))
            for f, (gram, moment, *rest) in total.items():
                yield pa.RecordBatch.from_pydict(
                    {"fit": pa.array([f], pa.int32()), "p": pa.array([len(moment)], pa.int32()),
                     "gram": [gram.ravel()], "moment": [moment],
                     **{k: [v] for k, v in zip(("n", "inner", "outer", "yy"), rest)}})

        def solve(parts: pd.DataFrame) -> pd.DataFrame:
            f, p = int(parts["fit"].iloc[0]), int(parts["p"].iloc[0])
            beta, sigma = _step(sum(parts["gram"]).reshape(p, p), sum(parts["moment"]),
                                *[float(parts[c].sum()) for c in ("n", "inner", "outer", "yy")],
                                now[f], epsilon, alpha)
            return pd.DataFrame({"fit": [f], "beta": [beta], "sigma": [sigma]})

        found = (rows.where(F.col("fit").isin(open_fits)).mapInArrow(partial, _PARTIAL)
                 .groupBy("fit").applyInPandas(solve, "fit int, beta array<double>, sigma double").collect())
        for r in found:
            f, beta, sigma = r["fit"], np.array(r["beta"]), r["sigma"]
            was, state[f], taken[f] = state[f], (beta, sigma), steps
            if was is None:
                first[f] = sigma
                continue
            if _ended(state[f], was, first[f], tol):
                open_fits.remove(f)
    return {f: (s[0][:-1], float(s[0][-1]), float(s[1]), taken[f]) for f, s in state.items() if s is not None}
