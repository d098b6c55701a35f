"""Exact nearest station by branch and bound over a two-level tree.

The upper tree cuts space into regions of about ``REGION`` stations each, at medians of a
sample, so their number grows with the stations (to at most 2^``DEPTH``; then the regions
grow). Every task holds the boxes of its nodes. A place descends to its own region and meets
only that region's stations, in blocks of ``BLOCK``: its nearest block first, then those whose
box is no farther than what it found. With that distance it descends the upper tree again and
visits the other regions whose boxes are nearer, which are few and mostly none. What a place
is compared with does not grow with the stations.

Places and stations meet by an equi-join on (region, part): a region that holds many places is
dealt to several parts, each of which gets the region's stations once."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import haversine_km, nan_to_null
from ..session import checkpointed

REGION = 8192           # stations
DEPTH = 16              # of the upper tree at most: 65,536 regions, 3 MB of boxes
BLOCK = 64              # stations
SAMPLE_PER_REGION = 16
PLACES_PER_PART = 50_000
SLACK = 1e-9            # of squared distances; ties are settled on the great circle


def unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Unit vectors; great-circle distance grows with the straight-line distance of these."""
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)


class Tree:
    """A balanced tree of cuts in heap order (node n has children 2n and 2n + 1), and the
    boxes of what its leaves hold."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.depth = max(0, math.ceil(math.log2(max(1, leaves))))
        self.axis, self.value = np.zeros(1 << self.depth, np.int64), np.zeros(1 << self.depth)
        groups = {1: points}
        for node in range(1, 1 << self.depth):
            pts = groups.pop(node)
            if len(pts):  # at the median of the widest axis
                self.axis[node] = int(np.argmax(pts.max(axis=0) - pts.min(axis=0)))
                self.value[node] = float(np.median(pts[:, self.axis[node]]))
            right = pts[:, self.axis[node]] > self.value[node]
            groups[2 * node], groups[2 * node + 1] = pts[~right], pts[right]

    def leaf(self, xyz: np.ndarray, filled: bool = False) -> np.ndarray:
        """The leaf of each point; with ``filled`` an empty side is never taken."""
        node = np.ones(len(xyz), np.int64)
        for _ in range(self.depth):
            nxt = 2 * node + (xyz[np.arange(len(xyz)), self.axis[node]] > self.value[node])
            node = np.where(np.isinf(self.lo[nxt, 0]), nxt ^ 1, nxt) if filled else nxt
        return node

    def set_boxes(self, leaves: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.lo = np.full((2 << self.depth, 3), np.inf)
        self.hi = np.full((2 << self.depth, 3), -np.inf)
        self.lo[leaves], self.hi[leaves] = lo, hi
        for level in range(self.depth - 1, -1, -1):
            n = np.arange(1 << level, 2 << level)
            self.lo[n] = np.minimum(self.lo[2 * n], self.lo[2 * n + 1])
            self.hi[n] = np.maximum(self.hi[2 * n], self.hi[2 * n + 1])

    def apart(self, xyz: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distance of each point to the box of its node."""
        gap = np.maximum(0.0, np.maximum(self.lo[node] - xyz, xyz - self.hi[node]))
        return np.einsum("ij,ij->i", gap, gap)

    def within(self, xyz: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of all leaves whose box is no farther than the point's bound."""
        at, node = np.arange(len(xyz)), np.ones(len(xyz), np.int64)
        for _ in range(self.depth):
            at, node = np.repeat(at, 2), np.stack([2 * node, 2 * node + 1], axis=1).ravel()
            near = self.apart(xyz[at], node) <= bound[at]
            at, node = at[near], node[near]
        return at, node


def _padded(squares: float) -> float:
    return squares * (1 + SLACK) + 1e-20


def candidates(stations: np.ndarray, places: np.ndarray, bound: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, station, squared distance) of the stations that are nearest to their place, as
    far as ``SLACK`` tells, and no farther than its bound."""
    tree = Tree(stations, math.ceil(len(stations) / BLOCK))
    leaf = tree.leaf(stations)
    order = np.argsort(leaf, kind="stable")
    leaves, first, count = np.unique(leaf[order], return_index=True, return_counts=True)
    xyz = stations[order]
    tree.set_boxes(leaves, np.minimum.reduceat(xyz, first), np.maximum.reduceat(xyz, first))
    begin, size = np.zeros(2 << tree.depth, np.int64), np.zeros(2 << tree.depth, np.int64)
    begin[leaves], size[leaves] = first, count
    out = []
    for lo in range(0, len(places), 4096):
        p, most = places[lo:lo + 4096], bound[lo:lo + 4096].copy()

        def squares(at: np.ndarray, node: np.ndarray):
            n = size[node]
            ends = np.cumsum(n)
            s = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[node] - ends + n, n)
            who = np.repeat(at, n)
            diff = p[who] - xyz[s]
            return who, s, np.einsum("ij,ij->i", diff, diff)

        everyone = np.arange(len(p))
        who, _, d2 = squares(everyone, tree.leaf(p, filled=True))
        np.minimum.at(most, who, d2)
        who, s, d2 = squares(*tree.within(p, _padded(most)))
        best = most.copy()
        np.minimum.at(best, who, d2)
        near = d2 <= _padded(best[who])
        out.append((lo + who[near], order[s[near]], d2[near]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _places(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct places; a coordinate that is null or NaN is no place."""
    place = df.select(nan_to_null(F.col(lat).cast("double")).alias("_lat"),
                      nan_to_null(F.col(lon).cast("double")).alias("_lon"))
    return place.where("_lat is not null and _lon is not null").distinct()


def _in_regions(asked: DataFrame, stations: DataFrame, keep: Sequence[str], schema: str,
                part: int) -> DataFrame:
    """Candidates of the places in the regions that ``asked`` (_lat, _lon, _bound, _region)
    names: with the station's columns and the squared distance ``_d2``."""
    parts = (asked.groupBy("_region").agg(F.ceil(F.count("*") / part).cast("int").alias("_parts")))
    dealt = (asked.join(F.broadcast(parts), "_region")  # at most as many rows as regions
             .withColumn("_part", F.pmod(F.xxhash64("_lat", "_lon"), F.col("_parts")).cast("int")).drop("_parts"))
    held = (stations.join(F.broadcast(parts), "_region")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts"))
    columns = ["_sid", "_slat", "_slon", *keep]

    def meet(places: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        if not len(places) or not len(here):
            return pd.DataFrame({c: [] for c in ["_lat", "_lon", "_region", "_d2", *columns]})
        p, s, d2 = candidates(unit(here["_slat"].to_numpy(float), here["_slon"].to_numpy(float)),
                              unit(places["_lat"].to_numpy(float), places["_lon"].to_numpy(float)),
                              places["_bound"].to_numpy(float))
        found = places[["_lat", "_lon", "_region"]].iloc[p].reset_index(drop=True).assign(_d2=d2)
        return pd.concat([found, here[columns].iloc[s].reset_index(drop=True)], axis=1)

    by = ["_region", "_part"]
    return dealt.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(meet, schema)


def nearest_neighbour(points: DataFrame, stations: DataFrame, p_id: str = "id",
                      p_lat: str = "lat", p_lon: str = "lon", s_id: str = "station_id",
                      s_lat: str = "lat", s_lon: str = "lon", s_keep: Sequence[str] = (),
                      out_dist: str = "dist_km", region: int = REGION, part: int = PLACES_PER_PART
                      ) -> DataFrame:
    """Exact nearest station per point by great-circle distance; ties go to the smallest id.

    Returns ``p_id, s_id, *s_keep, out_dist``, one row per point row. Points with a null or
    NaN coordinate, or an empty station table, yield no row. The answer depends on a point's
    place only, so it is found once per distinct place and joined back."""
    sts = stations.select(
        F.col(s_id).alias("_sid"), nan_to_null(F.col(s_lat).cast("double")).alias("_slat"),
        nan_to_null(F.col(s_lon).cast("double")).alias("_slon"), *s_keep).where(
        "_slat is not null and _slon is not null")
    # Stations at the same location tie on distance, and ties go to the smallest id, so
    # only that one can ever win.
    sts = checkpointed(
        sts.groupBy("_slat", "_slon").agg(F.min_by(F.struct("_sid", *s_keep), F.col("_sid")).alias("_s"))
        .select("_s._sid", "_slat", "_slon", *[F.col("_s." + c).alias(c) for c in s_keep]))
    total = sts.count()
    regions = min(1 << DEPTH, -(-total // region))
    share = regions * SAMPLE_PER_REGION / max(total, 1)
    some = sts.where(F.pmod(F.xxhash64("_slat", "_slon"), F.lit(1 << 20)) < share * (1 << 20))
    rows = sorted(tuple(r) for r in some.select("_slat", "_slon").collect())  # about regions * SAMPLE_PER_REGION
    ll = np.array(rows, float).reshape(-1, 2)
    tree = Tree(unit(ll[:, 0], ll[:, 1]), regions)

    def place(batches):
        for pdf in batches:
            xyz = unit(pdf["_slat"].to_numpy(float), pdf["_slon"].to_numpy(float))
            yield pdf.assign(_region=tree.leaf(xyz), _x=xyz[:, 0], _y=xyz[:, 1], _z=xyz[:, 2])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sts.schema.fields)
    placed = checkpointed(sts.mapInPandas(place, f"{kinds}, _region long, _x double, _y double, _z double"))
    box = placed.groupBy("_region").agg(  # one row per region
        *[f(c).alias(f"{n}{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in ("_x", "_y", "_z")]).collect()
    tree.set_boxes(np.array([r["_region"] for r in box], np.int64),
                   *[np.array([[r[f"{n}_{c}"] for c in "xyz"] for r in box], float).reshape(-1, 3) for n in ("lo", "hi")])
    placed = placed.drop("_x", "_y", "_z")

    def at_home(batches):
        for pdf in batches:
            xyz = unit(pdf["_lat"].to_numpy(float), pdf["_lon"].to_numpy(float))
            yield pdf.assign(_bound=np.inf, _region=tree.leaf(xyz, filled=True) if box else 1)

    def elsewhere(batches):
        for pdf in batches:
            xyz, bound = unit(pdf["_lat"].to_numpy(float), pdf["_lon"].to_numpy(float)), pdf["_bound"].to_numpy(float)
            at, node = tree.within(xyz, _padded(bound))
            other = node != pdf["_region"].to_numpy()[at]
            yield pdf.iloc[at[other]].assign(_region=node[other])

    search = "_lat double, _lon double, _bound double, _region long"
    schema = "_lat double, _lon double, _region long, _d2 double, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in sts.schema.fields)
    home = checkpointed(_in_regions(_places(points, p_lat, p_lon).mapInPandas(at_home, search),
                                    placed, s_keep, schema, part))
    found = home.groupBy("_lat", "_lon").agg(F.min("_d2").alias("_bound"), F.min("_region").alias("_region"))
    asked = checkpointed(found.mapInPandas(elsewhere, search))
    near = home if asked.isEmpty() else home.unionByName(_in_regions(asked, placed, s_keep, schema, part))
    near = near.withColumn("_d", haversine_km("_lat", "_lon", "_slat", "_slon"))
    best = (near.groupBy("_lat", "_lon")
            .agg(F.min_by(F.struct("_sid", "_d", *s_keep), F.struct("_d", "_sid")).alias("_b")))
    pts = points.select(F.col(p_id), nan_to_null(F.col(p_lat).cast("double")).alias("_lat"),
                        nan_to_null(F.col(p_lon).cast("double")).alias("_lon"))
    return checkpointed(pts.join(best, ["_lat", "_lon"]).select(
        p_id, F.col("_b._sid").alias(s_id), *[F.col("_b." + c).alias(c) for c in s_keep],
        F.col("_b._d").alias(out_dist)))
