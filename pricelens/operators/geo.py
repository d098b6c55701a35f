"""Geographic features.

* Site distances (J6): the site list is a small dimension (one output column per site),
  so it is collected once and unrolled into column expressions:
  a single projection, no join at all.
* Nearest neighbour (J7): see ``nearest``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (EARTH_RADIUS_KM, count_below, flag_above, flag_any_below,
                                 haversine_km, nan_to_null)
from .nearest import nearest_neighbour  # noqa: F401


def site_column(site_id: str, prefix: str = "dist_") -> str:
    return prefix + re.sub(r"[^0-9a-z]+", "_", str(site_id).lower()).strip("_")


def site_distances(points: DataFrame, sites: DataFrame, lat: str = "lat", lon: str = "lon",
                   site_id: str = "site_id", site_lat: str = "lat", site_lon: str = "lon",
                   exclude: Sequence[str] = (), prefix: str = "dist_",
                   only: Sequence[str] = ()) -> DataFrame:
    """Add one ``dist_<site>`` column (km) per site, skipping ``exclude`` ids (or keeping
    only the ``only`` ids)."""
    chosen = sites.where(~F.col(site_id).isin(list(exclude))) if exclude else sites
    chosen = chosen.where(F.col(site_id).isin(list(only))) if only else chosen
    rows = chosen.select(site_id, site_lat, site_lon).collect()  # each names an output column
    rows = sorted(rows, key=lambda r: str(r[0]))
    cols = {site_column(r[0], prefix): haversine_km(lat, lon, F.lit(float(r[1])),
                                                     F.lit(float(r[2]))) for r in rows}
    return points.withColumns(cols)


def near_flags(df: DataFrame, site_cols: Sequence[str], metro_col: str,
               near_km: float = 1.0, far_km: float = 0.5) -> DataFrame:
    """near_site: any site strictly < near_km; sites_nearby: how many; far_from_metro:
    nearest station > far_km."""
    return df.withColumns({
        "near_site": flag_any_below(site_cols, near_km),
        "sites_nearby": count_below(site_cols, near_km),
        "far_from_metro": flag_above(nan_to_null(F.col(metro_col)), far_km),
    })


def coverage(df: DataFrame, dist_col: str, within_km: float = 0.5) -> DataFrame:
    """min / mean / max distance and share within ``within_km`` (A27; median via
    exact quantile in the caller)."""
    return df.agg(F.min(dist_col).alias("min_km"), F.avg(dist_col).alias("mean_km"),
                  F.max(dist_col).alias("max_km"),
                  (F.avg((F.col(dist_col) < within_km).cast("double")) * 100).alias("pct_within"))


def bbox(df: DataFrame, lat: str, lon: str, lat_range, lon_range) -> DataFrame:
    """Axis-range restriction."""
    return df.where(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))
