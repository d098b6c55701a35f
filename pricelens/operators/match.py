"""Matching two listing sources by key and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import planar_distance


def id_match(local: DataFrame, other: DataFrame, key: str = "id", suffix: str = "_glob"
             ) -> DataFrame:
    """Inner equi-join on the key; the other source's columns get ``suffix``.

    No broadcast hint: both sources grow with the data, so the strategy is left to AQE,
    which broadcasts only when the runtime size of a side is under the threshold.
    """
    renamed = other.select(*[F.col(c).alias(c + suffix) for c in other.columns])
    j = local.join(renamed, local[key] == renamed[key + suffix], "inner")
    return j.drop(key + suffix)


def coord_match(matched: DataFrame, lat: str, lon: str, lat2: str, lon2: str,
                tolerance: float = 0.0001, out: str = "coord_dist") -> DataFrame:
    """Keep id-matched rows whose planar coordinate distance (degrees) is < tolerance."""
    d = planar_distance(lat, lon, lat2, lon2)
    return matched.withColumn(out, d).where(F.col(out) < F.lit(float(tolerance)))


def unmatched_rows(other: DataFrame, local: DataFrame, key: str = "id") -> DataFrame:
    """Distinct whole rows of ``other`` whose key has no match in ``local``: what is left of
    ``other`` after its matched rows are taken away (EXCEPT DISTINCT), as one anti join."""
    return other.join(local.select(key), key, "left_anti").select(*other.columns).distinct()


def unmatched_keys(other: DataFrame, local: DataFrame, key: str = "id") -> DataFrame:
    """Distinct keys of ``other`` with no match in ``local`` (EXCEPT DISTINCT)."""
    return other.select(key).subtract(local.select(key))
