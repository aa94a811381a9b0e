"""Distance on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def haversine(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Metres from (lat, lon) to the anchor; all angles in radians."""
    half_lat = F.sin((lat - F.lit(lat0)) / 2)
    half_lon = F.sin((lon - F.lit(lon0)) / 2)
    a = half_lat * half_lat + F.cos(F.lit(lat0)) * F.cos(lat) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
