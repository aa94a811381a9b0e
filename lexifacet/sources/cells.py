"""Places laid out by geographic cells of one square degree.

A table written in the order of its cells lets a radius search read only the row groups
near its anchor: the circle becomes at most two ranges of cells per degree of latitude, which reach the scan; the
distance then decides. Latitudes lie within a quarter turn of the equator, longitudes may be any angle; rows
whose coordinates are null or not a number are within no radius.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, haversine

ROWS, COLUMNS = 180, 360
HALF_TURN_M = math.pi * EARTH_RADIUS_M


def cell_of(lat: Column, lon: Column) -> Column:
    """The cell's number: degrees of latitude from the south pole, then of longitude."""
    row = F.greatest(F.lit(0), F.least(F.lit(ROWS - 1), F.floor(F.degrees(lat)) + ROWS // 2))
    column = F.pmod(F.floor(F.degrees(lon)), F.lit(COLUMNS))
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return F.when(known, row * COLUMNS + column).cast("int")


def cell_ranges(lat0: float, lon0: float, metres: float) -> list[tuple[int, int]]:
    """Ranges of cells, both ends included, that cover a circle around the anchor."""
    turn = metres / EARTH_RADIUS_M * (1 + 1e-9) + 1e-9
    bounds = math.degrees(lat0 - turn), math.degrees(lat0 + turn)
    low, high = (max(0, min(ROWS - 1, math.floor(x) + ROWS // 2)) for x in bounds)
    if max(abs(x) for x in bounds) >= 90:
        return [(low * COLUMNS, high * COLUMNS + COLUMNS - 1)]
    wide = math.degrees(math.asin(min(1.0, math.sin(turn) / math.cos(lat0)))) + 1e-7
    first, last = (math.floor(math.degrees(lon0) + side * wide) for side in (-1, 1))
    if last - first >= COLUMNS - 1:
        return [(low * COLUMNS, high * COLUMNS + COLUMNS - 1)]
    a, b = first % COLUMNS, last % COLUMNS
    columns = [(a, b)] if a <= b else [(0, b), (a, COLUMNS - 1)]
    return [(row * COLUMNS + x, row * COLUMNS + y) for row in range(low, high + 1) for x, y in columns]


def write_cells(df: DataFrame, path: str, lat: str, lon: str) -> DataFrame:
    """Write ``df`` with a ``cell`` column, in its order, and read it back. A crowded cell may span
    several files, as rows of one cell are spread by their coordinates' hash."""
    placed = df.withColumn("cell", cell_of(F.col(lat), F.col(lon)))
    laid = placed.repartitionByRange("cell", F.xxhash64(lat, lon)).sortWithinPartitions("cell")
    laid.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def within(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float, metres: float) -> DataFrame:
    """Rows of a table with cells at most ``metres`` from the anchor, with ``geodist``."""
    near = reduce(lambda a, b: a | b, (F.col("cell").between(x, y) for x, y in cell_ranges(lat0, lon0, metres)))
    return df.filter(near).withColumn("geodist", haversine(F.col(lat), F.col(lon), lat0, lon0)).filter(F.col("geodist") <= metres)


def nearest(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float, count: int, order: list, first: float = 50_000.0) -> DataFrame:
    """The ``count`` rows first in ``order`` (``geodist`` or a rounding of it, then ties), found in
    circles that double until one holds enough. Runs a count per circle, ten at most."""
    metres = first
    while metres < HALF_TURN_M and within(df, lat, lon, lat0, lon0, metres).limit(count).count() < count:
        metres *= 2
    # One metre more than the circle that holds enough, so that rounding changes no tie.
    return within(df, lat, lon, lat0, lon0, min(metres, HALF_TURN_M) + 1.0).orderBy(*order).limit(count)
