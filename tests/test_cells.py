"""Cells against distances to every place, poles and the date line included."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lexifacet.functions.geo import EARTH_RADIUS_M, haversine
from lexifacet.sources import cells

ANCHORS = [(0.0, 0.0), (50.2, 8.1), (89.5, 10.0), (-90.0, 0.0), (12.0, 179.9), (-33.0, -180.0), (70.0, 540.5)]


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = [(i, math.asin(rng.uniform(-1, 1)), math.radians(rng.uniform(-180, 180))) for i in range(3000)]
    rows += [(3000, math.pi / 2, 0.0), (3001, -math.pi / 2, 1.0), (3002, 0.0, math.pi), (3003, 0.0, -math.pi), (3004, None, 0.0), (3005, 0.1, None), (3006, math.nan, 0.0)]
    df = spark.createDataFrame(rows, "id long, lat double, lon double")
    return cells.write_cells(df, str(tmp_path_factory.mktemp("cells") / "places"), "lat", "lon").cache()


@pytest.mark.parametrize("lat, lon", ANCHORS)
def test_circles_and_nearest(places, lat, lon):
    at = math.radians(lat), math.radians(lon)
    every = places.where("id < 3004").select("id", haversine(F.col("lat"), F.col("lon"), *at).alias("d")).collect()
    for metres in (0.0, 300_000.0, 2_500_000.0, math.pi * EARTH_RADIUS_M):
        got = {r.id for r in cells.within(places, "lat", "lon", *at, metres).collect()}
        assert got == {r.id for r in every if r.d <= metres}
    got = [r.id for r in cells.nearest(places, "lat", "lon", *at, 7, ["geodist", "id"]).collect()]
    assert got == [r.id for r in sorted(every, key=lambda r: (r.d, r.id))[:7]]


def test_ranges_reach_the_scan(spark, places, tmp_path):
    table = cells.write_cells(places.drop("cell"), str(tmp_path / "t"), "lat", "lon")
    plan = cells.within(table, "lat", "lon", 0.9, 0.1, 100_000.0)._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(cell" in pushed and "LessThanOrEqual(cell" in pushed
