"""Kept sketches of days against exact distinct counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lexifacet.functions.calendar import calendar_key
from lexifacet.operators.rollup import add_days, day_sketches, merge_days, open_days, rolled_up, standard_error


@pytest.fixture(scope="module")
def matches(spark):
    rng = random.Random(4)
    start = dt.datetime(2019, 12, 20)
    rows = [(start + dt.timedelta(days=rng.randrange(60), hours=rng.randrange(24)), rng.randrange(4000), rng.choice("xy")) for _ in range(20000)]
    rows += [(start, n, "x") for n in range(8000)] + [(None, 1, "x"), (None, 1, "y"), (start, None, "y")]
    return spark.createDataFrame(rows, "ts timestamp, user bigint, kind string").cache()


def close(rough, exact):
    assert rough.keys() == exact.keys()
    for key, (n, distinct) in exact.items():
        assert rough[key][0] == n
        assert abs(rough[key][1] - distinct) <= max(1, 5 * standard_error() * distinct)


@pytest.mark.parametrize("unit", ["day", "week", "month", "year", None])
def test_units(matches, unit):
    days = day_sketches(matches, "ts", "user")
    key = F.lit(None).cast("int") if unit is None else calendar_key(F.col("ts"), unit)
    exact = matches.groupBy(key.alias("k")).agg(F.count("*").alias("n"), F.countDistinct("user").alias("d")).collect()
    close({r.group_key: (r.group_count, r.group_distinct) for r in rolled_up(days, unit).collect()}, {r.k: (r.n, r.d) for r in exact})


def test_parts_merge(spark, matches, tmp_path):
    path = f"{tmp_path}/days"
    add_days(day_sketches(matches.where("user < 1500"), "ts", "user", ["kind"]), path)
    add_days(day_sketches(matches.where("user >= 1500 or user is null"), "ts", "user", ["kind"]), path)
    exact = matches.groupBy(calendar_key(F.col("ts"), "week").alias("k"), "kind").agg(F.count("*").alias("n"), F.countDistinct("user").alias("d")).collect()
    want = {(r.k, r.kind): (r.n, r.d) for r in exact}

    def now():
        return {(r.group_key, r.kind): (r.group_count, r.group_distinct) for r in rolled_up(open_days(spark, path), "week", ["kind"]).collect()}

    before = now()
    close(before, want)
    many = open_days(spark, path).count()
    merge_days(spark, path)
    assert now() == before and open_days(spark, path).count() < many


def test_units_are_known(matches):
    with pytest.raises(ValueError):
        rolled_up(day_sketches(matches, "ts", "user"), "hour")
