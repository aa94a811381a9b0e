"""Distinct counts that roll up: one sketch per day, kept, and merged to weeks, months and years.

Exact distinct counts of two days do not add up to that of both; sketches do. Matches are counted once per day; any
calendar unit, and any number of days that arrive later, is then a merge of small rows. The sketches are
HyperLogLog sketches of Spark's own functions: aggregation combines before the exchange, also where one day holds
a third of all rows.

``days``  part | day, keys, matches, sketch     more parts may hold the same day

NULL values of the counted attribute are not counted, as in an exact distinct count. NULL timestamps are a group of
their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_UNITS, calendar_key
from ..sources import manifest

#: Sketches have 2 to this power of buckets: relative standard error of about 0.008.
LOG_BUCKETS = 14


def standard_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative standard error of the count of a merged sketch."""
    return 1.04 / math.sqrt(2**log_buckets)


def day_sketches(found: DataFrame, ts: str, counted: str, keys: Sequence[str] = (), log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """(day, keys, matches, sketch) of matches: how many there were, and a sketch of the values of ``counted``."""
    value = F.col(counted).cast("string")
    day = F.to_date(ts).alias("day")
    return found.groupBy(day, *keys).agg(F.count(F.lit(1)).alias("matches"), F.hll_sketch_agg(value, log_buckets).alias("sketch"))


def add_days(days: DataFrame, path: str) -> None:
    """Write sketches as a part of a table that begins with the first of them."""
    part = manifest.new_part()
    days.write.parquet(f"{path}/days/part={part}")
    manifest.commit(days.sparkSession, path, part, "days")


def open_days(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all parts that count at this moment."""
    parts = [p.part for p in manifest.live(spark, path)]
    return spark.read.parquet(f"{path}/days").where(F.col("part").isin(parts)).drop("part")


def merge_days(spark: SparkSession, path: str) -> None:
    """One part in place of all, with one row per day and keys."""
    every = open_days(spark, path)
    keys = [c for c in every.columns if c not in ("matches", "sketch")]
    old = [p.part for p in manifest.live(spark, path)]
    part = manifest.new_part()
    every.groupBy(*keys).agg(*_merged()).write.parquet(f"{path}/days/part={part}")
    manifest.commit(spark, path, part, "merged", replaces=old)


def _merged() -> list[Column]:
    return [F.sum("matches").alias("matches"), F.hll_union_agg("sketch").alias("sketch")]


def rolled_up(days: DataFrame, unit: str | None, keys: Sequence[str] = ()) -> DataFrame:
    """(group_key, keys, group_count, group_distinct) per calendar unit; without a unit, over all days."""
    if unit is not None and unit not in CALENDAR_UNITS:
        raise ValueError(f"unit must be one of {', '.join(CALENDAR_UNITS)}")
    key = F.lit(None).cast("int") if unit is None else calendar_key(F.col("day").cast("timestamp"), unit)
    merged = days.groupBy(key.alias("group_key"), *keys).agg(*_merged())
    distinct = F.hll_sketch_estimate("sketch").alias("group_distinct")
    return merged.select("group_key", *keys, F.col("matches").alias("group_count"), distinct)
