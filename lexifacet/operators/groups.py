"""Grouping and facets.

One hash exchange on the group key, after map-side partial aggregation: a key
that holds a third of all rows reaches the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_UNITS, calendar_key
from .filters import is_multi
from .order import OrderKey, best_first, sort_columns

GROUP_FUNCTIONS = (*CALENDAR_UNITS, "attr", "attrpair")


def next_attribute(attrs: Sequence[str], attr: str) -> str:
    at = list(attrs).index(attr)
    if at + 1 >= len(attrs):
        raise ValueError(f"{attr} is the last attribute and has no pair")
    return attrs[at + 1]


def with_group_key(df: DataFrame, attr: str, func: str, attrs: Sequence[str] = ()) -> DataFrame:
    """Add ``group_key``; a multi-valued attribute puts a row into each of its values."""
    if func in CALENDAR_UNITS:
        return df.withColumn("group_key", calendar_key(F.col(attr), func))
    if func == "attrpair":
        return df.withColumn("group_key", F.struct(F.col(attr), F.col(next_attribute(attrs, attr))))
    if is_multi(df.schema, attr):
        return df.select("*", F.explode(attr).alias("group_key"))
    return df.withColumn("group_key", F.col(attr))


def best_per_group(
    df: DataFrame,
    match_order: Sequence[OrderKey],
    distinct: str | None = None,
    aggregates: Mapping[str, Column] | None = None,
    approximate: float | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``group_key``: its best row by ``match_order``, ``group_count``,
    ``group_distinct`` when asked for, and any extra aggregates by name. Of the best row
    only ``columns`` are carried through the aggregation; without them, all."""
    counts = {"group_count": F.count(F.lit(1))}
    if distinct is not None:
        counts["group_distinct"] = (
            F.count_distinct(F.col(distinct))
            if approximate is None
            else F.approx_count_distinct(distinct, approximate)
        )
    counts.update(aggregates or {})
    counted = [c.alias(name) for name, c in counts.items()]
    wanted = df.columns if columns is None else columns
    columns = [c for c in dict.fromkeys(wanted) if c != "group_key"]
    if not columns:
        return df.groupBy("group_key").agg(*counted).select("group_key", *counts)
    key = best_first(df.schema, match_order)
    if key is not None:
        best = F.min_by(F.struct(*columns), key).alias("_best")
        return df.groupBy("group_key").agg(best, *counted).select("_best.*", "group_key", *counts)
    # An order with descending text: the first row comes from a row number, which
    # Spark also limits to one row per key and task before the exchange.
    w = W.partitionBy("group_key").orderBy(*sort_columns(match_order))
    first = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    sums = df.groupBy(F.col("group_key").alias("_key")).agg(*counted)
    joined = first.join(sums, F.col("group_key").eqNullSafe(F.col("_key")))
    return joined.select(*columns, "group_key", *counts)
