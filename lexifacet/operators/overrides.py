"""Per-query replacement of attribute values."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from numbers import Integral, Real

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.literal import small_table

# Attribute type name -> Spark type of its values.
SCALAR_TYPES = {
    "integer": "bigint",
    "timestamp": "timestamp",
    "ordinal": "bigint",
    "bool": "boolean",
    "float": "double",
    "bigint": "bigint",
    "string": "string",
}


def check_values(kind: str, values: Mapping) -> None:
    if kind not in SCALAR_TYPES:
        raise ValueError(f"unknown attribute type {kind!r}")
    if not isinstance(values, Mapping):
        raise TypeError("values must map ids to attribute values")
    for id, value in values.items():
        if isinstance(id, bool) or not isinstance(id, Integral):
            raise TypeError("ids must be integers")
        if kind == "timestamp":
            ok = isinstance(value, (Integral, datetime))
        elif kind == "float":
            ok = isinstance(value, Real)
        elif kind == "string":
            ok = isinstance(value, str)
        else:
            ok = isinstance(value, Integral)
        if not ok:
            raise TypeError(f"not a value of type {kind}: {value!r}")


def override_frame(spark: SparkSession, id: str, attr: str, kind: str, values: Mapping) -> DataFrame:
    """(id, attribute) rows of a literal override."""
    check_values(kind, values)
    if kind == "timestamp":
        rows = [(int(i), v.timestamp() if isinstance(v, datetime) else float(v)) for i, v in values.items()]
        df = small_table(spark, [(id, "bigint"), (attr, "double")], rows)
        return df.withColumn(attr, F.timestamp_seconds(attr))
    rows = [(int(i), bool(v) if kind == "bool" else float(v) if kind == "float" else v) for i, v in values.items()]
    return small_table(spark, [(id, "bigint"), (attr, SCALAR_TYPES[kind])], rows)
