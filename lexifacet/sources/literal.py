"""Small tables from Python values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Spark type name -> Arrow type.
ARROW_TYPES = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<string>": pa.list_(pa.string()),
    "array<bigint>": pa.list_(pa.int64()),
}


def small_table(spark: SparkSession, columns: Sequence[tuple[str, str]], rows: Iterable[Sequence]) -> DataFrame:
    """A table of given rows, ``columns`` being (name, type).

    It goes through Arrow so that Spark knows its exact size: a join with it is a
    broadcast when that size is below the threshold, which Spark cannot tell for
    rows from a parallelized list.
    """
    rows = list(rows)
    arrays = [pa.array([r[i] for r in rows], ARROW_TYPES[kind]) for i, (_, kind) in enumerate(columns)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in columns]))
