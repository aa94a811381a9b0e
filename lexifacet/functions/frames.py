"""DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read without evaluating them again.

    A filter on a projected column is pushed below the projection together with
    the whole expression, which would tokenize every text twice. Values that come
    out of a one-row generator stay above it.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
