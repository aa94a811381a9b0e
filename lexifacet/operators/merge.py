"""Search over several collections at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_collections(parts: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """All matches with the number and name of the collection they come from."""
    out = None
    for ordinal, (df, name) in enumerate(zip(parts, names)):
        tagged = df.withColumns({"ordinal": F.lit(ordinal), "collection": F.lit(name)})
        out = tagged if out is None else out.unionByName(tagged)
    return out


def merge_collections(
    parts: Sequence[DataFrame], id: str, names: Sequence[str], weights: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per id. The last collection that matched gives the attributes and,
    without ``weights``, the weight; with them, weight = sum of weight x collection weight.

    An id occurs at most once per collection, so groups are as small as the list.
    """
    every = union_collections(parts, names)
    columns = [c for c in parts[0].columns if c not in (id, "weight")]
    factor = F.lit(1).cast("long")
    for name, weight in (weights or {}).items():
        factor = F.when(F.col("collection") == name, F.lit(int(weight)).cast("long")).otherwise(factor)
    # One aggregate per column: those that nobody reads are pruned, down to the scan.
    last = [F.max_by(c, "ordinal").alias(c) for c in columns]
    weight = F.max_by("weight", "ordinal")
    if weights:
        weight = F.sum(F.col("weight") * factor)
    return every.groupBy(id).agg(weight.alias("weight"), *last)
