"""Attribute updates: a new DataFrame, never a change in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from numbers import Integral

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.collection import Collection, one_per_id
from ..sources.literal import small_table
from ..sources.storage import ensure_checkpoint_dir


def update_frame(
    spark: SparkSession, id: str, attrs: Sequence[str], values: Mapping[int, Sequence], mva: bool = False
) -> DataFrame:
    """(id, attribute...) rows of a literal update."""
    if isinstance(attrs, str) or not all(isinstance(a, str) for a in attrs):
        raise TypeError("attrs must be a list of names")
    if not isinstance(mva, bool):
        raise TypeError("mva must be a boolean")
    if not isinstance(values, Mapping):
        raise TypeError("values must map ids to lists of values")
    for key, entry in values.items():
        if isinstance(key, bool) or not isinstance(key, Integral):
            raise TypeError("ids must be integers")
        if isinstance(entry, str) or not isinstance(entry, Sequence):
            raise TypeError("each entry must be a list of values")
        if len(entry) != len(attrs):
            raise ValueError(f"each entry must have {len(attrs)} values")
        for value in entry:
            members = value if mva else [value]
            if isinstance(members, str) or not isinstance(members, Sequence):
                raise TypeError("each value must be a list of integers")
            if any(isinstance(v, bool) or not isinstance(v, Integral) for v in members):
                raise TypeError("values must be integers")
    kind = "array<bigint>" if mva else "bigint"
    columns = [(id, "bigint"), *[(a, kind) for a in attrs]]
    rows = [(int(k), *[list(v) if mva else int(v) for v in entry]) for k, entry in values.items()]
    return small_table(spark, columns, rows)


def known_attributes(collection: Collection, updates: DataFrame, ignore_missing: bool) -> list[str]:
    attrs = [c for c in updates.columns if c != collection.id]
    unknown = [a for a in attrs if a not in collection.attrs]
    if unknown and not ignore_missing:
        raise ValueError(f"collection {collection.name}: no such attribute {unknown}")
    return [a for a in attrs if a in collection.attrs]


def update_attributes(collection: Collection, updates: DataFrame, ignore_missing: bool = False) -> Collection:
    """The collection with the given attributes replaced on the given ids.

    ``updates`` has the id column and one column per attribute. Ids that are not
    in the collection change nothing. Array values are stored sorted and distinct.
    The values stay apart from the texts and meet the documents on the id.
    """
    attrs = known_attributes(collection, updates, ignore_missing)
    if not attrs:
        return collection
    new = one_per_id(updates.select(collection.id, *attrs), collection.id)
    for a in attrs:
        if isinstance(updates.schema[a].dataType, T.ArrayType):
            new = new.withColumn(a, F.array_sort(F.array_distinct(a)))
    return replace(collection, overlays=(*collection.overlays, new))


def updated_count(collection: Collection, updates: DataFrame) -> DataFrame:
    """One row, ``n_updated``: how many documents an update touches."""
    ids = one_per_id(updates, collection.id).select(collection.id)
    touched = collection.df.select(collection.id).join(ids, collection.id, "left_semi")
    return touched.agg(F.count(F.lit(1)).alias("n_updated"))


def update_many(
    collections: Sequence[Collection], updates: DataFrame, ignore_missing: bool = False
) -> tuple[list[Collection], DataFrame]:
    """The same update on several collections, and the summed count."""
    changed = [update_attributes(c, updates, ignore_missing) for c in collections]
    counts = [updated_count(c, updates) for c in collections]
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return changed, every.agg(F.sum("n_updated").alias("n_updated"))


def string_ordinal(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """(value, ordinal): rank of each distinct value, 1-based.

    Distinct values are range partitioned, numbered inside their partition and
    shifted by the sizes of the partitions before, so no task sees them all. The
    numbered values are checkpointed first: both sides of the last step must see
    the same partition bounds, also after an executor is lost.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    placed = values.repartitionByRange(n, "value").sortWithinPartitions("value")
    placed = placed.select("value", F.monotonically_increasing_id().alias("_id")).checkpoint()
    # The id holds the partition number above 33 bits of the row's place in it.
    part = F.shiftright("_id", 33).cast("int")
    at = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition, at most n of them, become one array of running totals.
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    listed = sizes.agg(F.collect_list(F.struct("part", "n")).alias("sizes"))
    before = F.transform(
        F.sequence(F.lit(0), F.lit(n)),
        lambda p: F.aggregate(
            "sizes",
            F.lit(0).cast("long"),
            lambda total, s: total + F.when(s["part"] < p, s["n"]).otherwise(0),
        ),
    )
    shifts = listed.select(before.alias("before")).scalar()
    numbered = placed.withColumn("_before", shifts)
    return numbered.select("value", (at + 1 + F.get("_before", part)).alias("ordinal"))


def with_ordinal(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the ordinal of a text attribute."""
    ranks = string_ordinal(df, column).select(F.col("value").alias(column), F.col("ordinal").alias(name))
    return df.join(ranks, column, "left").select(*df.columns, name)
