"""Which parts of a growing table count.

A writer puts its files into a part of a new name and then appends one row here, so files of a job that
failed or is still running count nothing. A row may name parts that its own replaces. There is one
row per commit since the table began; readers look at them on the driver. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from .literal import small_table

COLUMNS = [("number", "bigint"), ("part", "string"), ("kind", "string"), ("buckets", "array<bigint>"), ("replaces", "array<string>")]
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS)


@dataclass(frozen=True)
class Part:
    """One commit. ``buckets``: those it wrote, where that matters."""

    number: int
    part: str
    kind: str
    buckets: frozenset[int]
    replaces: frozenset[str]


def new_part() -> str:
    return f"p{uuid.uuid4().hex}"


def commits(spark: SparkSession, path: str) -> list[Part]:
    """All commits in order; none where nothing has been written yet."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(f"{path}/manifest").collect()
    except AnalysisException:
        return []
    found = [Part(r.number, r.part, r.kind, frozenset(r.buckets), frozenset(r.replaces)) for r in rows]
    return sorted(found, key=lambda p: p.number)


def live(spark: SparkSession, path: str) -> list[Part]:
    """The commits that no later one has replaced."""
    every = commits(spark, path)
    gone = {name for p in every for name in p.replaces}
    return [p for p in every if p.part not in gone]


def commit(spark: SparkSession, path: str, part: str, kind: str, buckets: Sequence[int] = (), replaces: Sequence[str] = ()) -> None:
    """Make a written part count."""
    every = commits(spark, path)
    number = every[-1].number + 1 if every else 1
    row = (number, part, kind, sorted(buckets), sorted(replaces))
    small_table(spark, COLUMNS, [row]).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
