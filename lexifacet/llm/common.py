"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, as a character class and as its characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, its lineage cut.

    The folder is ``spark.checkpoint.dir``; where that is unset, one beside the
    warehouse, which executors share as well.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints-{uuid.uuid4().hex}")
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """The parts of a text between ASCII white space; none for a null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARACTERS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def tokens_of(text: str | None) -> list[bytes]:
    """The same parts as UTF-8 bytes, A-Z in lower case (bytes know ASCII only)."""
    return text.encode("utf-8").lower().split() if text else []


def literal_array(values: list, kind: str = "bigint") -> Column:
    """An array constant; ``values`` must be few enough for a plan."""
    inner = ",".join("NULL" if v is None else repr(v) for v in values)
    return F.expr(f"CAST(array({inner}) AS array<{kind}>)")


def fold(id_column: str) -> Column:
    """crc32 of an id as text modulo 5, null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5
