"""Documents that come as text files or as XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, text): one row per file, the whole file as its text."""
    given = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.text(given, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_files(rows: DataFrame, id: str, text: str, path: str) -> None:
    """One file per row in one folder: the id, a line feed, the whole text, a line feed. No folder is made for a
    file, and tasks put their own files in place, so the driver moves none."""
    whole = F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    files = rows.select(whole).write.mode("errorifexists").option("maxRecordsPerFile", 1)
    files.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)


def split_file(text: str) -> tuple[Column, Column]:
    """The id, as text, and the text of a file that :func:`write_files` wrote."""
    id = F.substring_index(text, "\n", 1)
    return id, F.substr(text, F.length(id) + 2, F.length(text) - F.length(id) - 2)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """One row per ``row_tag`` element. The schema is declared, so no inference pass."""
    return spark.read.schema(schema).option("rowTag", row_tag).xml(path)

