"""Where jobs may write: the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, a folder beside
    the warehouse, which executors share as well."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(f"{warehouse}/run-{uuid.uuid4().hex}")
    return context.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def persist_attributes(df: DataFrame, path: str) -> DataFrame:
    """Write a new snapshot of updated rows and read it back. An existing path is
    an error: the input is never overwritten."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
