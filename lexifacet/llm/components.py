"""Connected components of a graph given as pairs of numbers, by alternating stars.

Every round works on the pairs as a distributed table and settles them; nothing of the
graph reaches the driver but two numbers per round.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not itself a root; the
    root is the smallest node reachable. Repeated edges and loops are allowed."""
    pairs = settled(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state.n == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select("v", "m").unionAll(low.select("u", "m"))
        pairs = settled(small.toDF("u", "v").distinct())


def compact_components(edges: DataFrame, per_task: int = 250_000) -> DataFrame:
    """As :func:`components`, with as many partitions as ``per_task`` pairs each need. A graph of
    one partition takes no exchange, so a round over few pairs writes no shuffle files."""
    pairs = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state.n == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        pairs = pairs.coalesce(math.ceil(state.n / per_task))
        both = pairs.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        pairs = settled(large.join(low, "u").select(hung).where("u <> v").distinct())
