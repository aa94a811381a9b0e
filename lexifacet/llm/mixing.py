"""Mixing sources to target weights by a splitting tree of block quotas.

Sizes are words. A source may hold ``MOST_REPEATS`` times its size at most; what that
leaves over is shared anew by weight. Each source's documents stand in the order of the
md5 of their id; going round this order until the target is reached gives the source's
words, cut into blocks of ``block_words``. The number of blocks per source is its quota.
A tree over the output shards splits all quotas in two, again and again: each node draws
how many blocks of every source go left from the multivariate hypergeometric distribution,
so quotas are met exactly. The blocks of a source, in the random order of a seeded hash, are then dealt
to the shards, the first of them to the first shard and so on, which makes the draws disjoint; each shard
shuffles its own blocks. What is taken of a document is the sum of its stretches in the shards.

On the driver: one row per source, and sources x shards quotas. Documents are numbered
within ranges of the md5, whose word totals fix where each range begins, and blocks within ranges of
their hash, so a large source is spread over many tasks.

Nulls: a null text has size 0; a null source is a source of its own, after all others;
a null id is ordered as the text 'null'. Documents of size 0 get no draws. Repeated ids
and rows are documents of their own, ordered by their text's hash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 8192
SHARDS = 64
SEED = 7
DRAWS = "array<struct<block:bigint,from_word:bigint,to_word:bigint,copy:int>>"
#: Blocks that one row of a source stands for before they are dealt.
CHUNK_BLOCKS = 1 << 16


class Mix(NamedTuple):
    """``docs``, one row per document: doc_id, text_hash, key (its source), at (words before it in
    its source), size, source_size, target, and ``draws``, the stretches of its words in the blocks
    of its source. ``blocks``: (key, block, shard), one row per block."""

    docs: DataFrame
    blocks: DataFrame


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """The words to take of each source: total shared by weight, none above its limit."""
    limits = [float(most * s) for s in sizes]
    capped = [False] * len(sizes)
    while True:
        rest = sum(sizes) - sum(x for x, c in zip(limits, capped) if c)
        weight = sum(w for w, c in zip(weights, capped) if not c)
        share = rest / weight if weight else 0.0
        above = [not c and w * share > x for x, w, c in zip(limits, weights, capped)]
        if not any(above):
            return [x if c else w * share for x, w, c in zip(limits, weights, capped)]
        capped = [a or b for a, b in zip(capped, above)]


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources) block counts whose columns sum to ``quotas``."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def descend(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = counts
            return
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = int(counts.sum()) * (middle - low) // (high - low)
        drawn = rng.multivariate_hypergeometric(counts, left, method="marginals")
        descend(drawn, low, middle)
        descend(counts - drawn, middle, high)

    descend(np.array(quotas, dtype=np.int64), 0, shards)
    return out


def deal_blocks(facts: DataFrame, seed: int = SEED) -> DataFrame:
    """(key, block, shard) of facts (key, quota, ends): the blocks of each source in the order of their
    hash, as many to each shard as the tree says."""
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("quota") - 1, F.lit(CHUNK_BLOCKS).cast("bigint")))
    chunks = facts.where("quota > 0").select("key", "quota", first.alias("first")).repartition("key", "first")
    last = F.least(F.col("first") + CHUNK_BLOCKS, F.col("quota")) - 1
    blocks = chunks.select("key", F.explode(F.sequence("first", last)).alias("block"))
    blocks = blocks.withColumn("turn", F.xxhash64(F.lit(seed), "key", "block")).withColumn("range", F.shiftright("turn", 52))
    ranges = blocks.groupBy("key", "range").agg(F.count(F.lit(1)).alias("n"))
    starts = ranges.select("key", "range", (F.sum("n").over(Window.partitionBy("key").orderBy("range")) - F.col("n")).alias("start"))
    order = Window.partitionBy("key", "range").orderBy("turn", "block")
    placed = blocks.withColumn("place", F.row_number().over(order) - 1).join(starts, ["key", "range"])
    place = F.col("start") + F.col("place")
    # One row per source.
    placed = placed.join(F.broadcast(facts.select("key", "ends")), "key")
    return placed.select("key", "block", F.size(F.filter("ends", lambda e: e <= place)).alias("shard"))


def mix_plan(
    docs: DataFrame,
    weights=WEIGHTS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    most: int = MOST_REPEATS,
    seed: int = SEED,
) -> Mix:
    """What the mix takes of each document, and the shard of each block."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    rows = settled(
        docs.select(
            "doc_id",
            F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("key"),
            F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))).cast("bigint").alias("size"),
            place.alias("place"),
            F.xxhash64(text).alias("text_hash"),
        ).withColumn("range", F.substring("place", 1, 3))
    )
    ranges = rows.groupBy("key", "range").agg(F.sum("size").alias("words"))
    starts = ranges.select("key", "range", (F.sum("words").over(Window.partitionBy("key").orderBy("range")) - F.col("words")).alias("start"))
    sources = sorted(((r.key, r.size) for r in rows.groupBy("key").agg(F.sum("size").alias("size")).collect()), key=lambda r: (r[0][0] == "n", r[0]))
    sizes = [s for _, s in sources]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    takes = [math.floor(a) for a in aims]
    quotas = [-(-t // block_words) for t in takes]
    ends = np.cumsum(split_quotas(quotas, shards, seed), axis=0)
    facts = [
        (key, size, aim, take, quota, [int(x) for x in ends[:, i]])
        for i, ((key, size), aim, take, quota) in enumerate(zip(sources, aims, takes, quotas))
    ]
    facts = spark.createDataFrame(facts, "key string, source_size bigint, target double, take bigint, quota bigint, ends array<bigint>")
    order = Window.partitionBy("key", "range").orderBy("place", "doc_id", "text_hash")
    placed = (
        rows.withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(starts, ["key", "range"])
        # One row per source.
        .join(F.broadcast(facts.drop("quota", "ends")), "key")
        .withColumn("at", F.col("start") + F.col("before"))
    )

    def one_pass(copy: int):
        first = copy * F.col("source_size") + F.col("at")
        last = F.least(first + F.col("size"), F.col("take"))
        blocks = F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words))

        def draw(block):
            return F.struct(
                block.alias("block"),
                (F.greatest(first, block * block_words) - first).alias("from_word"),
                (F.least(last, (block + 1) * block_words) - first).alias("to_word"),
                F.lit(copy).alias("copy"),
            )

        return F.when(last > first, F.transform(blocks, draw).cast(DRAWS)).otherwise(F.array().cast(DRAWS))

    draws = F.flatten(F.array(*[one_pass(c) for c in range(most)]))
    docs = placed.select("doc_id", "text_hash", "key", "at", "size", "source_size", "target", draws.alias("draws"))
    return Mix(docs, deal_blocks(facts, seed))


def shard_rows(mix: Mix, seed: int = SEED) -> DataFrame:
    """(shard, key, at, doc_id, text_hash, block, from_word, to_word, copy): the mix itself, one
    partition per hash of shard, each shard's blocks in random order."""
    rows = mix.docs.select("key", "at", "doc_id", "text_hash", F.inline("draws")).join(mix.blocks, ["key", "block"])
    turn = F.xxhash64(F.lit(seed), "shard", "key", "block")
    return (
        rows.select("shard", "key", "at", "doc_id", "text_hash", "block", "from_word", "to_word", "copy", turn.alias("turn"))
        .repartition("shard")
        .sortWithinPartitions("shard", "turn", "copy", "at", "from_word")
    )


def taken(mix: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken, draws) of every document: the words that all shards
    together take of it, repeats counted, and its stretches in the shards (none: null)."""
    stretch = F.struct("shard", "block", "copy", "from_word", "to_word")
    drawn = shard_rows(mix).groupBy("key", "at").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"),
        F.sort_array(F.collect_list(stretch)).alias("draws"),
    )
    # Only documents with words have a place of their own.
    docs = mix.docs.drop("draws").alias("d")
    same = (F.col("d.key") == F.col("t.key")) & (F.col("d.at") == F.col("t.at")) & (F.col("d.size") > 0)
    joined = docs.join(drawn.alias("t"), same, "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "draws")


TAKEN_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':7') AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 3.0::DOUBLE * n AS most, row_number() OVER (ORDER BY 3.0::DOUBLE * n / w, source NULLS LAST) AS k,
    sum(n) OVER () AS total
  FROM s),
l AS (
  SELECT *, (total - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM r),
f AS (SELECT share FROM l WHERE w * share <= most ORDER BY k LIMIT 1),
t AS (SELECT source, n, CASE WHEN w * f.share > most THEN most ELSE w * f.share END AS target FROM r, f),
p AS (
  SELECT d.doc_id, d.size, t.n, t.target, floor(t.target) AS take,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place ROWS UNBOUNDED PRECEDING) - d.size AS begin_at
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target,
  CAST(greatest(0, least(begin_at + size, take) - begin_at) + greatest(0, least(n + begin_at + size, take) - n - begin_at)
    + greatest(0, least(2 * n + begin_at + size, take) - 2 * n - begin_at) AS BIGINT) AS taken
FROM p
"""
