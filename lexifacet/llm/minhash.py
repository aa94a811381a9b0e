"""MinHash near-duplicates from two permutations, one of them shifted in a circle.

A document is the set of its two-word shingles. Each shingle's XXH64 is folded to a place on a
circle of 2^32 places by a first permutation. A second permutation, shifted by 0, 1, 2, ... places,
gives every coordinate of the signature: coordinate ``k`` is the least value of
``second(place - k)``. Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates; sets that
share a band meet. Two sets at likeness 0.8 miss each other in all bands with
a chance of about 5e-9, more alike ones with less.

What meets is settled without writing out the pairs of a group:

1. Star: every set is held against one head, the set with most company among those it meets.
2. Nearest: sets that meet but are in no common component yet are compared by parity sketches of
   1,024 bits, in blocks of at most ``BLOCK`` sets a side. A sketch bit is the parity of the shingles
   that fall on it, so two sets differ in at least as many shingles as their sketches differ in bits; a pair
   beyond the bound for 0.8 cannot be a link. Each set keeps its nearest such partner.
3. Rest: as before, with every partner within the bound.

After each step the pairs found are confirmed on the full sets, and components are joined.
Only the pairs of different components are looked at, so a group of a thousand near copies costs about a
comparison per copy; no link between two components is left out.

Nulls and texts without words have no shingles and are linked with nothing; a text of one word has
one shingle, the word. Copies of a set, however many, are one entry. Repeated rows and ids are
rows of their own, linked by their texts; a component's id is the smallest doc_id of its rows, null only
if they have none (such a row is kept). Very long texts are hashed whole. Other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType

from .common import settled, tokens_of
from .components import compact_components as components

SHINGLE = 2
SEED = 42
ROWS = 5
BANDS = 48
#: Percent of the union that two linked sets share.
LIKENESS = 80
#: 64-bit words of a parity sketch.
SKETCH = 16
#: Sets that are compared with as many others at a time.
BLOCK = 1024
#: Shingles whose coordinates are made at a time; a longer text is taken alone.
AT_A_TIME = 1 << 16

# The multipliers of the two permutations.
FIRST = (0x7FEB352D, 0x846CA68B)
SECOND = (0x85EBCA6B, 0xC2B2AE35)


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    tokens = tokens_of(text)
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *accumulate(len(t) + 1 for t in tokens)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[SHINGLE:])]
    return np.unique(np.array(hashes, dtype=np.uint64))


def permuted(x: np.ndarray, multipliers: tuple[int, int]) -> np.ndarray:
    """A permutation of the 32-bit numbers: every step can be undone. Works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(multipliers[0])
    x ^= x >> np.uint32(13)
    x *= np.uint32(multipliers[1])
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """(sets, size): the least value of every shift; no set may be empty."""
    hashes = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    places = permuted((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32), FIRST)
    out = np.empty((len(sets), size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(permuted(places - np.uint32(k), SECOND), starts)
    return out


def bands_of(signature: np.ndarray) -> list[int]:
    """One number per band; the number of the band is hashed along."""
    digest = xxhash.xxh64_intdigest
    raw = [signature[i * ROWS : (i + 1) * ROWS].tobytes() for i in range(BANDS)]
    return np.array([digest(r, i) for i, r in enumerate(raw)], dtype=np.uint64).view(np.int64).tolist()


def sketch_of(hashes: np.ndarray) -> bytes:
    """Bit b: whether an odd number of shingles falls on b."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        bands: list[list[int]] = [[] for _ in sets]
        part: list[int] = []
        size = 0
        full = [i for i, s in enumerate(sets) if len(s)]
        for i in full:
            part.append(i)
            size += len(sets[i])
            if size >= AT_A_TIME or i == full[-1]:
                for j, signature in zip(part, signatures([sets[j] for j in part], ROWS * BANDS)):
                    bands[j] = bands_of(signature)
                part, size = [], 0
        shape = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(shape),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sketch_of(s) for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_hash", "shape", "n", "sketch", "bands"],
        )


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, shape, n, sketch, bands): ``shape`` stands for the set, ``n`` is its size."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(_described, "doc_id bigint, text_hash bigint, shape bigint, n bigint, sketch binary, bands array<bigint>")


@pandas_udf(ArrayType(LongType()))
def shingles_of(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t).view(np.int64) for t in texts], dtype="object")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= LIKENESS * F.greatest(a, b)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are alike enough."""
    a, b = (sets.select(F.col("shape").alias(x), F.col("hashes").alias(f"{x}_hashes")) for x in "ab")
    shared = F.size(F.array_intersect("a_hashes", "b_hashes")).cast("bigint")
    alike = 100 * shared >= LIKENESS * (F.size("a_hashes") + F.size("b_hashes") - shared)
    return pairs.join(a, "a").join(b, "b").where(alike).select("a", "b")


def star(index: DataFrame) -> DataFrame:
    """(a, b): every set that is no head, with the head of most company that it meets."""
    company = index.groupBy("shape").agg(F.sum("met").alias("company"))
    placed = index.join(company, "shape")
    heads = placed.groupBy("band").agg(F.max(F.struct("company", "shape", "n")).alias("head"))
    own = F.struct("company", "shape", "n")
    meets = placed.join(heads, "band").where((F.col("head") > own) & _sizes_fit(F.col("n"), F.col("head.n")))
    return meets.groupBy("shape").agg(F.max("head").alias("head")).select(F.col("shape").alias("a"), F.col("head.shape").alias("b"))


def _compared(shape, n, root, words, left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of left, of right, differing bits) of the pairs that may be links between components."""
    apart = np.zeros((len(left), len(right)), dtype=np.int64)
    for w in range(SKETCH):
        apart += np.bitwise_count(words[left, w][:, None] ^ words[right, w][None, :])
    a, b = n[left][:, None], n[right][None, :]
    # Sets that differ in d shingles share (a + b - d) / 2 of (a + b + d) / 2.
    fits = 100 * (a + b - apart) >= LIKENESS * (a + b + apart)
    fits &= 100 * np.minimum(a, b) >= LIKENESS * np.maximum(a, b)
    fits &= root[left][:, None] != root[right][None, :]
    i, j = np.nonzero(fits)
    return i, j, apart[i, j]


def _block_pairs(nearest: bool):
    """A task's sorted members, taken by runs of one band and pair of blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        names = ["a", "b", "apart"]

        def found(run: pa.Table) -> pa.RecordBatch:
            shape, n, root, block = (run.column(c).to_numpy() for c in ("shape", "n", "root", "block"))
            words = np.frombuffer(b"".join(run.column("sketch").to_pylist()), dtype="<u8").reshape(-1, SKETCH)
            low, high = run.column("low")[0].as_py(), run.column("high")[0].as_py()
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            i, j, apart = _compared(shape, n, root, words, left, right)
            a, b = shape[left[i]], shape[right[j]]
            if nearest:
                a, b, apart = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([apart, apart])
                order = np.lexsort((b, apart, a))
                first = order[np.flatnonzero(np.diff(a[order], prepend=a[order[:1]] - 1))]
                a, b, apart = a[first], b[first], apart[first]
            elif low == high:
                a, b, apart = a[a < b], b[a < b], apart[a < b]
            return pa.record_batch([pa.array(a), pa.array(b), pa.array(apart)], names=names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not len(table):
                continue
            keys = np.stack([table.column(c).to_numpy() for c in ("band", "low", "high")])
            edges = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist()]
            for start, end in zip(edges, edges[1:]):
                yield found(table.slice(start, end - start))
            rest = table.slice(edges[-1])
        if rest is not None and len(rest):
            yield found(rest)

    return compare


def between_components(index: DataFrame, sketches: DataFrame, roots: DataFrame, nearest: bool) -> DataFrame:
    """(a, b): sets of different components that meet and may be linked. With ``nearest``, each
    set's nearest only."""
    rooted = index.join(roots.select(F.col("node").alias("shape"), "root"), "shape", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "shape"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("band")
    members = rooted.join(mixed, "band").join(sketches, "shape")
    blocks = F.ceil(F.col("met") / BLOCK)
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("shape"), F.col("blocks")))
    others = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    dealt = placed.select("band", "shape", "n", "root", "sketch", "block", F.explode(others).alias("other"))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = dealt.select("band", low, high, "shape", "n", "root", "sketch", "block")
    runs = dealt.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    pairs = runs.mapInArrow(_block_pairs(nearest), "a bigint, b bigint, apart bigint")
    if nearest:
        best = pairs.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        pairs = best
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root): the component of every shape that is not a root itself."""
    full = rows.where("n > 0")
    shapes = full.groupBy("shape").agg(F.min(F.struct("n", "bands")).alias("s"))
    entries = shapes.select("shape", "s.n", F.explode("s.bands").alias("band"))
    met = entries.groupBy("band").agg(F.count("*").alias("met")).where("met > 1")
    index = settled(entries.join(met, "band").select("band", "shape", "n", "met"))
    partners = full.join(index.select("shape").distinct(), "shape", "left_semi")
    sketches = settled(partners.groupBy("shape").agg(F.min(F.struct("text_hash", "sketch")).alias("s")).select("shape", "s.*"))
    wanted = docs.select("text", _text_hash().alias("text_hash")).join(sketches.select("shape", "text_hash"), "text_hash")
    sets = settled(wanted.dropDuplicates(["shape"]).select("shape", shingles_of("text").alias("hashes")))
    sketches = sketches.select("shape", "sketch")
    links = settled(confirmed(star(index), sets))
    for nearest in (True, False):
        more = confirmed(between_components(index, sketches, components(links), nearest), sets)
        links = settled(links.unionAll(more))
    return components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, first_hash, kept), one row per document. The
    component's first document has the smallest id and, among rows of that id, ``first_hash``."""
    rows = settled(described(docs))
    roots = linked(docs, rows)
    # A null id is larger than all others here.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    shapes = rows.where("n > 0").groupBy("shape").agg(first.alias("first"))
    rooted = shapes.join(roots, shapes["shape"] == roots["node"], "left").select("shape", "first", F.coalesce("root", "shape").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    labels = rooted.join(best, "root").select("shape", "best")
    found = rows.join(labels, "shape", "left")
    alone = F.col("n") == 0
    return found.select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        F.when(alone, F.col("text_hash")).otherwise(F.col("best.text_hash")).alias("first_hash"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT row, doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS set
  FROM d),
u AS MATERIALIZED (SELECT list_sort(set) AS set, min(row) AS node, len(set) AS n FROM s WHERE len(set) > 0 GROUP BY ALL),
x AS MATERIALIZED (SELECT node, n, unnest(set) AS g FROM u),
p AS (
  SELECT a.node AS a, b.node AS b, count(*) AS shared, any_value(a.n) AS m, any_value(b.n) AS n
  FROM x a JOIN x b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT node, node AS other FROM u UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
l AS (SELECT s.row, s.doc_id, len(s.set) AS n, u.node FROM s LEFT JOIN u ON u.set = list_sort(s.set)),
i AS (SELECT node, min(doc_id) AS least FROM l GROUP BY node),
c AS (SELECT r.node, min(i.least) AS component_id FROM r JOIN i ON i.node = r.other GROUP BY r.node)
SELECT l.doc_id, l.n::BIGINT AS n_shingles, CASE WHEN l.n = 0 THEN l.doc_id ELSE c.component_id END AS component_id,
  l.doc_id IS NOT DISTINCT FROM CASE WHEN l.n = 0 THEN l.doc_id ELSE c.component_id END AS kept
FROM l LEFT JOIN c ON c.node = l.node
"""
