"""Centroid clustering of embeddings by bit planes and popcounts.

Components become whole numbers, ``floor(SCALE * x)``. Bit ``a`` of a vector's 64 components,
packed into one 64-bit word, is its bit plane ``a``; in two's complement the highest plane counts
negative. With planes X of a vector and C of a centroid, their dot product is exactly
``sum of w_a * w_b * popcount(X_a & C_b)``, and ``x.x - 2 x.c + c.c`` their squared distance.

The packed vectors are written once, eight bytes a plane (a vector of unit length has twelve or
fewer), and every round reads only them. A round is one pass: each task assigns its vectors and
adds up, per centroid, a count, a distance and 64 sums, taken from the planes as well. One row per task
and centroid is exchanged, one row per centroid comes to the driver. Sums are exact, so the result does
not depend on how the table is split.

Vectors are left out unless they have exactly ``WIDTH`` components, none null or not finite.
Rows are vectors of their own, also where ids repeat or are null (the hash of a null id is that of
``3:null``); ties among first centroids go to the vector of smaller components, ties of distance to the smaller
centroid. With fewer vectors than centroids each vector is one; an empty table gives an empty result. Components
up to about ``2**28`` give distances that fit the long that carries them; larger ones, cut at ``2**40``,
wrap around. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled

# Fixed values of the contract.
WIDTH = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3

#: Vectors whose planes are counted at a time, which bounds a task's memory.
AT_A_TIME = 1 << 13
LARGEST = 1 << 40
PACKED = "vec_id bigint, planes binary"


def quantized(rows: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * rows.astype(np.float64)), -LARGEST, LARGEST - 1).astype(np.int64)


def planes_of(q: np.ndarray) -> np.ndarray:
    """(rows, planes) of 64-bit words: as many planes as the largest component needs, and one for the sign."""
    most = int(max(q.max(initial=0), -1 - q.min(initial=0)))
    bits = most.bit_length() + 1
    out = np.empty((len(q), bits), dtype=np.uint64)
    for a in range(bits):
        out[:, a] = np.packbits((q >> a & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def plane_weights(bits: int) -> np.ndarray:
    """What a bit of each plane counts."""
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(rows, centroids) dot products of two sets of planes."""
    out = np.zeros((len(x), len(c)), dtype=np.int64)
    wx, wc = plane_weights(x.shape[1]), plane_weights(c.shape[1])
    for a in range(x.shape[1]):
        for b in range(c.shape[1]):
            met = np.bitwise_count(x[:, a, None] & c[None, :, b])
            out += met * (wx[a] * wc[b])
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Dot products of rows with themselves."""
    out = np.zeros(len(x), dtype=np.int64)
    w = plane_weights(x.shape[1])
    for a in range(x.shape[1]):
        out += np.bitwise_count(x[:, a]) * (w[a] * w[a])
        for b in range(a):
            out += np.bitwise_count(x[:, a] & x[:, b]) * (2 * w[a] * w[b])
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) of each row of planes; ``centroids`` are whole numbers."""
    c = planes_of(centroids)
    distance = norms(x)[:, None] - 2 * dots(x, c) + norms(c)[None, :]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(x)), cluster]


def component_sums(x: np.ndarray) -> np.ndarray:
    """The 64 sums of the rows' components, from how often each bit of each plane is set."""
    bits = np.unpackbits(x.view(np.uint8).reshape(len(x), x.shape[1], 8), axis=2, bitorder="little")
    return plane_weights(x.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def suitable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("v")).where(F.size("v") == WIDTH)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)))


def pack(vectors: DataFrame) -> DataFrame:
    """(vec_id, planes): the suitable vectors, packed."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            x = planes_of(quantized(values))
            raw = [row.tobytes() for row in x]
            yield pa.record_batch([batch.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "planes"])

    return suitable(vectors).mapInArrow(packed, PACKED)


def _unpacked(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, planes) of stretches of rows with one number of planes, at most ``AT_A_TIME`` long."""
    lengths = np.diff(np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset : column.offset + len(column) + 1])
    edges = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(lengths)]
    for start, end in zip(edges, edges[1:]):
        for at in range(start, end, AT_A_TIME):
            part = b"".join(column.slice(at, min(AT_A_TIME, end - at)).to_pylist())
            yield at, np.frombuffer(part, dtype="<u8").reshape(-1, int(lengths[start]) // 8)


def first_centroids(vectors: DataFrame, k: int, seed: int = SEED) -> list[list[int]]:
    """The ``k`` suitable vectors whose seeded id has the smallest SHA-256, in that order, then
    in that of their components; no more than ``k`` rows leave any task."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(SCALE * x), F.lit(LARGEST - 1)), F.lit(-LARGEST)))
    rows = suitable(vectors).select(F.sha2(name, 256).alias("h"), whole.alias("q")).orderBy("h", "q").limit(k)
    return [list(r.q) for r in rows.collect()]


def assigned_sums(packed: DataFrame, centroids: Sequence[Sequence[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Per non-empty cluster: vectors, summed distance, summed components. One row per
    cluster comes to the driver."""
    c = np.array(centroids, dtype=np.int64)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inertia = [0] * len(c), [0] * len(c)
        sums = [[0] * WIDTH for _ in range(len(c))]
        for batch in batches:
            for _, x in _unpacked(batch.column(0)):
                cluster, distance = nearest(x, c)
                for k in np.unique(cluster):
                    own = cluster == k
                    counts[k] += int(own.sum())
                    inertia[k] += sum(distance[own].tolist())
                    sums[k] = [a + b for a, b in zip(sums[k], component_sums(x[own]).tolist())]
        full = [k for k, n in enumerate(counts) if n]
        at = [(k, n, v) for k in full for n, v in enumerate([counts[k], inertia[k], *sums[k]])]
        columns = [pa.array([row[0] for row in at], pa.int32()), pa.array([row[1] for row in at], pa.int32()), pa.array([str(row[2]) for row in at], pa.string())]
        yield pa.record_batch(columns, names=["cluster", "place", "value"])

    rows = packed.select("planes").mapInArrow(summed, "cluster int, place int, value string")
    totals = rows.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found: dict[int, list[int]] = {}
    for r in totals.collect():
        found.setdefault(r.cluster, [0] * (WIDTH + 2))[r.place] = int(r.value)
    return {k: (v[0], v[1], v[2:]) for k, v in found.items()}


def train(packed: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """``centroids`` after so many rounds of assigning and averaging; empty ones stay."""
    centroids = list(centroids)
    for _ in range(rounds if centroids else 0):
        for cluster, (n, _, sums) in assigned_sums(packed, centroids).items():
            centroids[cluster] = [s // n for s in sums]
    return centroids


def assign(packed: DataFrame, centroids: Sequence[Sequence[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every packed vector."""
    c = np.array(centroids, dtype=np.int64).reshape(-1, WIDTH)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _unpacked(batch.column("planes")):
                cluster, distance = nearest(x, c)
                ids = batch.column("vec_id").slice(at, len(x))
                yield pa.record_batch([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return packed.mapInArrow(placed, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per suitable vector."""
    packed = settled(pack(vectors))
    centroids = train(packed, first_centroids(vectors, k, seed), rounds)
    totals = assigned_sums(packed, centroids) if centroids else {}
    inertia = sum(t[1] for t in totals.values())
    facts = [(n, t[1], inertia, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for n, t in sorted(totals.items())]
    # One row per centroid.
    facts = packed.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    found = assign(packed, centroids).join(F.broadcast(facts), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(n: int) -> str:
    """One round of the twin: ``a{n}`` assigns every vector by ``c{n}``, ``c{n+1}`` are the new centroids."""
    return f"""
s{n} AS (
  SELECT v.row, c.cluster, v.q, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
  FROM v, c{n} c),
a{n} AS (SELECT row, min({{'d': distance, 'k': cluster}}) AS m FROM s{n} GROUP BY row),
u{n} AS (
  SELECT m.k AS cluster, i, sum(q[i])::HUGEINT AS s, count(*) AS n
  FROM a{n} JOIN v USING (row), range(1, 65) r(i) GROUP BY ALL),
c{n + 1} AS (
  SELECT c.cluster, coalesce(n.q, c.q) AS q FROM c{n} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q FROM u{n} GROUP BY cluster) n ON n.cluster = c.cluster),"""


CLUSTER_SQL = f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE len(embedding) = 64),
v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(x, lambda y: floor(1024 * y)::BIGINT) AS q
  FROM e WHERE len(list_filter(x, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS cluster, q
  FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, 'null')) AS h, q FROM v ORDER BY h, q LIMIT 8)),{"".join(map(_round_sql, range(ROUNDS + 1)))}
f AS (SELECT row, m.k AS cluster, m.d AS distance FROM a{ROUNDS})
SELECT v.vec_id, f.cluster::INTEGER AS cluster, f.distance::BIGINT AS distance,
  (sum(f.distance) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia, (sum(f.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM f JOIN v ON v.row = f.row JOIN c{ROUNDS} c ON c.cluster = f.cluster
"""
