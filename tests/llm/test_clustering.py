"""Clustering by bit planes against plain Python."""

import hashlib
import math
import random
from collections import Counter

import numpy as np

from lexifacet.llm import clustering

SCHEMA = "vec_id bigint, embedding array<double>, label int, planes string, cluster string"


def slow(rows, k=8, rounds=10):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest(), q) for i, q in vectors)[:k]
    centroids = [q for _, q in first]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        where = [near(q)[1] for _, q in vectors]
        for n in set(where):
            own = [q for (_, q), w in zip(vectors, where) if w == n]
            centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [near(q) for _, q in vectors]
    inertia = Counter()
    for d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, inertia[n], inertia.total(), digest[n]) for (i, _), (d, n) in zip(vectors, found))


def test_clusters(spark):
    rng = random.Random(5)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for i in range(300)]
    rows += [(400, None), (401, []), (402, [0.0] * 63), (403, [0.0] * 65), (404, [None] + [0.0] * 63), (405, [math.nan] + [1.0] * 63), (406, [math.inf] + [1.0] * 63)]
    rows += [rows[3], rows[3], (7, [0.5] * 64), (7, [-0.5] * 64), (None, [0.0] * 64), (None, [-1e-9] * 64), (500, [2.0e4, -3.0e4] * 32)]
    rows += [(600, [0.25] * 64)] * 150
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = Counter(map(tuple, clustering.cluster(df).collect()))
    assert got == slow(rows)
    again = Counter(map(tuple, clustering.cluster(df.repartition(7)).collect()))
    assert again == got


def test_few_or_no_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(3)] + [(9, [1.0])]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in few], SCHEMA)
    assert Counter(map(tuple, clustering.cluster(df).collect())) == slow(few)
    assert clustering.cluster(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [0.5] * 64, 1, "x", "y")] * 40, SCHEMA)
    assert {(r.cluster, r.distance) for r in clustering.cluster(same).collect()} == {(0, 0)}


def test_popcounts_are_dot_products():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3000, 3000, (200, 64)), rng.integers(-70000, 70000, (5, 64))
    px, pc = clustering.planes_of(x), clustering.planes_of(c)
    assert (clustering.dots(px, pc) == x @ c.T).all()
    assert (clustering.norms(px) == (x * x).sum(axis=1)).all()
    assert (clustering.component_sums(px) == x.sum(axis=0)).all()
    assert clustering.planes_of(np.zeros((2, 64), dtype=np.int64)).tolist() == [[0], [0]]
