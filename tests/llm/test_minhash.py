"""MinHash near-duplicates against all pairs in plain Python."""

import random
import re
from collections import Counter

import numpy as np

from lexifacet.llm import minhash

SCHEMA = "doc_id bigint, text string, shape bigint, band bigint, n int"


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(b" ".join(w[i : i + 2]) for i in range(max(1, len(w) - 1))) if w else frozenset()


def slow(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                label[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return Counter((d, len(sets[i]), least.get(top(i)), d == least.get(top(i))) for i, (d, _) in enumerate(rows))


def result(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(11)
    prose = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows = [(i, " ".join(prose(rng.choice([1, 2, 5, 40, 120])))) for i in range(60)]
    for size in (20, 60, 200):
        base = prose(size)
        # Copies around the limit: the base links some, chains link others, some stay alone.
        rows += [(1000 * size + i, edited(rng, base, rng.randint(0, size // 9))) for i in range(60)]
    rows += [(5000, "a a a a"), (5001, "A\ta"), (5002, "One"), (5003, "one"), (5004, None), (5005, ""), (5006, " \n"), (5007, "É É b"), (5008, "é é b")]
    rows += [(7, "another text of the same id"), (None, "no id here"), (None, "no id here"), (None, rows[3][1]), rows[8], rows[8]]
    rows += [(8000 + i, rows[70][1]) for i in range(200)] + [(9000, " ".join(prose(30000)))]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    want = slow(rows)
    want[None, len(shingles("no id here")), None, True] = want.pop((None, len(shingles("no id here")), None, True), 0)
    assert result(df) == want
    monkeypatch.setattr(minhash, "BLOCK", 7)
    assert result(df.repartition(5)) == want


def test_small_tables(spark):
    df = spark.createDataFrame([(1, "a b", 0, 0, 0), (2, None, 0, 0, 0)], SCHEMA)
    assert result(df.limit(0)) == Counter()
    assert result(df) == Counter({(1, 1, 1, True): 1, (2, 0, 2, True): 1})


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = np.unique(numbers[:1000]), np.unique(numbers[200:1200])
    x, y = minhash.signatures([a, b], 1024)
    assert abs((x == y).mean() - 800 / 1200) < 0.06
    every = np.arange(1 << 16, dtype=np.uint32) << np.uint32(7)
    assert len(np.unique(minhash.permuted(every.copy(), minhash.SECOND))) == len(every)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for size in (3, 50, 900):
        a, b = np.unique(numbers[:size]), np.unique(numbers[size // 9 : size + size // 9])
        bits = int.from_bytes(minhash.sketch_of(a)) ^ int.from_bytes(minhash.sketch_of(b))
        assert bits.bit_count() <= len(np.setxor1d(a, b))
