"""Facets with settings of their own, and words asked before the vocabulary."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexifacet import Collection
from lexifacet.operators import batch as B
from lexifacet.operators import keywords as K
from lexifacet.sources import collection as C


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(4)
    rows = [(i, rng.randint(1, 9), rng.choice(["a", "b", None, "c"]), rng.choice([2, 10, 100, None]), [rng.randint(1, 12)]) for i in range(400)]
    return spark.createDataFrame(rows, "id int, weight int, lang string, size int, tags array<int>")


def test_facets_keep_their_own_order_and_limit(found):
    rows = found.collect()
    wanted = [B.Facet("lang", distinct="size"), B.Facet("size", sort="@group desc", limit=2), ("tags", "attr", "@count desc, @group asc", 4), ("size",)]
    got = [r.asDict() for r in B.facets(found, "id", wanted).collect()]
    by = {n: sorted((r for r in got if r["query_no"] == n), key=lambda r: r["place"] or 0) for n in range(4)}
    assert [(r["group_key"], r["place"]) for r in by[1]] == [("100", 1), ("10", 2)]
    tags = Counter(t for r in rows for t in r.tags)
    assert [(int(r["group_key"]), r["group_count"]) for r in by[2]] == sorted(tags.items(), key=lambda x: (-x[1], x[0]))[:4]
    assert {r["group_key"]: r["group_distinct"] for r in by[0]} == {k: 3 for k in ("a", "b", "c", None)}
    assert len(by[3]) == 4 and all(r["place"] is None and r["group_distinct"] is None for r in by[3])
    for r in by[0]:
        best = min((x for x in rows if x.lang == r["group_key"]), key=lambda x: (-x.weight, x.id))
        assert (r["id"], r["weight"]) == (best.id, best.weight)


def test_facet_limits_come_before_the_exchange(found):
    plan = B.facets(found, "id", [("tags", "attr", None, 3), ("lang", "attr", "@weight", 2)])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_facet_settings_are_checked(found):
    with pytest.raises(ValueError):
        B.facets(found, "id", [("lang", "attr", None, 0)])
    with pytest.raises(ValueError):
        B.facets(found, "id", [("lang", "attr", "weather desc")])


@pytest.mark.parametrize("mark_words", [1, 4096])
def test_asked_words_only_are_counted(spark, monkeypatch, mark_words):
    """With one word of bits most tokens share a bit with an asked one; the result is the same."""
    monkeypatch.setattr(C, "MARK_WORDS", mark_words)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(80)) + " the the" for _ in range(100)] + [None, ""]
    docs = Collection("docs", spark.createDataFrame(list(enumerate(texts)), "id int, body string"), "id", ("body",), ())
    asked = [f"w{n}" for n in range(0, 3000, 97)] + ["the", "the", "never", None]
    wanted = spark.createDataFrame([(w,) for w in asked], "word string")
    got = {r.word: (r.docs, r.hits) for r in K.keyword_stats(docs, wanted).collect()}
    split = [(t or "").split() for t in texts]
    assert got == {w: (sum(w in t for t in split), sum(t.count(w) for t in split)) for w in set(asked)}
    counted = docs.terms_of(wanted.select(F.col("word").alias("token")).distinct()).count()
    assert counted <= (3001 if mark_words == 1 else len(asked) + 5)
