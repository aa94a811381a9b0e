"""Conditions, weights and excerpts against plain loops on random small texts."""

import math
import random
import re
from dataclasses import replace

import pytest

from lexifacet import And, Collection, Near, Not, Or, Phrase, Quorum, Search, Word
from lexifacet.operators.batch import search_table
from lexifacet.operators.keywords import wildcard_terms
from lexifacet.operators.rank import RANKERS
from lexifacet.sources.postings import open_postings, write_postings
from lexifacet.sources.storage import new_folder

VOCABULARY = ["a", "b", "c", "d", "ab", "a_b", "ü"]
GAPS = [" ", " ", ", ", ". ", "-", "\n"]


def make_texts(n, longest):
    rng = random.Random(7)
    out = []
    for i in range(n):
        fields = []
        for _ in range(2):
            words = [rng.choice(VOCABULARY) for _ in range(rng.randint(0, longest))]
            text = "".join(w + rng.choice(GAPS) for w in words)
            fields.append(text.upper() if rng.random() < 0.3 else text)
        out.append((i, *fields, rng.randint(0, 5)))
    return out


DOCS = make_texts(120, 12)


@pytest.fixture(scope="module")
def c(spark):
    df = spark.createDataFrame(DOCS, "id long, title string, body string, size long")
    return Collection("docs", df, "id", ("title", "body"), ("size",))


@pytest.fixture(scope="module")
def indexed(spark, c):
    path = new_folder(spark, "small")
    write_postings(c, path, buckets=4)
    return open_postings(c, path)


def tokens(text):
    return re.findall(r"\w+", text.lower())


TOKENS = {d[0]: (tokens(d[1]), tokens(d[2])) for d in DOCS}


def is_word(tree, w):
    pattern = re.escape(tree.text).replace(r"\*", ".*")
    return re.fullmatch(pattern, w) is not None


def holds(tree, fields):
    if isinstance(tree, str):
        tree = Word(tree)
    if isinstance(tree, And):
        return all(holds(x, fields) for x in tree.conditions)
    if isinstance(tree, Or):
        return any(holds(x, fields) for x in tree.conditions)
    if isinstance(tree, Not):
        return not holds(tree.conditions[0], fields)
    if isinstance(tree, Phrase):
        n = len(tree.texts)
        return any(tuple(f[i : i + n]) == tree.texts for f in fields for i in range(len(f)))
    if isinstance(tree, Near):
        wanted = set(tree.texts)
        return any(wanted <= set(f[i : i + tree.span]) for f in fields for i in range(len(f)))
    if isinstance(tree, Quorum):
        return sum(any(w in f for f in fields) for w in set(tree.texts)) >= tree.least
    picked = fields if tree.fields is None else [fields[["title", "body"].index(tree.fields)]]
    for f in picked:
        for i, w in enumerate(f):
            if is_word(tree, w) and (not tree.first or i == 0) and (not tree.last or i == len(f) - 1):
                return True
    return False


TREES = [
    Word("a"),
    And("a", "b"),
    Or("a", "ü"),
    And("a", Not("b")),
    Word("a", fields="title"),
    Word("b", first=True),
    Word("b", last=True),
    Word("b", first=True, last=True),
    Word("a*"),
    And(Word("*b"), "c"),
    Phrase("a b"),
    Phrase("a a"),
    Phrase("a b a"),
    Near("a b", 2),
    Near("a b c", 4),
    Near("c", 1),
    Quorum("a b c d", 3),
    Quorum("a b c d", 5),
    Or(And("a_b", Near("a d", 3)), And(Phrase("c d"), Not(Or("a", "b")))),
    And(Or("a", "b"), Or("c", "d"), Not(Phrase("a c"))),
]


@pytest.mark.parametrize("n", range(len(TREES)))
@pytest.mark.parametrize("source", ["c", "indexed"])
def test_conditions(request, source, n):
    collection = request.getfixturevalue(source)
    found = Search.over(collection).where(TREES[n]).rank("none").found()
    want = sorted(i for i, fields in TOKENS.items() if holds(TREES[n], fields))
    assert sorted(x.id for x in found.collect()) == want


def longest_run(query, field):
    best = 0
    for q in range(len(query)):
        for p in range(len(field)):
            n = 0
            while q + n < len(query) and p + n < len(field) and query[q + n] == field[p + n]:
                n += 1
            best = max(best, n)
    return best


def bm25(query, plain=False):
    words = list(dict.fromkeys(query))
    n = len(TOKENS)
    mean = sum(len(t) + len(b) for t, b in TOKENS.values()) / n
    idf = {}
    for w in words:
        df = sum(w in t or w in b for t, b in TOKENS.values())
        idf[w] = max(math.log(n / df if plain else (n - df + 1) / df), 0) if df else 0
    most = sum(idf.values()) * 2.2
    out = {}
    for i, (t, b) in TOKENS.items():
        s = 0
        for w in words:
            tf = t.count(w) + b.count(w)
            s += idf[w] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * (len(t) + len(b)) / mean)) if tf else 0
        out[i] = max(0, min(999, math.floor(round(1000 * s / most, 9)))) if most else 0
    return out


def weight(ranker, query, i, scores, w=(3, 1)):
    words = list(dict.fromkeys(query))
    per = []
    for f, fw in zip(TOKENS[i], w):
        run = longest_run(query, f)
        own = [p for p, t in enumerate(f) if t in words]
        distinct = len({f[p] for p in own})
        per.append((run, own, distinct, fw, f == query))
    if ranker == "none":
        return 1
    if ranker == "bm25":
        return scores[i]
    if ranker == "proximity":
        return sum(r * fw for r, _, _, fw, _ in per)
    if ranker == "proximity_bm25":
        return sum(r * fw for r, _, _, fw, _ in per) * 1000 + scores[i]
    if ranker == "wordcount":
        return sum(len(own) * fw for _, own, _, fw, _ in per)
    if ranker == "matchany":
        k = len(words) * 2
        return sum(fw * (d + (r - 1) * k) for r, _, d, fw, _ in per if r)
    if ranker == "fieldmask":
        return sum(1 << n for n, x in enumerate(per) if x[1])
    if ranker == "head_exact":
        total = sum(fw * (4 * r + 2 * (own[:1] == [0]) + exact) for r, own, _, fw, exact in per)
        return total * 1000 + scores[i]
    return sum(r * fw + len(own) for r, own, _, fw, _ in per) * 10 + scores[i]


QUERIES = [["a"], ["a", "b"], ["a", "b", "a"], ["a", "a"], ["c", "d", "a_b", "ü"], ["a", "zzz"]]


@pytest.mark.parametrize("ranker", RANKERS)
@pytest.mark.parametrize("source", ["c", "indexed"])
def test_weights(request, source, ranker):
    collection = request.getfixturevalue(source)
    for query in QUERIES:
        s = Search.over(collection).where(Or(*query)).field_weights({"title": 3})
        s = s.rank(ranker, "lcs * user_weight + hit_count", "field_sum * 10 + bm25")
        scores = bm25(query)
        got = {x.id: x.weight for x in s.found().collect()}
        want = {i: weight(ranker, query, i, scores) for i, f in TOKENS.items() if holds(Or(*query), f)}
        assert got == want, query


def test_plain_idf(c):
    got = {x.id: x.weight for x in Search.over(c).where(Or("a", "ü")).rank("bm25").idf("plain").found().collect()}
    scores = bm25(["a", "ü"], plain=True)
    assert got == {i: scores[i] for i, f in TOKENS.items() if holds(Or("a", "ü"), f)}


TABLE_TEXTS = ["a b", "c d a", "zzz a", "ü", "", "a a", "zzz", "a b a", "d", "ab d b", "A-B, c"]


@pytest.mark.parametrize("mode", ["all", "any"])
@pytest.mark.parametrize("source", ["c", "indexed"])
@pytest.mark.parametrize("sent", [0, 1000])
def test_query_table(request, spark, monkeypatch, source, mode, sent):
    monkeypatch.setattr("lexifacet.operators.batch.TOKENS_SENT", sent)
    collection = request.getfixturevalue(source)
    queries = spark.createDataFrame(list(enumerate(TABLE_TEXTS)), "query_no int, text string")
    got = search_table(collection, queries, mode=mode, best=5).collect()
    want = set()
    for n, text in enumerate(TABLE_TEXTS):
        query = list(dict.fromkeys(tokens(text)))
        tree = And(*query) if mode == "all" and query else Or(*query) if query else None
        ranker = "proximity" if mode == "all" else "matchany"
        rows = [
            (weight(ranker, query, i, None, w=(1, 1)), i)
            for i, fields in TOKENS.items()
            if tree is not None and holds(tree, fields)
        ]
        rows.sort(key=lambda x: (-x[0], x[1]))
        want |= {(n, i, w) for w, i in rows[:5]}
    assert {(x.query_no, x.id, x.weight) for x in got} == want


@pytest.mark.parametrize("mode", ["all", "any"])
@pytest.mark.parametrize("source", ["c", "indexed"])
def test_query_table_equals_search(request, spark, source, mode):
    settings = {"stopwords": frozenset({"d"}), "wordforms": {"ab": "a", "a_b": "a", "c": "ü"}}
    collection = replace(request.getfixturevalue(source), **settings)
    texts = ["c d a", "a b a", "d", "ab d b"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_no int, text string")
    got = sorted((x.query_no, x.id, x.weight) for x in search_table(collection, queries, mode=mode).collect())
    want = [
        (n, x.id, x.weight)
        for n, text in enumerate(texts)
        for x in Search.over(collection).match(text, mode).found().collect()
    ]
    assert got == sorted(want)


def test_wordforms_and_stopwords(c):
    forms = {"ab": "a", "a_b": "a"}
    d = Collection("docs", c.df, "id", c.fields, c.attrs, stopwords={"d"}, wordforms=forms)
    got = sorted(x.id for x in Search.over(d).match("ab d b").found().collect())
    want = [i for i, (t, b) in TOKENS.items() if "b" in t + b and {"a", "ab", "a_b"} & set(t + b)]
    assert got == sorted(want)
    exact = Search.over(d).where(Word("ab", exact=True)).found()
    assert sorted(x.id for x in exact.collect()) == [i for i, (t, b) in TOKENS.items() if "ab" in t + b]
    # A stop word keeps its place: "a d b" means a, any word, b.
    phrase = Search.over(d).where(Phrase("a d c")).found()
    want = [
        i
        for i, fields in TOKENS.items()
        if any(f[p] in ("a", "ab", "a_b") and f[p + 2 : p + 3] == ["c"] for f in fields for p in range(len(f)))
    ]
    assert sorted(x.id for x in phrase.collect()) == want


def test_stopwords_in_conditions(c):
    d = Collection("docs", c.df, "id", c.fields, c.attrs, stopwords={"d"})
    got = sorted(x.id for x in Search.over(d).where(And("d", "a")).found().collect())
    assert got == [i for i, (t, b) in TOKENS.items() if "a" in t + b]
    assert Search.over(d).where(Or("d", Phrase("d d"))).found().collect() == []
    assert Search.over(d).where(And("d", Not("a"))).found().collect() == []
    assert Search.over(d).match("d").found().collect() == []


def test_word_statistics(c, indexed):
    words = ["a", "a*", "zzz", "b"]
    want = []
    for w in words:
        own = [[t for t in title + body if is_word(Word(w), t)] for title, body in TOKENS.values()]
        want.append((w, sum(bool(x) for x in own), sum(map(len, own))))
    for collection in (c, indexed):
        s = Search.over(collection).where(Or(*words))
        assert s.words().collect() == want
        assert {x.token for x in wildcard_terms(collection, "a*").collect()} == {"a", "ab", "a_b"}
        assert collection.terms().count() == len(VOCABULARY)
