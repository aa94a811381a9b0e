"""Empty, missing and extreme inputs."""

import pytest
from pyspark.sql import functions as F

from lexifacet import And, Collection, Or, Phrase, Search, Word
from lexifacet.operators.excerpts import ExcerptOptions, build_excerpts, build_passages, excerpt
from lexifacet.operators.keywords import corpus_stats, word_stats
from lexifacet.operators.updates import string_ordinal

ROWS = [
    (1, None, None, None, []),
    (2, "", 5, 1.5, [3]),
    (3, "one", -7, 2.5, [1, 2]),
    (4, "Wi-Fi wifi WIFI under_score Straße ñandú", 0, -1.0, [2, 9]),
    (5, "one two one two", 2**40, 1e300, [9]),
    (2**33, "two", -(2**40), 0.0, []),
]


@pytest.fixture(scope="module")
def c(spark):
    df = spark.createDataFrame(ROWS, "id long, text string, size long, ratio double, tags array<long>")
    return Collection("odd", df, "id", ("text",), ("size", "ratio", "tags"))


def ids(df):
    return sorted(x.id for x in df.collect())


def test_empty_query_matches_everything_and_unknown_words_nothing(c):
    assert len(ids(Search.over(c).match("").found())) == len(ROWS)
    assert ids(Search.over(c).match("zzz").found()) == []
    assert ids(Search.over(c).match("!?").found()) == []
    assert Search.over(c).match("zzz").totals().collect() == [(0, 0)]
    assert Search.over(c).match("zzz").words().collect() == [("zzz", 0, 0)]


def test_words(c):
    assert ids(Search.over(c).match("WIFI").found()) == [4]
    assert ids(Search.over(c).match("straße").found()) == [4]
    assert ids(Search.over(c).match("ÑANDÚ").found()) == [4]
    assert ids(Search.over(c).match("under").found()) == []
    assert ids(Search.over(c).match("under_score").found()) == [4]
    assert ids(Search.over(c).match("fi wi", "any").found()) == [4]
    assert ids(Search.over(c).match("two one two", "phrase").found()) == [5]
    assert ids(Search.over(c).match("two", "phrase").found()) == [5, 2**33]
    assert ids(Search.over(c).match("und*").found()) == [4]
    assert ids(Search.over(c).match("under%").found()) == []


def test_underscore_is_no_wildcard(spark):
    df = spark.createDataFrame([(1, "a_b"), (2, "axb")], "id long, text string")
    c = Collection("u", df, "id", ("text",))
    assert ids(Search.over(c).where(Word("a_*")).found()) == [1]


def test_empty_collection(spark, c):
    none = Collection("none", c.df.limit(0), "id", c.fields, c.attrs)
    for s in (Search.over(none).match("one"), Search.over(none).where(Or("one", "two"))):
        assert s.matches().collect() == [] and s.totals().collect() == [(0, 0)]
    assert word_stats(none, ["one"]).collect() == [("one", 0, 0)]
    assert corpus_stats(none).collect()[0].n_docs == 0
    assert Search.over(none).everything().group_by("size").matches().collect() == []


def test_filters(c):
    s = Search.over(c).everything()
    assert len(ids(s.filter_values("size", []).found())) == len(ROWS)
    assert ids(s.filter_values("size", 5).found()) == [2]
    assert ids(s.filter_values("size", [5], exclude=True).found()) == [1, 3, 4, 5, 2**33]
    assert ids(s.filter_range("size", -(2**41), -1).found()) == [3, 2**33]
    assert ids(s.filter_range("size", -7, -7).found()) == [3]
    assert ids(s.filter_range("size", -(2**41), 2**41, exclude=True).found()) == [1]
    assert ids(s.filter_float_range("ratio", 1.5, 1e300).found()) == [2, 3, 5]
    assert ids(s.filter_values("tags", [2, 3]).found()) == [2, 3, 4]
    assert ids(s.filter_values("tags", [2, 3], exclude=True).found()) == [1, 5, 2**33]
    assert ids(s.filter_range("tags", 3, 8).found()) == [2]
    assert ids(s.filter_range("tags", 3, 8, exclude=True).found()) == [1, 3, 4, 5, 2**33]
    assert ids(s.id_range(4, 2**40).found()) == [4, 5, 2**33]
    assert len(ids(s.id_range(0, 0).found())) == len(ROWS)


def test_pages(c):
    s = Search.over(c).everything().sort_by("extended", "@id DESC")
    assert [x.id for x in s.limits(1, 2).matches().collect()] == [5, 4]
    assert s.limits(100, 5).matches().collect() == []
    assert [x.id for x in s.limits(2, 5, 3).matches().collect()] == [4]
    assert s.limits(3, 5, 3).matches().collect() == []
    assert s.limits(0, 5, 3).totals().collect() == [(3, 6)]
    assert s.limits(0, 5, 1000, 2).totals().collect() == [(2, 2)]
    assert [x.id for x in s.limits(0, 5, 1000, 2).matches().collect()] == [2, 1]
    outer = s.limits(0, 1, 3).outer_select("@id ASC", 1, 5)
    assert [x.id for x in outer.matches().collect()] == [5, 2**33]


def test_nulls_sort_first_ascending_and_last_descending(c):
    s = Search.over(c).everything()
    assert [x.id for x in s.sort_by("attr_asc", "size").limits(0, 1).matches().collect()] == [1]
    assert [x.id for x in s.sort_by("attr_desc", "size").limits(5, 1).matches().collect()] == [1]
    best = s.sort_by("attr_desc", "size").group_by("tags").groups().collect()
    assert {x.group_key: x.id for x in best} == {1: 3, 2: 4, 3: 2, 9: 5}


def test_override_is_local_and_last_one_counts(c):
    s = Search.over(c).everything()
    o = s.override("size", "integer", {4: 1}).override("size", "integer", {4: 42, 77: 1})
    assert ids(o.filter_values("size", 42).found()) == [4]
    assert ids(s.filter_values("size", 42).found()) == []
    assert ids(s.override("ratio", "float", {1: 9.5}).filter_float_range("ratio", 9.0, 10.0).found()) == [1]


def test_last_collection_wins(spark, c):
    newer = c.df.filter("id IN (4, 5)").withColumn("size", F.col("size") + 1)
    delta = Collection("delta", newer.withColumn("text", F.lit("one")), "id", c.fields, c.attrs)
    main = c
    s = Search.over(main, delta).match("one two", "any")
    rows = {x.id: (x.weight, x.size) for x in s.found().collect()}
    assert rows == {3: (1, -7), 4: (1, 1), 5: (1, 2**40 + 1), 2**33: (1, -(2**40))}
    weighted = s.index_weights({"odd": 10, "delta": 100}).found().collect()
    assert {x.id: x.weight for x in weighted}[5] == 4 * 10 + 1 * 100


def test_attribute_pair_of_the_last_attribute(c):
    with pytest.raises(ValueError):
        Search.over(c).everything().group_by("tags", "attrpair").groups()


def test_token_counts(c):
    rows = {x.token: (x.docs, x.hits) for x in c.terms().collect()}
    assert rows["one"] == (2, 3) and rows["wifi"] == (1, 2) and rows["wi"] == (1, 1)


def test_ordinal_is_dense_over_partitions(spark):
    values = [f"v{i % 97:03d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {x.value: x.ordinal for x in string_ordinal(df, "v", partitions=7).collect()}
    assert got == {v: n + 1 for n, v in enumerate(sorted(set(values) - {None}))}


def snippet(spark, text, words, **options):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    return build_excerpts(df, "id", "text", words, **options).collect()[0].snippet


def test_excerpt_edges(spark):
    assert snippet(spark, None, "a") == ""
    assert snippet(spark, "", "a") == ""
    assert snippet(spark, "no hit here", "zzz") == "no hit here"
    assert snippet(spark, "no hit here", "zzz", allow_empty=True) == ""
    assert snippet(spark, "no hit here", "zzz", limit=7) == "no hit"
    assert snippet(spark, "no hit here", "zzz", limit=8) == "no hit"
    assert snippet(spark, "a.b a", "a", before_match="[", after_match="]") == "[a].b [a]"
    assert snippet(spark, "x a b x b a", "a b", exact_phrase=True) == "x <b>a</b> <b>b</b> x b a"
    long = "w " * 30 + "key " + "w " * 30 + "key2 key " + "w " * 30
    assert snippet(spark, long, "key key2", around=1, limit=40) == "w <b>key</b> w ... w <b>key2</b> <b>key</b> w"
    assert snippet(spark, long, "key key2", around=1, limit=40, weight_order=True) == "w <b>key2</b> <b>key</b> w ... w <b>key</b> w"
    assert snippet(spark, long, "key key2", around=1, single_passage=True) == "w <b>key2</b> <b>key</b> w"
    assert snippet(spark, long, "key key2", around=1, limit=3) == "<b>key</b>"
    assert snippet(spark, long, "key", around=1, limit_words=3) == "w <b>key</b> w"
    assert snippet(spark, "A b. C a d! E", "a", around=3, limit=12, use_boundaries=True) == "<b>A</b> b"
    assert snippet(spark, "A b. C a d! Even more", "a", around=3, limit=13, use_boundaries=True) == "<b>A</b> b ... C <b>a</b> d"


def test_excerpt_of_a_condition(spark):
    tree = And(Phrase("a b"), "c")
    assert snippet(spark, "a b c b", tree, query_mode=True) == "<b>a</b> <b>b</b> <b>c</b> b"
    assert snippet(spark, "a b b", tree, query_mode=True, allow_empty=True) == ""


def test_excerpt_strips_markup(spark):
    df = spark.createDataFrame([(1, "<p>a <b>key</b></p><script>key()</script>")], "id long, html string")
    row = df.select(excerpt("html", "key", options=ExcerptOptions(html_strip_mode="strip")).alias("x")).collect()[0]
    assert row.x.split() == ["a", "<b>key</b>"]


def test_passage_numbers(spark):
    text = "key " + "w " * 20 + "key"
    df = spark.createDataFrame([(1, text), (2, "none")], "id long, text string")
    rows = build_passages(df, "id", "text", "key", around=1, start_passage_id=4).collect()
    assert [(x.id, x.passage_id, x.passage) for x in rows] == [(1, 4, "<b>key</b> w"), (1, 5, "w <b>key</b>")]
