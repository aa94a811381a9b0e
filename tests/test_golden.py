"""Known answers on the three link rows."""

import pytest

from lexifacet import Search
from lexifacet.functions.text import escape_query
from lexifacet.operators.batch import batch_errors, run_batch
from lexifacet.operators.excerpts import build_excerpts
from lexifacet.operators.keywords import keyword_stats, word_stats
from lexifacet.operators.updates import update_attributes, update_frame, update_many, updated_count
from lexifacet.sources.catalog import Catalog


def test_wifi(test1):
    r = Search.over(test1).match("wifi").result()
    rows = r.matches.collect()
    assert [(x.id, x.weight) for x in rows] == [(2, 2), (3, 2), (1, 1)]
    assert [x.group_id for x in rows] == [2, 1, 1]
    assert [int(x.created_at.timestamp()) for x in rows] == [1175683755, 1175683847, 1175683690]
    assert [x.tags for x in rows] == [[5, 6, 7, 8], [1, 7, 9, 10], [1, 2, 3, 4]]
    assert [round(x.rating, 2) for x in rows] == [54.85, 16.25, 13.32]
    assert r.totals.collect() == [(3, 3)]
    assert r.words.collect() == [("wifi", 3, 6)]
    assert r.fields == ("name", "description")
    assert r.attrs == ("group_id", "created_at", "rating", "tags")


def test_wifi_64_bit_ids(test2):
    s = Search.over(test2).match("wifi")
    assert [x.id for x in s.matches().collect()] == [4294967298, 4294967299, 4294967297]
    assert s.totals().collect() == [(3, 3)]


def test_keyword_statistics(spark, test1):
    asked = spark.createDataFrame([("wifi",), ("gprs",), ("zzz",)], "word string")
    expected = [("gprs", 1, 1), ("wifi", 3, 6), ("zzz", 0, 0)]
    assert sorted(keyword_stats(test1, asked).collect()) == expected
    assert word_stats(test1, ["wifi", "gprs"]).collect() == [("wifi", 3, 6), ("gprs", 1, 1)]


def test_excerpts(spark, test1):
    docs = spark.createDataFrame(
        [(0, "what the world"), (1, "London is the capital of Great Britain")], "id long, text string"
    )
    rows = build_excerpts(docs, "id", "text", "the", test1).orderBy("id").collect()
    assert [x.snippet for x in rows] == [
        "what <b>the</b> world",
        "London is <b>the</b> capital of Great Britain",
    ]


def test_update_one_document(spark, test1):
    new = update_frame(spark, "id", ["group_id"], {2: [1]})
    assert updated_count(test1, new).collect() == [(1,)]
    changed = update_attributes(test1, new)
    assert sorted((x.id, x.group_id) for x in changed.attributes().collect()) == [(1, 1), (2, 1), (3, 1)]
    found = Search.over(changed).match("wifi").filter_values("group_id", 1).matches()
    assert [x.id for x in found.collect()] == [2, 3, 1]


def test_update_multi_valued(spark, test1):
    new = update_frame(spark, "id", ["tags"], {2: [[9, 1, 2, 3, 4, 5, 6, 7, 8]]}, mva=True)
    assert updated_count(test1, new).collect() == [(1,)]
    rows = {x.id: x.tags for x in update_attributes(test1, new).attributes().collect()}
    assert rows == {1: [1, 2, 3, 4], 2: [1, 2, 3, 4, 5, 6, 7, 8, 9], 3: [1, 7, 9, 10]}


def test_updates_of_unknown_ids_and_attributes(spark, test1):
    new = update_frame(spark, "id", ["group_id"], {2: [1], 99: [5]})
    assert updated_count(test1, new).collect() == [(1,)]
    odd = update_frame(spark, "id", ["nowhere"], {2: [1]})
    with pytest.raises(ValueError):
        update_attributes(test1, odd)
    assert update_attributes(test1, odd, ignore_missing=True) is test1
    _, count = update_many([test1, test1], new)
    assert count.collect() == [(2,)]


def test_an_id_updated_twice_is_an_error(spark, test1):
    twice = spark.createDataFrame([(2, 1), (2, 3)], "id long, group_id long")
    with pytest.raises(Exception, match="two updates of id 2"):
        update_attributes(test1, twice).attributes().collect()


def test_escape(spark):
    row = spark.createDataFrame([("escaping-sample@query/string",)], "t string").select(escape_query("t"))
    assert row.collect() == [(r"escaping\-sample\@query\/string",)]


def test_unknown_collection(test1):
    with pytest.raises(ValueError, match="unknown collection"):
        Catalog(test1).pick("fakeindex")


def test_catalog_names(test1, test2):
    both = Catalog(test1, test2)
    for names in ("test2 test1", "test2;test1", "test2, test1"):
        assert [c.name for c in both.pick(names)] == ["test2", "test1"]
    assert [c.name for c in both.pick()] == ["test1", "test2"]


def test_batch_with_a_bad_query(spark, test1):
    catalog = Catalog(test1)
    outcomes = run_batch(
        [
            lambda: Search.over(*catalog.pick("test1")).match("wifi").matches(),
            lambda: Search.over(*catalog.pick("fakeindex")).match("wifi").matches(),
            lambda: Search.over(*catalog.pick("test1")).match("gprs").matches(),
        ]
    )
    assert [x.id for x in outcomes[0].collect()] == [2, 3, 1]
    assert [x.id for x in outcomes[2].collect()] == [3]
    errors = batch_errors(spark, outcomes).orderBy("query_no").collect()
    assert [x.query_no for x in errors] == [0, 1, 2]
    assert errors[0].error is None and "unknown collection" in errors[1].error
