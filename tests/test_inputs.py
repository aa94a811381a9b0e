"""Inputs beside those of the named queries: written tables, typed filters, repeated ids, several collections."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexifacet import And, Collection, Search, Word
from lexifacet.operators.batch import search_table
from lexifacet.operators.keywords import corpus_stats
from lexifacet.operators.updates import update_attributes, updated_count
from lexifacet.sources.postings import open_postings, write_postings


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "the cat", True, datetime(2020, 1, 1), 5),
        (2, "the dog and cats", False, datetime(2021, 1, 1), 6),
        (3, "cat the", None, datetime(2022, 1, 1), 7),
    ]
    df = spark.createDataFrame(rows, "id bigint, body string, flag boolean, ts timestamp, n bigint")
    return Collection("docs", df, "id", ("body",), ("flag", "ts", "n"))


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("buckets", [1, 16, 128])
def test_written_tables_know_their_buckets(docs, tmp_path, buckets):
    path = f"{tmp_path}/words"
    write_postings(docs, path, buckets=buckets)
    opened = open_postings(docs, path)
    for word in ("the", "dog", "cat", "none"):
        assert ids(Search.over(opened).where(Word(word)).found()) == ids(Search.over(docs).where(Word(word)).found())
    assert corpus_stats(opened).collect() == corpus_stats(docs).collect()
    other = Collection("docs", docs.df.withColumn("title", F.lit("")), "id", ("title", "body"))
    with pytest.raises(ValueError, match="was written as"):
        open_postings(other, path)


def test_timestamps_are_seconds(spark, docs):
    seconds = {r.id: r.s for r in docs.df.select("id", F.unix_timestamp("ts").alias("s")).collect()}
    every = Search.over(docs)
    assert ids(every.filter_range("ts", seconds[1], seconds[2]).found()) == [1, 2]
    assert ids(every.filter_range("ts", seconds[1], seconds[2], exclude=True).found()) == [3]
    assert ids(every.filter_values("ts", [seconds[3]]).found()) == [3]
    assert ids(every.filter_values("flag", 1).found()) == [1]
    assert ids(every.filter_values("flag", 1, exclude=True).found()) == [2, 3]
    assert ids(every.filter_range("flag", 0, 1).found()) == [1, 2]


def test_magic_sort_names(docs):
    found = Search.over(docs).match("cat", "all").limits(0, 9)
    assert [r.id for r in found.sort_by("attr_desc", "@id").matches().collect()] == [3, 1]
    assert [r.id for r in found.sort_by("attr_asc", "@weight").matches().collect()] == [1, 3]


def test_repeated_ids_are_an_error(spark, docs):
    twice = spark.createDataFrame([(1, 50), (1, 60)], "id bigint, n bigint")
    with pytest.raises(Exception, match="two updates of id 1"):
        Search.over(docs).override_frame("n", twice).found().select("id").collect()
    with pytest.raises(Exception, match="two updates of id 1"):
        Search.over(update_attributes(docs, twice)).found().select("id").collect()
    with pytest.raises(Exception, match="two updates of id 1"):
        updated_count(docs, twice).collect()


def test_words_and_factors_of_several_collections(spark, docs):
    more = Collection("more", spark.createDataFrame([(9, "the cat sat")], "id bigint, body string"), "id", ("body",))
    both = Search.over(docs, more).where(And("the", "cat"))
    assert sorted((r.word, r.docs) for r in both.words().collect()) == [("cat", 3), ("the", 4)]
    assert sorted(r.id for r in both.factors().collect()) == [1, 3, 9]
    with pytest.raises(ValueError, match="no ranking factors"):
        Search.over(docs).factors()


def test_exact_words_are_counted_exactly(docs):
    formed = Collection("formed", docs.df, "id", ("body",), wordforms={"cats": "cat"})
    assert [(r.word, r.docs) for r in Search.over(formed).where(Word("cat", exact=True)).words().collect()] == [("cat", 2)]
    assert [(r.word, r.docs) for r in Search.over(formed).where(Word("cat")).words().collect()] == [("cat", 3)]


def test_a_query_table_is_not_cut(spark):
    many = spark.range(1200).select(F.col("id"), F.lit("same words").alias("body"))
    queries = spark.createDataFrame([(1, "same words")], "query_no bigint, text string")
    c = Collection("many", many, "id", ("body",))
    assert search_table(c, queries).count() == 1200
    assert search_table(c, queries, best=3).count() == 3
