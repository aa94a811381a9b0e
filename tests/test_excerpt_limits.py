"""Excerpts stay within their limits, and cut a long passage at its best window."""

import re

import pytest
from pyspark.sql import functions as F

from lexifacet.operators.excerpts import build_excerpts, build_passages

SF_DIR = "/root/testdata/sf0.001"
OPTIONS = [
    {},
    {"around": 0},
    {"limit": 60, "around": 12},
    {"limit": 10},
    {"limit": 3},
    {"single_passage": True},
    {"use_boundaries": True, "limit": 90},
    {"weight_order": True, "chunk_separator": " | "},
    {"limit_words": 7},
    {"limit_passages": 2, "limit": 120},
]


def plain(snippet):
    return snippet.replace("\x01", "").replace("\x02", "")


@pytest.mark.parametrize("options", OPTIONS)
def test_no_excerpt_is_longer_than_its_limit(spark, options):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = build_excerpts(docs, "doc_id", "text", "the license la", before_match="\x01", after_match="\x02", **options)
    rows = made.join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) >= 200
    separator = options.get("chunk_separator", " ... ")
    for r in rows:
        text = plain(r.snippet)
        assert len(text) <= options.get("limit", 256)
        for passage in r.snippet.split(separator) if "\x01" in r.snippet else []:
            assert plain(passage) in r.text
            words = re.findall(r"[\w]+", plain(passage))
            assert len(words) <= options.get("limit_words", 10**9)


def snippet(spark, text, words, **options):
    df = spark.createDataFrame([(1, text)], "id bigint, text string")
    return build_excerpts(df, "id", "text", words, **options).first().snippet


def test_the_best_window_of_a_long_passage(spark):
    # One passage of 12 hits; of its windows the one with both words is best.
    text = " ".join(["aa x"] * 6 + ["bb aa"] + ["aa x"] * 6)
    assert snippet(spark, text, "aa bb", limit=14, around=1) == "x <b>aa</b> x <b>bb</b> <b>aa</b>"
    # A hit whose context does not fit stands alone; one that does not fit is left out.
    assert snippet(spark, "somewhat longer aa surroundings", "aa", limit=5, around=2) == "<b>aa</b>"
    assert snippet(spark, "so longer surroundings", "surroundings", limit=5, around=2) == "so"
    assert snippet(spark, "so longer surroundings", "surroundings", limit=5, around=2, allow_empty=True) == ""


def test_force_all_words_may_pass_the_limit(spark):
    text = "aa " + "x " * 40 + "bb " + "x " * 40
    assert snippet(spark, text, "aa bb", limit=6, around=1, force_all_words=True) == "<b>aa</b> x ... x <b>bb</b> x"


def test_passages_as_rows_stay_within_the_limit(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = build_passages(docs, "doc_id", "text", "the license la", limit=80, before_match="", after_match="")
    sums = rows.groupBy("doc_id").agg(F.sum(F.length("passage")).alias("n"), F.count("*").alias("k"))
    assert sums.where("n + 5 * (k - 1) > 80").count() == 0 and sums.count() > 100
