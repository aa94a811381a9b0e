"""Word tables that grow and statistics that are kept, against what is computed anew."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexifacet import And, Collection, Or, Search, Word
from lexifacet.operators.keywords import corpus_stats, keyword_stats, word_stats
from lexifacet.sources import manifest
from lexifacet.sources.postings import bucket_of
from lexifacet.sources.segments import add_documents, compact, create_segments, delete_documents, open_segments
from lexifacet.sources.statistics import add_statistics, merge_statistics, open_statistics, remove_statistics, write_statistics

ROWS = [
    (1, "red fox", "the quick red fox jumps over the lazy dog", 10),
    (2, "blue whale", "the whale is blue and the sea is blue too", 20),
    (3, None, "a fox in the snow, fox!", 30),
    (4, "empty", None, 40),
    (5, "dog days", "dogs and foxes and the dog", 50),
]
MORE = [(3, "snow", "no more of them", 31), (6, "a new fox", "the fox is new", 60), (7, "", "", None)]
SCHEMA = "id bigint, title string, body string, size bigint"


def collection(spark, rows):
    return Collection("c", spark.createDataFrame(rows, SCHEMA), "id", ("title", "body"), ("size",), wordforms={"foxes": "fox", "dogs": "dog"})


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def same(a, b, spark):
    """Both collections give the same answers."""
    for tree in (Or("the", "fox"), And("the", "dog"), Or(Word("fo*"), "blue"), And("new", "fox"), Or("nowhere")):
        for ranker in ("proximity_bm25", "bm25", "wordcount"):
            x, y = (Search.over(c).where(tree).rank(ranker).found().select("id", "weight", "size") for c in (a, b))
            assert rows_of(x) == rows_of(y)
    words = [Word("fox"), Word("the"), Word("blue"), Word("d*"), Word("nowhere")]
    assert rows_of(word_stats(a, words)) == rows_of(word_stats(b, words))
    asked = spark.createDataFrame([("fox",), ("the",), ("snow",), ("nowhere",)], "word string")
    assert rows_of(keyword_stats(a, asked)) == rows_of(keyword_stats(b, asked))
    assert [tuple(r) for r in corpus_stats(a).collect()] == [tuple(r) for r in corpus_stats(b).collect()]
    assert rows_of(a.terms().select("token", "docs", "hits")) == rows_of(b.terms().select("token", "docs", "hits"))


def after(changes, gone=()):
    kept = {r[0]: r for r in ROWS}
    kept.update({r[0]: r for r in changes})
    return [r for i, r in kept.items() if i not in gone]


def test_segments_equal_tables_written_anew(spark, tmp_path):
    path = f"{tmp_path}/segments"
    base = collection(spark, ROWS)
    create_segments(base, path, buckets=4)
    same(open_segments(base, path), base, spark)
    add_documents(collection(spark, MORE), path)
    same(open_segments(base, path), collection(spark, after(MORE)), spark)
    delete_documents(base, path, spark.createDataFrame([(1,), (99,), (6,)], "id bigint"))
    want = collection(spark, after(MORE, {1, 6}))
    before = open_segments(base, path)
    same(before, want, spark)
    compact(base, path)
    same(open_segments(base, path), want, spark)
    # A reader that was opened before sees what it saw.
    assert rows_of(before.table("postings").select("id", "token")) == rows_of(open_segments(base, path).table("postings").select("id", "token"))
    add_documents(collection(spark, [(1, "back", "the fox again", 1)]), path)
    same(open_segments(base, path), collection(spark, [*after(MORE, {1, 6}), (1, "back", "the fox again", 1)]), spark)


def test_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/segments"
    buckets = 64
    rows = [(i, f"w{i}", f"x{i} y{i}", i) for i in range(300)]
    base = collection(spark, rows)
    create_segments(base, path, buckets)
    delete_documents(base, path, spark.createDataFrame([(7,)], "id bigint"))
    compact(base, path)
    last = manifest.commits(spark, path)[-1]
    tokens = spark.createDataFrame([("w7",), ("x7",), ("y7",)], "t string").select(bucket_of(F.col("t"), buckets)).collect()
    assert last.kind == "compacted" and {b for b in last.buckets if b < buckets} == {r[0] for r in tokens}
    now = open_segments(base, path)
    assert not now.deletions() and now.df.count() == 299
    assert now.table("postings").where("token in ('w7', 'x7', 'y7')").count() == 0
    compact(base, path)
    assert manifest.commits(spark, path)[-1] == last


def test_other_settings_are_an_error(spark, tmp_path):
    base = collection(spark, ROWS)
    create_segments(base, f"{tmp_path}/a", 4)
    write_statistics(base, f"{tmp_path}/b", 4)
    other = replace(base, fields=("body",))
    with pytest.raises(ValueError):
        open_segments(other, f"{tmp_path}/a")
    with pytest.raises(ValueError):
        open_statistics(other, f"{tmp_path}/b")


def test_kept_statistics_equal_counted_ones(spark, tmp_path):
    path = f"{tmp_path}/statistics"
    write_statistics(collection(spark, ROWS), path, buckets=4)
    add_statistics(collection(spark, [MORE[1], MORE[2]]), path)
    remove_statistics(collection(spark, [ROWS[0]]), path)
    want = collection(spark, [*ROWS[1:], *MORE[1:]])
    same(open_statistics(want, path), want, spark)
    merge_statistics(want, path)
    assert [p.kind for p in manifest.live(spark, path)] == ["merged"]
    same(open_statistics(want, path), want, spark)


def test_ranking_with_kept_statistics_reads_the_texts_once(spark, tmp_path):
    source = f"{tmp_path}/rows"
    collection(spark, ROWS).df.write.parquet(source)
    c = replace(collection(spark, ROWS), df=spark.read.parquet(source), wordforms={})
    write_statistics(c, f"{tmp_path}/statistics", buckets=4)
    counted = open_statistics(c, f"{tmp_path}/statistics")

    def scans(c):
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
        text = Search.over(c).where(Or("the", "fox")).rank("proximity_bm25").found()._jdf.queryExecution().executedPlan().toString()
        return text.count(f"{source}]")

    assert scans(c) == 2 and scans(counted) == 1
