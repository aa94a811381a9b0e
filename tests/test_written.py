"""Documents written as files and as word tables: what is written, and how often the texts are read for it."""

import os

from pyspark.sql import functions as F

from lexifacet import Collection
from lexifacet.plans import sources
from lexifacet.sources.postings import open_postings, write_postings
from lexifacet.sources.segments import add_documents, create_segments, open_segments


def test_pages_are_one_file_each_in_one_folder(spark, tmp_path, monkeypatch):
    rows = [(1, "One two\nthree\n"), (2, "nul \x00 inside"), (3, None), (4, ""), (5, "twice"), (5, "twice more"), (None, "x")]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(sources, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    found = sources.src_files(spark, str(tmp_path)).collect()
    want = spark.createDataFrame(rows, "page_id bigint, html string").select("page_id", F.md5(F.coalesce("html", F.lit("")))).collect()
    assert sorted((r.page_id or 0, r.digest) for r in found) == sorted((r[0] or 0, r[1]) for r in want)
    assert {r.page_id: r.n_tokens for r in found if r.page_id in (1, 2, 3, 4)} == {1: 3, 2: 2, 3: 0, 4: 0}
    files = [f for f in os.scandir(f"{tmp_path}/files") if not f.name.startswith((".", "_"))]
    assert len(files) == len(rows) and all(f.is_file() for f in files)


def counted(spark, rows):
    """A collection and the number of times one of its texts was read."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    df = spark.createDataFrame(rows, "id bigint, title string, raw string").withColumn("body", read("raw")).drop("raw")
    return Collection("c", df, "id", ("title", "body")), seen


ROWS = [(i, "red fox" if i % 2 else None, f"The fox, the w{i} and the red dog") for i in range(40)]


def test_texts_are_cut_once_for_words_and_their_counts(spark, tmp_path):
    c, seen = counted(spark, ROWS)
    write_postings(c, f"{tmp_path}/words", buckets=4)
    assert seen.value == 2 * len(ROWS)  # the other time for the lengths
    opened = open_postings(c, f"{tmp_path}/words")
    assert {tuple(r) for r in opened.terms().collect()} == {tuple(r) for r in c.terms().collect()}
    rows = opened.table("postings").where("id = 1").select("token", "field", "positions", "first").collect()
    assert {(r.token, r.field): (list(r.positions), r.first) for r in rows} == {
        ("red", 0): ([0], True), ("fox", 0): ([1], True), ("the", 1): ([0, 2, 5], True), ("fox", 1): ([1], False),
        ("w1", 1): ([3], True), ("and", 1): ([4], True), ("red", 1): ([6], False), ("dog", 1): ([7], True),
    }


def test_files_of_a_bucket_are_sorted_by_token(spark, tmp_path):
    write_postings(counted(spark, ROWS)[0], f"{tmp_path}/words", buckets=2)
    files = [f"{at}/{f}" for at, _, names in os.walk(f"{tmp_path}/words/postings") for f in names if f.endswith(".parquet")]
    for f in files:
        tokens = [r.token for r in spark.read.parquet(f).select("token").collect()]
        assert tokens == sorted(tokens)


def test_parts_cut_texts_once_and_exchange_no_positions(spark, tmp_path):
    c, seen = counted(spark, ROWS)
    create_segments(c, f"{tmp_path}/parts", 4)
    assert seen.value == 2 * len(ROWS)
    add_documents(counted(spark, ROWS[:10])[0], f"{tmp_path}/parts")
    now = open_segments(c, f"{tmp_path}/parts")
    assert {tuple(r) for r in now.terms().collect()} == {tuple(r) for r in c.terms().collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gone = now.terms_of_documents(now.df.where("id < 20").select("id"))
        plan = gone._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {tuple(r) for r in gone.collect()} == {tuple(r) for r in counted(spark, ROWS[:20])[0].terms().collect()}
    first_join = plan.splitlines().index(next(x for x in plan.splitlines() if "Join LeftSemi" in x))
    assert "size(positions" in "\n".join(plan.splitlines()[first_join:])
