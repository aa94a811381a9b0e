"""What the plans must look like, whatever the size of the tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexifacet.plans import QUERIES
from lexifacet import And, Collection, Or, Search
from lexifacet.operators.updates import update_attributes
from lexifacet.plans.tables import documents, orders
from lexifacet.sources.postings import open_postings, write_postings
from lexifacet.sources.storage import new_folder

SF_DIR = "/root/testdata/sf0.001"
# These write files while they are built; their parts are looked at one by one.
WRITES = {"group_distinct_rollup", "postings_delta", "postings_compacted", "rank_bm25_stored", "rank_proximity_bm25_stored"}
WRITES |= {"src_files", "src_xml", "postings_search", "sink_attrs", "attr_ordinal", "batch_shared"}


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text
    # A window names its partition keys in the second bracket; an empty one is a single task.
    for line in text.splitlines():
        if re.search(r"\bWindow(GroupLimit)? \[", line):
            assert "], [], " not in line, line


def test_match_and_page_need_no_exchange(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    c = Collection("docs", df, "doc_id", ("text",), ("lang",))
    text = plan(Search.over(c).match("the of").matches())
    assert "Exchange" not in text
    assert "TakeOrderedAndProject" in text
    # The text is tokenized in one place only.
    assert text.count("regexp_extract_all") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text


def test_filters_and_columns_reach_the_scan(spark):
    s = Search.over(orders(spark, SF_DIR)).everything().filter_range("o_custkey", 5, 9).id_range(1, 500)
    text = plan(s.select("o_orderstatus").listed())
    assert "GreaterThanOrEqual(o_custkey,5), LessThanOrEqual(o_custkey,9)" in text
    assert "GreaterThanOrEqual(o_orderkey,1)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text


def test_groups_combine_before_one_exchange(spark):
    s = Search.over(orders(spark, SF_DIR)).everything().group_by("o_orderstatus")
    text = plan(s.groups())
    assert text.count("Exchange") == 1
    assert "partial_min_by" in text.split("Exchange")[1]


@pytest.mark.parametrize("name", ["group_attr", "group_best_by_text"])
def test_groups_read_only_what_is_wanted(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    schemas = {
        "group_attr": "struct<o_orderkey:bigint,o_custkey:bigint>",
        "group_best_by_text": "o_totalprice",
    }
    if name == "group_attr":
        assert set(re.findall(r"ReadSchema: (\S+>)", text)) == {schemas[name]}
    else:
        assert schemas[name] not in text


def test_merged_collections_read_only_what_is_wanted(spark):
    c = orders(spark, SF_DIR)
    text = plan(Search.over(c, c).everything().found().select("o_orderkey", "o_orderstatus"))
    assert set(re.findall(r"ReadSchema: (\S+>)", text)) == {"struct<o_orderkey:bigint,o_orderstatus:string>"}


def test_a_cutoff_sends_only_ids_to_one_task(spark):
    c = documents(spark, SF_DIR)
    text = plan(Search.over(c).match("the of").limits(0, 5, cutoff=7).found())
    for line in text.splitlines():
        if "TakeOrderedAndProject" in line:
            assert re.search(r"output=\[doc_id#\d+L?\]", line), line
    assert "Subquery" in text


def test_texts_do_not_go_through_the_exchange_of_an_attribute_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        c = Collection("docs", df, "doc_id", ("text",), ("lang", "n_chars"))
        new = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", F.col("quality").alias("n_chars"))
        c = update_attributes(c, new)
        text = plan(Search.over(c).match("the of").filter_range("n_chars", 0, 5).found())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    # Below each exchange of the document side the text is already reduced to hits.
    tokenized = text.index("regexp_extract_all(lower(coalesce(text")
    assert text.rindex("Exchange", 0, tokenized) < text.index("Generate inline")


def test_a_written_word_table_reads_only_its_buckets(spark):
    c = documents(spark, SF_DIR)
    path = new_folder(spark, "plan")
    write_postings(c, path, buckets=8)
    text = plan(Search.over(open_postings(c, path)).where(And("license", "the")).found())
    assert "regexp_extract_all" not in text
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN \(\d+,\d+\)\]", text)
    assert "PushedFilters: [In(token, [license,the])" in text


def test_bm25_statistics_are_one_row(spark):
    text = plan(Search.over(documents(spark, SF_DIR)).where(Or("the", "of")).rank("bm25").found())
    assert "Subquery" in text and "Join" not in text


@pytest.mark.parametrize("name", ["tokenize_stopwords", "tokenize_wordforms"])
def test_small_word_tables_are_broadcast_by_their_known_size(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_literal_overrides_are_broadcast_by_their_known_size(spark):
    s = Search.over(orders(spark, SF_DIR)).everything().override("o_custkey", "integer", {1: 5, 2: 6})
    assert "BroadcastHashJoin" in plan(s.found())


def test_a_page_of_groups_reads_what_it_shows(spark):
    s = Search.over(orders(spark, SF_DIR)).everything().group_by("o_custkey", "attr", "@count DESC")
    text = plan(s.select("@id").matches())
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    text = plan(s.select("@id", "o_totalprice").matches())
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:" in text
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(s.totals())


def test_narrow_pages_of_groups_equal_wide_ones(spark):
    s = Search.over(orders(spark, SF_DIR)).everything().group_by("o_custkey", "attr", "@count DESC, o_totalprice DESC").sort_by("attr_desc", "o_totalprice")
    s = s.group_select(total=F.round(F.sum("o_totalprice"), 2))
    columns = ["o_orderkey", "weight", "o_orderdate", "group_key", "group_count", "total"]
    narrow = s.select("o_orderdate", "AVG(o_totalprice) AS mean").matches()
    assert set(narrow.columns) == {*columns, "mean"}
    assert narrow.select(columns).collect() == s.matches().select(columns).collect()
    outer = s.select("@id").outer_select("o_custkey ASC", 0, 5)
    assert outer.matches().collect() == s.outer_select("o_custkey ASC", 0, 5).matches().select(outer.matches().columns).collect()
