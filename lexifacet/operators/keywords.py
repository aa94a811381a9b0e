"""Keyword extraction and collection-wide word statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.frames import compute_once
from ..sources.collection import Collection
from ..sources.statistics import CountedCollection
from .match import Word


def without_stopwords(postings: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Postings minus a (token) table; the remaining positions keep their gaps."""
    return postings.join(stopwords.select("token"), "token", "left_anti").select(*postings.columns)


def with_wordforms(postings: DataFrame, wordforms: DataFrame, column: str = "token") -> DataFrame:
    """Add ``normalized``: the normal form by a (token, normal) table, else the token."""
    forms = wordforms.select(F.col("token").alias("_form"), "normal")
    joined = postings.join(forms, postings[column] == forms["_form"], "left")
    return joined.withColumn("normalized", F.coalesce("normal", column)).drop("_form", "normal")


def wildcard_terms(collection: Collection, pattern: str) -> DataFrame:
    """(token, docs, hits) of the tokens a ``*`` pattern stands for."""
    return collection.terms(Word(pattern).test(collection))


def keywords(queries: DataFrame, query_no: str, text: str, wordforms: DataFrame | None = None) -> DataFrame:
    """(query_no, qpos, tokenized, normalized) of a table of query texts."""
    rows = queries.select(query_no, F.posexplode(T.tokenize(text)).alias("qpos", "tokenized"))
    if wordforms is None:
        return rows.withColumn("normalized", F.col("tokenized"))
    return with_wordforms(rows, wordforms, "tokenized")


def word_stats(collection: Collection, words: Sequence[str | Word]) -> DataFrame:
    """(word, docs, hits) of a few given words over the whole collection.

    One aggregate row holds all counters; absent words report 0 and 0.
    """
    by_text = {}
    for w in (Word(w) if isinstance(w, str) else w for w in words):
        by_text.setdefault(w.text, w)
    words = list(by_text)
    one = collection.word_totals([w.test(collection) for w in by_text.values()])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(w).alias("word"),
                        F.col(f"docs_{k}").alias("docs"),
                        F.col(f"hits_{k}").alias("hits"),
                    )
                    for k, w in enumerate(words)
                ]
            )
        )
    )


def keyword_stats(collection: Collection, wanted: DataFrame) -> DataFrame:
    """(word, docs, hits) for a table of words of any size.

    Documents leave out what is not asked before anything is counted, and tokens are counted
    before the join, which so meets one row per token even where one token makes up a third
    of all text.
    """
    asked = wanted.select(F.col("word")).distinct()
    table = collection.terms_of(asked.select(F.col("word").alias("token"))).withColumnRenamed("token", "word")
    joined = asked.join(table, "word", "left")
    return joined.select("word", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("hits", F.lit(0)).alias("hits"))


def corpus_stats(collection: Collection) -> DataFrame:
    """One row: documents, tokens, and per field its tokens and mean length."""
    lengths = [f"_len_{i}" for i in range(len(collection.fields))]
    if isinstance(collection, CountedCollection):
        total = sum(F.col(c) for c in lengths).alias("n_tokens")
        each = [(F.col(c).alias(f"{f}_tokens"), F.when(F.col("n_docs") > 0, F.col(c) / F.col("n_docs")).alias(f"{f}_mean_len")) for c, f in zip(lengths, collection.fields)]
        return collection.sizes().select("n_docs", total, *[x for pair in each for x in pair])
    if all(c in collection.df.columns for c in lengths):  # a written word table
        rows = collection.df.select(*lengths)
    else:
        counted = {c: F.size(T.tokenize(f)) for c, f in zip(lengths, collection.fields)}
        rows = compute_once(collection.df.select(*collection.fields), counted)
    columns = [F.count(F.lit(1)).alias("n_docs"), F.sum(sum(F.col(c) for c in lengths)).alias("n_tokens")]
    for i, f in enumerate(collection.fields):
        columns.append(F.sum(f"_len_{i}").alias(f"{f}_tokens"))
        columns.append(F.avg(f"_len_{i}").alias(f"{f}_mean_len"))
    return rows.agg(*columns)
