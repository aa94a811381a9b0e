"""Text analysis and keyword statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import keywords as K
from ..search import Search
from ..sources.collection import postings
from ..sources.literal import small_table
from . import sql as S
from .matching import FORMS
from .registry import query
from .tables import documents, table

# Words to ignore.
STOPWORDS = ["the", "of", "and", "to", "de", "la", "en"]


@query(
    "tokenize",
    f"""WITH {S.DOCS},
t AS (
  SELECT doc_id, regexp_extract_all(lower(title), '{S.WORD}') AS a, regexp_extract_all(lower(body), '{S.WORD}') AS b
  FROM docs)
SELECT doc_id, len(a)::INTEGER AS title_tokens, len(b)::INTEGER AS body_tokens,
       md5(array_to_string(a, ' ')) AS title_digest, md5(array_to_string(b, ' ')) AS body_digest
FROM t""",
)
def tokenize(spark, sf_dir):
    tokens = documents(spark, sf_dir).df.select(
        "doc_id", T.tokenize("title").alias("a"), T.tokenize("body").alias("b")
    )
    return tokens.select(
        "doc_id",
        F.size("a").alias("title_tokens"),
        F.size("b").alias("body_tokens"),
        F.md5(F.array_join("a", " ")).alias("title_digest"),
        F.md5(F.array_join("b", " ")).alias("body_digest"),
    )


@query(
    "tokenize_stopwords",
    f"""WITH {S.BASE}
SELECT doc_id, CASE field WHEN 0 THEN 'title' ELSE 'body' END AS field, count(*) AS kept,
       min(pos)::INTEGER AS first_pos, max(pos)::INTEGER AS last_pos, sum(pos)::BIGINT AS sum_pos
FROM post WHERE tok NOT IN ({S.quoted(STOPWORDS)}) GROUP BY doc_id, field""",
)
def tokenize_stopwords(spark, sf_dir):
    stop = small_table(spark, [("token", "string")], [(w,) for w in STOPWORDS])
    kept = K.without_stopwords(postings(documents(spark, sf_dir)), stop)
    return kept.groupBy("doc_id", "field").agg(
        F.count(F.lit(1)).alias("kept"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.sum("pos").alias("sum_pos"),
    )


@query(
    "tokenize_wordforms",
    f"""WITH {S.BASE},
forms(token, normal) AS (VALUES {S.values(list(FORMS.items()))})
SELECT coalesce(f.normal, p.tok) AS normalized, count(*) AS hits
FROM post p LEFT JOIN forms f ON f.token = p.tok GROUP BY 1""",
)
def tokenize_wordforms(spark, sf_dir):
    forms = small_table(spark, [("token", "string"), ("normal", "string")], FORMS.items())
    rows = K.with_wordforms(postings(documents(spark, sf_dir)), forms)
    return rows.groupBy("normalized").agg(F.count(F.lit(1)).alias("hits"))


@query(
    "wildcard_terms",
    f"""WITH {S.BASE}
SELECT tok AS token, count(DISTINCT doc_id) AS docs, count(*) AS hits
FROM post WHERE tok LIKE 'th%n' GROUP BY tok""",
)
def wildcard_terms(spark, sf_dir):
    return K.wildcard_terms(documents(spark, sf_dir), "th*n")


@query(
    "keywords",
    f"""WITH forms(token, normal) AS (VALUES {S.values(list(FORMS.items()))}),
t AS (SELECT item_id, regexp_extract_all(lower(text), '{S.WORD}') AS ts FROM benchmark),
w AS (SELECT item_id, unnest(ts) AS tok, generate_subscripts(ts, 1) - 1 AS qpos FROM t)
SELECT item_id, qpos::INTEGER AS qpos, tok AS tokenized, coalesce(f.normal, tok) AS normalized
FROM w LEFT JOIN forms f ON f.token = w.tok""",
)
def keywords(spark, sf_dir):
    forms = small_table(spark, [("token", "string"), ("normal", "string")], FORMS.items())
    return K.keywords(table(spark, sf_dir, "benchmark"), "item_id", "text", forms)


@query(
    "keyword_stats",
    f"""WITH {S.BASE},
asked AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{S.WORD}')) AS word FROM benchmark)
SELECT a.word, count(DISTINCT p.doc_id) AS docs, count(p.doc_id) AS hits
FROM asked a LEFT JOIN post p ON p.tok = a.word GROUP BY a.word""",
)
def keyword_stats(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(T.tokenize("text")).alias("word"))
    return K.keyword_stats(documents(spark, sf_dir), words)


@query(
    "result_words",
    f"""WITH {S.BASE},
asked(word) AS (VALUES ('the'), ('license'), ('zzzz'))
SELECT a.word, count(DISTINCT p.doc_id) AS docs, count(p.doc_id) AS hits
FROM asked a LEFT JOIN post p ON p.tok = a.word GROUP BY a.word""",
)
def result_words(spark, sf_dir):
    return Search.over(documents(spark, sf_dir)).match("the license zzzz").words()


@query(
    "escape_text",
    r"""SELECT page_id, regexp_replace(html, '([\\()|\-!@~"&/^$=])', '\\\1', 'g') AS escaped FROM pages""",
)
def escape_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.escape_query("html").alias("escaped"))


@query(
    "corpus_stats",
    f"""WITH {S.BASE}
SELECT (SELECT count(*) FROM documents) AS n_docs, sum(len(ts))::BIGINT AS n_tokens,
       sum(len(ts)) FILTER (field = 0)::BIGINT AS title_tokens,
       round(avg(len(ts)) FILTER (field = 0), 6) AS title_mean_len,
       sum(len(ts)) FILTER (field = 1)::BIGINT AS body_tokens,
       round(avg(len(ts)) FILTER (field = 1), 6) AS body_mean_len
FROM toks""",
)
def corpus_stats(spark, sf_dir):
    stats = K.corpus_stats(documents(spark, sf_dir))
    means = {c: F.round(c, 6) for c in stats.columns if c.endswith("_mean_len")}
    return stats.withColumns(means)
