"""Attribute updates, ordinals and batches of queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batch as B
from ..operators import updates as U
from ..search import Search
from ..sources.catalog import Catalog
from . import sql as S
from .registry import query
from .tables import documents, labelled, renamed, short_list, table


def new_sizes(spark, sf_dir):
    """Updates made from the labels, as many again for ids that do not exist."""
    labels = table(spark, sf_dir, "labels")
    known = labels.select("doc_id", (F.col("quality") * 1000 + F.col("toxic")).alias("n_chars"))
    unknown = labels.select((-F.col("doc_id") - 1).alias("doc_id"), F.lit(0).alias("n_chars"))
    return known.unionByName(unknown)


NEW_SIZE = "coalesce(l.quality * 1000 + l.toxic, d.n_chars)::BIGINT"
LABELLED = "documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"


@query("update_attrs", f"SELECT d.doc_id, d.lang, {NEW_SIZE} AS n_chars FROM {LABELLED}")
def update_attrs(spark, sf_dir):
    c = U.update_attributes(documents(spark, sf_dir), new_sizes(spark, sf_dir))
    return c.attributes().select("doc_id", "lang", "n_chars")


@query("update_count", "SELECT count(*) AS n_updated FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def update_count(spark, sf_dir):
    return U.updated_count(documents(spark, sf_dir), new_sizes(spark, sf_dir))


@query(
    "update_mva",
    f"""WITH {S.DOCS}
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN array_to_string(d.tags, ',')
       WHEN l.quality = l.toxic THEN '' || l.quality || ',9'
       ELSE least(l.quality, l.toxic) || ',' || greatest(l.quality, l.toxic) || ',9' END AS tags
FROM docs d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def update_mva(spark, sf_dir):
    new = F.array(F.lit(9), F.col("quality"), F.col("toxic"), F.lit(9)).alias("tags")
    updates = table(spark, sf_dir, "labels").select("doc_id", new)
    c = U.update_attributes(documents(spark, sf_dir), updates)
    return c.attributes().select("doc_id", short_list("tags").alias("tags"))


@query("update_ignore_missing", f"SELECT d.doc_id, {NEW_SIZE} AS n_chars FROM {LABELLED}")
def update_ignore_missing(spark, sf_dir):
    updates = new_sizes(spark, sf_dir).withColumn("no_such_attribute", F.lit(1))
    c = U.update_attributes(documents(spark, sf_dir), updates, ignore_missing=True)
    return c.attributes().select("doc_id", "n_chars")


@query("update_multi", "SELECT (count(*) * 2)::BIGINT AS n_updated FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def update_multi(spark, sf_dir):
    both = [renamed(documents(spark, sf_dir), "main"), labelled(spark, sf_dir)]
    return U.update_many(both, new_sizes(spark, sf_dir))[1]


@query(
    "attr_ordinal",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name)::BIGINT AS ordinal FROM customer",
)
def attr_ordinal(spark, sf_dir):
    ranked = U.with_ordinal(table(spark, sf_dir, "customer"), "c_name", "ordinal")
    return ranked.select("c_custkey", "ordinal")


@query(
    "batch_facets",
    f"""WITH {S.found(['the', 'of'])},
r AS (SELECT f.doc_id, f.weight, d.lang, d.source, d.tags FROM f JOIN docs d ON d.doc_id = f.doc_id),
k AS (
  SELECT 0 AS query_no, lang AS group_key, doc_id, weight FROM r
  UNION ALL SELECT 1, source, doc_id, weight FROM r
  UNION ALL SELECT 2, unnest(tags)::VARCHAR, doc_id, weight FROM r)
SELECT query_no, group_key, count(*) AS group_count, arg_min(doc_id, doc_id - weight * 10000000) AS doc_id,
       max(weight) AS weight
FROM k GROUP BY 1, 2""",
)
def batch_facets(spark, sf_dir):
    found = Search.over(documents(spark, sf_dir)).match("the of").found()
    return B.facets(found, "doc_id", [("lang", "attr"), ("source", "attr"), ("tags", "attr")])


@query(
    "batch_facets_sorted",
    f"""WITH {S.found(['the', 'of'])},
r AS (SELECT f.doc_id, f.weight, d.lang, d.source, d.tags FROM f JOIN docs d ON d.doc_id = f.doc_id),
k AS (
  SELECT 0 AS query_no, lang AS group_key, doc_id, weight, source AS v FROM r
  UNION ALL SELECT 1, source, doc_id, weight, NULL FROM r
  UNION ALL SELECT 2, unnest(tags)::VARCHAR, doc_id, weight, NULL FROM r),
g AS (
  SELECT query_no, group_key, count(*) AS group_count, arg_min(doc_id, doc_id - weight * 10000000) AS doc_id,
         max(weight) AS weight, CASE WHEN query_no = 0 THEN count(DISTINCT v) ELSE 0 END AS group_distinct
  FROM k GROUP BY 1, 2),
p AS (
  SELECT 0 AS query_no, group_key, row_number() OVER (ORDER BY group_count DESC, group_key) AS place FROM g WHERE query_no = 0
  UNION ALL SELECT 2, group_key, row_number() OVER (ORDER BY group_key::BIGINT DESC) FROM g WHERE query_no = 2)
SELECT g.*, coalesce(p.place, 0)::BIGINT AS place FROM g LEFT JOIN p ON p.query_no = g.query_no AND p.group_key IS NOT DISTINCT FROM g.group_key
WHERE g.query_no = 1 OR (g.query_no = 0 AND p.place <= 3) OR (g.query_no = 2 AND p.place <= 5)""",
)
def batch_facets_sorted(spark, sf_dir):
    """Each facet with an order, a limit and a distinct count of its own, in one pass."""
    found = Search.over(documents(spark, sf_dir)).match("the of").found()
    wanted = [B.Facet("lang", sort="@count desc", limit=3, distinct="source"), B.Facet("source"), B.Facet("tags", limit=5)]
    shown = B.facets(found, "doc_id", wanted)
    return shown.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("group_distinct", "place")})


@query(
    "batch_shared",
    f"""WITH {S.found(['the', 'of'])},
r AS (SELECT f.doc_id, f.weight, d.lang, d.n_chars FROM f JOIN docs d ON d.doc_id = f.doc_id),
a AS (SELECT 0 AS query_no, doc_id, weight FROM r ORDER BY weight DESC, doc_id LIMIT 20),
b AS (SELECT 1 AS query_no, doc_id, weight FROM r ORDER BY n_chars DESC, weight DESC, doc_id LIMIT 20),
c AS (
  SELECT 2 AS query_no, doc_id, weight FROM r
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY weight DESC, doc_id) = 1)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""",
)
def batch_shared(spark, sf_dir):
    """Two orders and a grouping over one stored match."""
    s = Search.over(documents(spark, sf_dir)).match("the of").limits(0, 20)
    found = B.stored(s.found())
    variants = [s, s.sort_by("attr_desc", "n_chars"), s.group_by("lang")]
    pages = [v.matches(found) for v in variants]
    return B.batch_matches(pages, ["doc_id", "weight"])


@query(
    "batch_queries",
    f"""WITH {S.BASE},
bt AS (SELECT item_id AS query_no, regexp_extract_all(lower(text), '{S.WORD}') AS ts FROM benchmark),
bw AS (SELECT query_no, unnest(ts) AS tok, generate_subscripts(ts, 1) AS k FROM bt),
bf AS (SELECT query_no, tok, min(k) AS k FROM bw GROUP BY 1, 2),
bq AS (SELECT query_no, tok, row_number() OVER (PARTITION BY query_no ORDER BY k) - 1 AS qpos FROM bf),
need AS (SELECT query_no, count(DISTINCT tok) AS n FROM bq GROUP BY 1),
h AS (
  SELECT q.query_no, p.doc_id, p.field, q.qpos, p.tok, p.pos - q.qpos AS d FROM post p JOIN bq q ON q.tok = p.tok),
m AS (
  SELECT h.query_no, h.doc_id FROM h JOIN need ON need.query_no = h.query_no
  GROUP BY 1, 2 HAVING count(DISTINCT h.tok) = any_value(need.n)),
i AS (
  SELECT h.query_no, h.doc_id, h.field, h.d,
         h.qpos - row_number() OVER (PARTITION BY h.query_no, h.doc_id, h.field, h.d ORDER BY h.qpos) AS isl
  FROM h JOIN m ON m.query_no = h.query_no AND m.doc_id = h.doc_id),
r AS (SELECT query_no, doc_id, field, d, isl, count(*) AS n FROM i GROUP BY ALL),
w AS (SELECT query_no, doc_id, field, max(n) AS lcs FROM r GROUP BY ALL),
t AS (SELECT query_no, doc_id, sum(lcs)::BIGINT AS weight FROM w GROUP BY 1, 2)
SELECT query_no, doc_id, weight FROM t
QUALIFY row_number() OVER (PARTITION BY query_no ORDER BY weight DESC, doc_id) <= 10""",
)
def batch_queries(spark, sf_dir):
    queries = table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_no")
    return B.search_table(documents(spark, sf_dir), queries, best=10)


@query(
    "batch_errors",
    f"""WITH {S.found(['the', 'of'])}
SELECT 0 AS query_no, '' AS error, least(count(*), 1000)::BIGINT AS total, count(*) AS total_found FROM f
UNION ALL SELECT 1, 'unknown collection nowhere', -1, -1
UNION ALL SELECT 2, 'no such attribute: no_such_attribute', -1, -1""",
)
def batch_errors(spark, sf_dir):
    catalog = Catalog(documents(spark, sf_dir))
    outcomes = B.run_batch(
        [
            lambda: Search.over(*catalog.pick("docs")).match("the of").totals(),
            lambda: Search.over(*catalog.pick("nowhere")).match("the of").totals(),
            lambda: Search.over(*catalog.pick("*")).match("the").filter_values("no_such_attribute", 1).totals(),
        ]
    )
    good = B.batch_matches(outcomes, ["total", "total_found"]).withColumn("error", F.lit(""))
    none = F.lit(-1).cast("long")
    bad = B.batch_errors(spark, outcomes).filter("error IS NOT NULL")
    return good.unionByName(bad.withColumns({"total": none, "total_found": none}))
