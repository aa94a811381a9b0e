"""Search over a main and a later, smaller collection."""

from __future__ import annotations

from ..operators.merge import union_collections
from ..search import Search
from . import sql as S
from .registry import query
from .tables import LATER, documents, labelled, renamed

# The main collection holds all documents, the later one the labelled documents as they are now.
TWO = f"""{S.BASE},
later AS (
  SELECT doc_id, 0 AS field, regexp_extract_all(lower(title), '{S.WORD}') AS ts FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT doc_id, 1 AS field, regexp_extract_all(lower('{LATER}' || body), '{S.WORD}') AS ts FROM docs
  WHERE doc_id IN (SELECT doc_id FROM labels)),
later_post AS (SELECT doc_id, field, unnest(ts) AS tok, generate_subscripts(ts, 1) - 1 AS pos FROM later),
{S.lcs(['the', 'of'], 'l')},
{S.lcs(['the', 'of'], 'm', 'later_post')},
cnt AS (
  SELECT 0 AS ordinal, doc_id, field, count(DISTINCT tok) AS n FROM post WHERE tok IN ('the', 'of') GROUP BY ALL
  UNION ALL
  SELECT 1 AS ordinal, doc_id, field, count(DISTINCT tok) AS n FROM later_post WHERE tok IN ('the', 'of') GROUP BY ALL),
runs AS (SELECT 0 AS ordinal, * FROM l UNION ALL SELECT 1 AS ordinal, * FROM m),
every AS (
  SELECT c.doc_id, c.ordinal, sum(c.n + (r.lcs - 1) * 4)::BIGINT AS weight, any_value(d.n_chars) + c.ordinal AS n_chars
  FROM cnt c JOIN runs r ON r.ordinal = c.ordinal AND r.doc_id = c.doc_id AND r.field = c.field
  JOIN docs d ON d.doc_id = c.doc_id GROUP BY c.doc_id, c.ordinal)"""


def both(spark, sf_dir):
    return renamed(documents(spark, sf_dir), "main"), labelled(spark, sf_dir)


def search(spark, sf_dir) -> Search:
    return Search.over(*both(spark, sf_dir)).match("the of", "any")


@query("multi_union", f"WITH {TWO} SELECT doc_id, ordinal, weight, n_chars FROM every")
def multi_union(spark, sf_dir):
    collections = both(spark, sf_dir)
    parts = [Search.over(c).match("the of", "any").found() for c in collections]
    every = union_collections(parts, [c.name for c in collections])
    return every.select("doc_id", "ordinal", "weight", "n_chars")


@query(
    "multi_last_wins",
    f"""WITH {TWO}
SELECT doc_id, weight, n_chars FROM every QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ordinal DESC) = 1""",
)
def multi_last_wins(spark, sf_dir):
    return search(spark, sf_dir).found().select("doc_id", "weight", "n_chars")


@query(
    "multi_index_weights",
    f"""WITH {TWO}
SELECT doc_id, sum(weight * CASE ordinal WHEN 0 THEN 10 ELSE 100 END)::BIGINT AS weight,
       arg_max(n_chars, ordinal) AS n_chars
FROM every GROUP BY doc_id""",
)
def multi_index_weights(spark, sf_dir):
    s = search(spark, sf_dir).index_weights({"main": 10, "delta": 100})
    return s.found().select("doc_id", "weight", "n_chars")
