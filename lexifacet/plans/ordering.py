"""Sort modes, pages and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..search import Search
from . import sql as S
from .registry import query
from .tables import documents, events, orders

FOUND = S.found(["the", "of"])
ROWS = f"""WITH {FOUND}, r AS (
  SELECT f.doc_id, f.weight, d.n_chars, d.lang FROM f JOIN docs d ON d.doc_id = f.doc_id)"""


def search(spark, sf_dir) -> Search:
    return Search.over(documents(spark, sf_dir)).match("the of")


def page(s: Search):
    return s.matches().select("doc_id", "weight", "n_chars")


@query("sort_relevance", f"{ROWS} SELECT doc_id, weight, n_chars FROM r ORDER BY weight DESC, doc_id LIMIT 100")
def sort_relevance(spark, sf_dir):
    return page(search(spark, sf_dir).limits(0, 100))


@query("sort_attr_desc", f"{ROWS} SELECT doc_id, weight, n_chars FROM r ORDER BY n_chars DESC, weight DESC, doc_id LIMIT 100")
def sort_attr_desc(spark, sf_dir):
    return page(search(spark, sf_dir).sort_by("attr_desc", "n_chars").limits(0, 100))


@query("sort_attr_asc", f"{ROWS} SELECT doc_id, weight, n_chars FROM r ORDER BY n_chars, weight DESC, doc_id LIMIT 100")
def sort_attr_asc(spark, sf_dir):
    return page(search(spark, sf_dir).sort_by("attr_asc", "n_chars").limits(0, 100))


# Fixed value: the moment time segments are counted from.
NOW = "2024-01-31 00:00:00"


@query(
    "sort_time_segments",
    f"""WITH a AS (
  SELECT event_id, ts, date_part('epoch', TIMESTAMP '{NOW}') - floor(date_part('epoch', ts)) AS age FROM events),
s AS (
  SELECT event_id, ts, CASE WHEN age <= 3600 THEN 5 WHEN age <= 86400 THEN 4 WHEN age <= 7 * 86400 THEN 3
    WHEN age <= 30 * 86400 THEN 2 WHEN age <= 90 * 86400 THEN 1 ELSE 0 END AS time_segment FROM a)
SELECT event_id, 1::BIGINT AS weight, time_segment FROM s ORDER BY time_segment DESC, ts DESC, event_id LIMIT 1000""",
)
def sort_time_segments(spark, sf_dir):
    s = Search.over(events(spark, sf_dir)).everything().sort_by("time_segments", "ts", NOW)
    return s.limits(0, 1000).matches().select("event_id", "weight", "time_segment")


@query(
    "sort_extended",
    f"{ROWS} SELECT doc_id, weight, n_chars FROM r ORDER BY weight DESC, n_chars ASC, doc_id DESC LIMIT 100",
)
def sort_extended(spark, sf_dir):
    s = search(spark, sf_dir).sort_by("extended", "@relevance DESC, n_chars ASC, @id DESC")
    return page(s.limits(0, 100))


@query(
    "sort_expr",
    f"""{ROWS}, e AS (SELECT *, doc_id + greatest(weight, 2) * 500 + round(ln(n_chars + 1), 6) AS x FROM r)
SELECT doc_id, weight, round(x, 6) AS sort_expr FROM e ORDER BY x DESC, doc_id LIMIT 100""",
)
def sort_expr(spark, sf_dir):
    s = search(spark, sf_dir).sort_by("expr", "@id + greatest(@weight, 2) * 500 + round(ln(n_chars + 1), 6)")
    rows = s.limits(0, 100).matches()
    return rows.select("doc_id", "weight", F.round("sort_expr", 6).alias("sort_expr"))


@query("limit_offset", f"{ROWS} SELECT doc_id, weight, n_chars FROM r ORDER BY weight DESC, doc_id LIMIT 30 OFFSET 40")
def limit_offset(spark, sf_dir):
    return page(search(spark, sf_dir).limits(40, 30))


@query(
    "limit_max_matches",
    f"""{ROWS}, top AS (SELECT * FROM r ORDER BY weight DESC, doc_id LIMIT 60)
SELECT doc_id, weight, n_chars FROM top ORDER BY weight DESC, doc_id LIMIT 30 OFFSET 45""",
)
def limit_max_matches(spark, sf_dir):
    return page(search(spark, sf_dir).limits(45, 30, 60))


@query(
    "limit_cutoff",
    f"""{ROWS}, head AS (SELECT * FROM r ORDER BY doc_id LIMIT 200)
SELECT doc_id, weight, n_chars FROM head ORDER BY weight DESC, doc_id LIMIT 30""",
)
def limit_cutoff(spark, sf_dir):
    return page(search(spark, sf_dir).limits(0, 30, 1000, 200))


@query("totals", f"{ROWS} SELECT least(count(*), 100)::BIGINT AS total, count(*) AS total_found FROM r")
def totals(spark, sf_dir):
    return search(spark, sf_dir).limits(0, 20, 100).totals()


@query(
    "outer_select",
    f"""{ROWS}, top AS (SELECT * FROM r ORDER BY weight DESC, doc_id LIMIT 80)
SELECT doc_id, weight, n_chars FROM top ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 5""",
)
def outer_select(spark, sf_dir):
    s = search(spark, sf_dir).limits(0, 20, 80).outer_select("n_chars DESC", 5, 20)
    return page(s)


@query(
    "sort_text_attr",
    """SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY o_orderpriority DESC, o_orderstatus ASC, o_totalprice DESC, o_orderkey LIMIT 50""",
)
def sort_text_attr(spark, sf_dir):
    s = Search.over(orders(spark, sf_dir)).everything()
    s = s.sort_by("extended", "o_orderpriority DESC, o_orderstatus ASC, o_totalprice DESC")
    return s.limits(0, 50).matches().select("o_orderkey", "o_orderpriority")
