"""Rankers, ranking factors and field weights."""

from __future__ import annotations

from dataclasses import replace

from ..operators.match import And, Or
from ..search import Search
from ..sources.statistics import add_statistics, merge_statistics, open_statistics, write_statistics
from ..sources.storage import new_folder
from . import sql as S
from .registry import query
from .tables import documents, table

WORDS = ["the", "of", "license"]
TREE = Or(*WORDS)


def ranked(spark, sf_dir, ranker, *formula, **settings):
    s = Search.over(documents(spark, sf_dir)).where(TREE).rank(ranker, *formula)
    if "weights" in settings:
        s = s.field_weights(settings["weights"])
    if "idf" in settings:
        s = s.idf(settings["idf"])
    return s.found().select("doc_id", "weight")


def bm25_twin(flavour="normalized"):
    return f"WITH {S.BASE},\n{S.bm25(WORDS, 'b', flavour)} SELECT doc_id, bm25 AS weight FROM b"


def proximity_twin(weights=(1, 1)):
    return f"WITH {S.BASE},\n{S.proximity(WORDS, 'p', weights)} SELECT doc_id, prox AS weight FROM p"


@query("factor_lcs", f"WITH {S.BASE},\n{S.lcs(WORDS)} SELECT doc_id, CASE field WHEN 0 THEN 'title' ELSE 'body' END AS field, lcs FROM lcs")
def factor_lcs(spark, sf_dir):
    s = Search.over(documents(spark, sf_dir)).where(TREE)
    return s.factors().select("doc_id", "field", "lcs")


PROXIMITY_BM25 = f"""WITH {S.BASE},
{S.proximity(WORDS)},
{S.bm25(WORDS)}
SELECT p.doc_id, p.prox * 1000 + b.bm25 AS weight FROM prox p JOIN bm25 b ON b.doc_id = p.doc_id"""


@query("rank_proximity_bm25", PROXIMITY_BM25)
def rank_proximity_bm25(spark, sf_dir):
    return ranked(spark, sf_dir, "proximity_bm25")


@query("rank_bm25", bm25_twin())
def rank_bm25(spark, sf_dir):
    return ranked(spark, sf_dir, "bm25")


def counted_documents(spark, sf_dir):
    """Documents with kept statistics: those without labels were counted first, then the labelled ones arrived."""
    path = new_folder(spark, "statistics")
    c = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id").distinct()
    write_statistics(replace(c, df=c.df.join(labels, "doc_id", "left_anti")), path, buckets=16)
    add_statistics(replace(c, df=c.df.join(labels, "doc_id", "left_semi")), path)
    return c, path


@query("rank_bm25_stored", bm25_twin())
def rank_bm25_stored(spark, sf_dir):
    """Ranked with kept statistics: the texts are read once."""
    c, path = counted_documents(spark, sf_dir)
    return Search.over(open_statistics(c, path)).where(TREE).rank("bm25").found().select("doc_id", "weight")


@query("rank_proximity_bm25_stored", PROXIMITY_BM25)
def rank_proximity_bm25_stored(spark, sf_dir):
    """The same with the default ranker, after the parts were merged."""
    c, path = counted_documents(spark, sf_dir)
    merge_statistics(c, path)
    return Search.over(open_statistics(c, path)).where(TREE).found().select("doc_id", "weight")


@query("rank_none", f"WITH {S.BASE} SELECT DISTINCT doc_id, 1::BIGINT AS weight FROM post WHERE tok IN ({S.quoted(WORDS)})")
def rank_none(spark, sf_dir):
    return ranked(spark, sf_dir, "none")


@query(
    "rank_wordcount",
    f"""WITH {S.BASE}
SELECT doc_id, sum(CASE field WHEN 0 THEN 5 ELSE 1 END)::BIGINT AS weight
FROM post WHERE tok IN ({S.quoted(WORDS)}) GROUP BY doc_id""",
)
def rank_wordcount(spark, sf_dir):
    return ranked(spark, sf_dir, "wordcount", weights={"title": 5})


@query("rank_proximity", proximity_twin())
def rank_proximity(spark, sf_dir):
    return ranked(spark, sf_dir, "proximity")


@query(
    "rank_matchany",
    f"""WITH {S.BASE},
{S.lcs(WORDS)},
cnt AS (SELECT doc_id, field, count(DISTINCT tok) AS n FROM post WHERE tok IN ({S.quoted(WORDS)}) GROUP BY ALL)
SELECT c.doc_id, sum((c.n + (l.lcs - 1) * 6) * CASE c.field WHEN 0 THEN 3 ELSE 1 END)::BIGINT AS weight
FROM cnt c JOIN lcs l ON l.doc_id = c.doc_id AND l.field = c.field GROUP BY c.doc_id""",
)
def rank_matchany(spark, sf_dir):
    return ranked(spark, sf_dir, "matchany", weights={"title": 3})


@query(
    "rank_fieldmask",
    f"""WITH {S.BASE}
SELECT doc_id, sum(DISTINCT 1 << field)::BIGINT AS weight
FROM post WHERE tok IN ({S.quoted(WORDS)}) GROUP BY doc_id""",
)
def rank_fieldmask(spark, sf_dir):
    return ranked(spark, sf_dir, "fieldmask")


@query(
    "rank_head_exact",
    f"""WITH {S.BASE},
{S.lcs(WORDS)},
{S.bm25(WORDS)},
heads AS (SELECT DISTINCT doc_id, field FROM post WHERE pos = 0 AND tok IN ({S.quoted(WORDS)})),
per AS (
  SELECT l.doc_id, 4 * l.lcs + CASE WHEN h.doc_id IS NOT NULL THEN 2 ELSE 0 END
         + CASE WHEN t.ts = ['the', 'of', 'license'] THEN 1 ELSE 0 END AS w
  FROM lcs l JOIN toks t ON t.doc_id = l.doc_id AND t.field = l.field
  LEFT JOIN heads h ON h.doc_id = l.doc_id AND h.field = l.field)
SELECT p.doc_id, (sum(p.w) * 1000 + any_value(b.bm25))::BIGINT AS weight
FROM per p JOIN bm25 b ON b.doc_id = p.doc_id GROUP BY p.doc_id""",
)
def rank_head_exact(spark, sf_dir):
    return ranked(spark, sf_dir, "head_exact")


@query(
    "rank_expr",
    f"""WITH {S.BASE},
{S.lcs(WORDS)},
{S.bm25(WORDS)},
cnt AS (SELECT doc_id, field, count(*) AS hits FROM post WHERE tok IN ({S.quoted(WORDS)}) GROUP BY ALL)
SELECT l.doc_id, (sum(l.lcs * CASE l.field WHEN 0 THEN 10 ELSE 2 END + c.hits) * 1000 + any_value(b.bm25))::BIGINT AS weight
FROM lcs l JOIN cnt c ON c.doc_id = l.doc_id AND c.field = l.field
JOIN bm25 b ON b.doc_id = l.doc_id GROUP BY l.doc_id""",
)
def rank_expr(spark, sf_dir):
    formula = ("lcs * user_weight + hit_count", "field_sum * 1000 + bm25")
    return ranked(spark, sf_dir, "expr", *formula, weights={"title": 10, "body": 2})


@query("rank_idf_plain", bm25_twin("plain"))
def rank_idf_plain(spark, sf_dir):
    return ranked(spark, sf_dir, "bm25", idf="plain")


@query(
    "rank_factors",
    f"""WITH {S.BASE},
{S.lcs(WORDS)},
{S.bm25(WORDS)},
cnt AS (
  SELECT doc_id, field, count(*) AS hit_count, count(DISTINCT tok) AS word_count, min(pos) AS min_hit_pos
  FROM post WHERE tok IN ({S.quoted(WORDS)}) GROUP BY ALL)
SELECT c.doc_id, CASE c.field WHEN 0 THEN 'title' ELSE 'body' END AS field, l.lcs, c.hit_count,
       c.word_count, c.min_hit_pos::BIGINT AS min_hit_pos, t.ts = ['the', 'of', 'license'] AS exact_hit, b.bm25
FROM cnt c JOIN lcs l ON l.doc_id = c.doc_id AND l.field = c.field
JOIN toks t ON t.doc_id = c.doc_id AND t.field = c.field JOIN bm25 b ON b.doc_id = c.doc_id""",
)
def rank_factors(spark, sf_dir):
    return Search.over(documents(spark, sf_dir)).where(TREE).factors()


@query("field_weights", proximity_twin((7, 2)))
def field_weights(spark, sf_dir):
    return ranked(spark, sf_dir, "proximity", weights={"title": 7, "body": 2, "nowhere": 9})


@query("field_weights_positional", proximity_twin((4, 1)))
def field_weights_positional(spark, sf_dir):
    return ranked(spark, sf_dir, "proximity", weights=[4])


@query(
    "rank_repeated_words",
    f"""WITH {S.BASE},
{S.all_words(['the', 'of'])},
{S.proximity(['the', 'of', 'the'])}
SELECT m.doc_id, p.prox AS weight FROM m JOIN prox p ON p.doc_id = m.doc_id""",
)
def rank_repeated_words(spark, sf_dir):
    tree = And("the", "of", "the")
    s = Search.over(documents(spark, sf_dir)).where(tree).rank("proximity")
    return s.found().select("doc_id", "weight")
