"""Match modes and extended match conditions over the documents."""

from __future__ import annotations

from ..operators.match import And, Near, Not, Or, Phrase, Quorum, Word
from ..search import Search
from . import sql as S
from .registry import query
from .tables import documents, orders


def search(spark, sf_dir) -> Search:
    return Search.over(documents(spark, sf_dir))


def weights(s: Search):
    return s.found().select("doc_id", "weight")


def unweighted(spark, sf_dir, tree):
    return weights(search(spark, sf_dir).where(tree).rank("none"))


@query("match_all", f"WITH {S.found(['the', 'of'])} SELECT doc_id, weight FROM f")
def match_all(spark, sf_dir):
    return weights(search(spark, sf_dir).match("the of"))


MATCHANY = f"""{S.lcs(['license', 'la', 'de'])},
cnt AS (SELECT doc_id, field, count(DISTINCT tok) AS n FROM post WHERE tok IN ('license', 'la', 'de') GROUP BY ALL),
f AS (
  SELECT c.doc_id, sum(c.n + (l.lcs - 1) * 6)::BIGINT AS weight
  FROM cnt c JOIN lcs l ON l.doc_id = c.doc_id AND l.field = c.field GROUP BY c.doc_id)"""


@query("match_any", f"WITH {S.BASE},\n{MATCHANY} SELECT doc_id, weight FROM f")
def match_any(spark, sf_dir):
    return weights(search(spark, sf_dir).match("license la de", "any"))


@query(
    "match_phrase",
    f"""WITH {S.BASE},
{S.phrase(['of', 'the'], 'ph')},
{S.proximity(['of', 'the'])}
SELECT DISTINCT ph.doc_id, p.prox AS weight FROM ph JOIN prox p ON p.doc_id = ph.doc_id""",
)
def match_phrase(spark, sf_dir):
    return weights(search(spark, sf_dir).match("of the", "phrase"))


@query(
    "match_boolean",
    f"""WITH {S.BASE},
flags AS (
  SELECT doc_id, bool_or(tok = 'the') AS a, bool_or(tok = 'of') AS b, bool_or(tok = 'was') AS c,
         bool_or(tok = 'license') AS d
  FROM post GROUP BY doc_id)
SELECT doc_id, 1::BIGINT AS weight FROM flags WHERE (a AND b AND NOT c) OR d""",
)
def match_boolean(spark, sf_dir):
    tree = Or(And("the", "of", Not("was")), "license")
    return weights(search(spark, sf_dir).where(tree, "boolean"))


EXTENDED = f"""WITH {S.BASE},
{S.phrase(['of', 'the'], 'ph')},
{S.near(['and', 'to'], 4, 'nr')},
quo AS (
  SELECT doc_id FROM post WHERE tok IN ('in', 'is', 'it')
  GROUP BY doc_id HAVING count(DISTINCT tok) >= 2),
body AS (SELECT DISTINCT doc_id FROM post WHERE tok = 'that' AND field = 1),
bad AS (SELECT DISTINCT doc_id FROM post WHERE tok = 'la'),
m AS (
  SELECT doc_id FROM body
  WHERE doc_id IN (SELECT doc_id FROM ph) AND doc_id IN (SELECT doc_id FROM nr)
    AND doc_id IN (SELECT doc_id FROM quo) AND doc_id NOT IN (SELECT doc_id FROM bad)),
{S.proximity(['that', 'of', 'the', 'and', 'to', 'in', 'is', 'it'])},
{S.bm25(['that', 'of', 'the', 'and', 'to', 'in', 'is', 'it'])}
SELECT m.doc_id, p.prox * 1000 + b.bm25 AS weight
FROM m JOIN prox p ON p.doc_id = m.doc_id JOIN bm25 b ON b.doc_id = m.doc_id"""

EXTENDED_TREE = And(
    Word("that", fields="body"),
    Phrase("of the"),
    Near("and to", 4),
    Quorum("in is it", 2),
    Not("la"),
)


@query("match_extended", EXTENDED)
def match_extended(spark, sf_dir):
    return weights(search(spark, sf_dir).where(EXTENDED_TREE))


@query("match_extended2", EXTENDED)
def match_extended2(spark, sf_dir):
    return weights(search(spark, sf_dir).where(EXTENDED_TREE, "extended2"))


@query(
    "match_fullscan",
    "SELECT o_orderkey, 1::BIGINT AS weight, o_orderstatus FROM orders",
)
def match_fullscan(spark, sf_dir):
    found = Search.over(orders(spark, sf_dir)).everything().found()
    return found.select("o_orderkey", "weight", "o_orderstatus")


@query(
    "match_field",
    f"""WITH {S.BASE}
SELECT DISTINCT doc_id, 1::BIGINT AS weight FROM post WHERE tok = 'the' AND field = 0""",
)
def match_field(spark, sf_dir):
    return unweighted(spark, sf_dir, Word("the", fields="title"))


@query(
    "match_near",
    f"""WITH {S.BASE},
{S.near(['the', 'of', 'license'], 12, 'nr')}
SELECT DISTINCT doc_id, 1::BIGINT AS weight FROM nr""",
)
def match_near(spark, sf_dir):
    return unweighted(spark, sf_dir, Near("the of license", 12))


@query(
    "match_quorum",
    f"""WITH {S.BASE}
SELECT doc_id, 1::BIGINT AS weight FROM post WHERE tok IN ('license', 'la', 'the', 'en')
GROUP BY doc_id HAVING count(DISTINCT tok) >= 3""",
)
def match_quorum(spark, sf_dir):
    return unweighted(spark, sf_dir, Quorum("license la the en", 3))


@query(
    "match_anchor",
    f"""WITH {S.BASE},
firsts AS (SELECT DISTINCT doc_id FROM post WHERE tok = 'the' AND pos = 0),
lasts AS (
  SELECT DISTINCT p.doc_id FROM post p JOIN toks t ON t.doc_id = p.doc_id AND t.field = p.field
  WHERE p.tok = 'the' AND p.pos = len(t.ts) - 1)
SELECT doc_id, 1::BIGINT AS weight FROM (SELECT doc_id FROM firsts UNION SELECT doc_id FROM lasts) u""",
)
def match_anchor(spark, sf_dir):
    return unweighted(spark, sf_dir, Or(Word("the", first=True), Word("the", last=True)))


# A small table of word forms, token -> normal form.
FORMS = {"thes": "the", "thed": "the", "des": "de", "erin": "er"}


@query(
    "match_exact",
    f"""WITH {S.BASE},
forms(token, normal) AS (VALUES {S.values(list(FORMS.items()))}),
norm AS (SELECT p.doc_id, p.tok, coalesce(f.normal, p.tok) AS n FROM post p LEFT JOIN forms f ON f.token = p.tok)
SELECT doc_id, 1::BIGINT AS weight FROM norm GROUP BY doc_id
HAVING bool_or(tok = 'thed') AND bool_or(n = 'er')""",
)
def match_exact(spark, sf_dir):
    c = documents(spark, sf_dir)
    c = type(c)(c.name, c.df, c.id, c.fields, c.attrs, wordforms=FORMS)
    tree = And(Word("thed", exact=True), Word("erin"))
    return weights(Search.over(c).where(tree).rank("none"))


@query(
    "match_not",
    f"""WITH {S.BASE}
SELECT doc_id, 1::BIGINT AS weight FROM post GROUP BY doc_id
HAVING bool_or(tok = 'the') AND NOT bool_or(tok = 'was')""",
)
def match_not(spark, sf_dir):
    return unweighted(spark, sf_dir, Word("the") & ~Word("was"))
