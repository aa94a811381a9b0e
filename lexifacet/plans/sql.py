"""SQL fragments shared by the SQL twins: collections, postings, weights.

Written the relational way (unnested tokens, self-joins, window functions), on
purpose unlike the row-local expressions they check.
"""

from __future__ import annotations

from collections.abc import Sequence

WORD = r"[\p{L}\p{N}_]+"
PIECES = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"

DOCS = """docs AS (
  SELECT doc_id, lang, source, n_chars, text,
         split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS body,
         CASE WHEN doc_id % 7 = doc_id % 11 THEN [doc_id % 7]
              ELSE [least(doc_id % 7, doc_id % 11), greatest(doc_id % 7, doc_id % 11)] END AS tags
  FROM documents)"""

POST = f"""toks AS (
  SELECT doc_id, 0 AS field, regexp_extract_all(lower(title), '{WORD}') AS ts FROM docs
  UNION ALL
  SELECT doc_id, 1 AS field, regexp_extract_all(lower(body), '{WORD}') AS ts FROM docs),
post AS (
  SELECT doc_id, field, unnest(ts) AS tok, generate_subscripts(ts, 1) - 1 AS pos FROM toks),
lens AS (SELECT doc_id, sum(len(ts)) AS dl FROM toks GROUP BY doc_id)"""

BASE = f"{DOCS},\n{POST}"


def quoted(words: Sequence[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def values(rows: Sequence[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def query_table(words: Sequence[str], name: str = "q") -> str:
    """The query as rows (qpos, tok)."""
    return f"{name}(qpos, tok) AS (VALUES {values(list(enumerate(words)))})"


def lcs(words: Sequence[str], name: str = "lcs", post: str = "post") -> str:
    """(doc_id, field, lcs): longest run of query words, by gaps and islands."""
    q = f"{name}_q"
    return f"""{query_table(words, q)},
{name}_h AS (
  SELECT p.doc_id, p.field, q.qpos, p.pos - q.qpos AS d
  FROM {post} p JOIN {q} q ON p.tok = q.tok),
{name}_i AS (
  SELECT doc_id, field, d,
         qpos - row_number() OVER (PARTITION BY doc_id, field, d ORDER BY qpos) AS isl
  FROM {name}_h),
{name}_r AS (SELECT doc_id, field, d, isl, count(*) AS n FROM {name}_i GROUP BY ALL),
{name} AS (SELECT doc_id, field, max(n) AS lcs FROM {name}_r GROUP BY ALL)"""


def phrase(words: Sequence[str], name: str, post: str = "post") -> str:
    """(doc_id, field, pos): where the phrase starts."""
    joins = " ".join(
        f"JOIN {post} p{i} ON p{i}.doc_id = p0.doc_id AND p{i}.field = p0.field"
        f" AND p{i}.pos = p0.pos + {i} AND p{i}.tok = '{w}'"
        for i, w in enumerate(words)
        if i
    )
    return f"""{name} AS (
  SELECT p0.doc_id, p0.field, p0.pos FROM {post} p0 {joins} WHERE p0.tok = '{words[0]}')"""


def near(words: Sequence[str], span: int, name: str, post: str = "post") -> str:
    """(doc_id, field): where all words stand inside one window."""
    return f"""{name}_h AS (SELECT * FROM {post} WHERE tok IN ({quoted(words)})),
{name} AS (
  SELECT DISTINCT doc_id, field FROM (
    SELECT a.doc_id, a.field, a.pos
    FROM {name}_h a JOIN {name}_h b
      ON a.doc_id = b.doc_id AND a.field = b.field AND b.pos BETWEEN a.pos AND a.pos + {span - 1}
    GROUP BY a.doc_id, a.field, a.pos HAVING count(DISTINCT b.tok) = {len(words)}) w)"""


def bm25(words: Sequence[str], name: str = "bm25", flavour: str = "normalized") -> str:
    """(doc_id, bm25) of every document with a query word."""
    words = list(dict.fromkeys(words))
    ratio = "(n_docs - df + 1) / df" if flavour == "normalized" else "n_docs / df"
    return f"""{name}_q(tok) AS (VALUES {values([(w,) for w in words])}),
{name}_n AS (SELECT count(*)::DOUBLE AS n_docs, sum(dl)::DOUBLE / count(*) AS mean FROM lens),
{name}_df AS (
  SELECT q.tok, count(DISTINCT p.doc_id)::DOUBLE AS df
  FROM {name}_q q LEFT JOIN post p ON p.tok = q.tok GROUP BY q.tok),
{name}_idf AS (
  SELECT tok, CASE WHEN df > 0 THEN greatest(ln({ratio}), 0) ELSE 0 END AS idf
  FROM {name}_df, {name}_n),
{name}_max AS (SELECT sum(idf * 2.2) AS smax FROM {name}_idf),
{name}_tf AS (
  SELECT doc_id, tok, count(*)::DOUBLE AS tf FROM post WHERE tok IN ({quoted(words)}) GROUP BY ALL),
{name}_s AS (
  SELECT t.doc_id, sum(i.idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * l.dl::DOUBLE / n.mean))) AS s
  FROM {name}_tf t JOIN {name}_idf i ON i.tok = t.tok JOIN lens l ON l.doc_id = t.doc_id, {name}_n n
  GROUP BY t.doc_id),
{name} AS (
  SELECT doc_id,
         CASE WHEN smax > 0 THEN greatest(least(floor(round(1000 * s / smax, 9)), 999), 0) ELSE 0 END::BIGINT AS bm25
  FROM {name}_s, {name}_max)"""


def all_words(words: Sequence[str], name: str = "m") -> str:
    """(doc_id) with every word: relational division."""
    words = list(dict.fromkeys(words))
    return f"""{name} AS (
  SELECT doc_id FROM post WHERE tok IN ({quoted(words)})
  GROUP BY doc_id HAVING count(DISTINCT tok) = {len(words)})"""


def proximity(words: Sequence[str], name: str = "prox", weights: tuple[int, int] = (1, 1)) -> str:
    """(doc_id, prox): field-weighted sum of the longest runs."""
    return f"""{lcs(words, name + "_l")},
{name} AS (
  SELECT doc_id, sum(lcs * CASE field WHEN 0 THEN {weights[0]} ELSE {weights[1]} END)::BIGINT AS prox
  FROM {name}_l GROUP BY doc_id)"""


def found(words: Sequence[str]) -> str:
    """(doc_id, weight) of an all-words search, as ``f``."""
    return f"""{BASE},
{all_words(words)},
{proximity(words)},
f AS (SELECT m.doc_id, p.prox AS weight FROM m JOIN prox p ON p.doc_id = m.doc_id)"""
