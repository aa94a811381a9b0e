"""Excerpts of whole documents, one query per option."""

from __future__ import annotations

from ..operators.excerpts import ExcerptOptions, build_excerpts, build_passages, excerpt, highlight
from ..operators.match import And, Not, Phrase
from . import sql as S
from .registry import query
from .tables import table

SOURCE = "SELECT doc_id AS id, text AS t FROM documents"
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
CLEAN_PAGES = f"SELECT page_id AS id, regexp_replace(html, '{MARKUP}', ' ', 'g') AS t FROM pages"


def pieces(source: str, boundaries: bool = False) -> str:
    """src, pc (word and gap pieces), tk (tokens with their positions)."""
    seg = (
        "sum(CASE WHEN NOT is_word AND regexp_matches(piece, '[.!?]') THEN 1 ELSE 0 END)"
        " OVER (PARTITION BY id ORDER BY k)"
        if boundaries
        else "0"
    )
    return f"""src AS ({source}),
cut AS (SELECT id, regexp_extract_all(t, '{S.PIECES}') AS ps FROM src),
pc0 AS (SELECT id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS k FROM cut),
pc1 AS (SELECT *, regexp_matches(piece, '^{S.WORD}') AS is_word FROM pc0),
pc AS (SELECT *, {seg} AS seg FROM pc1),
tk AS (
  SELECT id, seg, k, lower(piece) AS tok, row_number() OVER (PARTITION BY id, seg ORDER BY k) - 1 AS pos
  FROM pc WHERE is_word),
ntk AS (SELECT id, seg, count(*) AS n FROM tk GROUP BY ALL)"""


def word_hits(tests: list[str]) -> str:
    return f"hit AS (SELECT id, seg, k, tok, pos FROM tk WHERE {' OR '.join(tests)})"


def phrase_hits(words: list[str]) -> str:
    joins = " ".join(
        f"JOIN tk t{i} ON t{i}.id = t0.id AND t{i}.seg = t0.seg AND t{i}.pos = t0.pos + {i} AND t{i}.tok = '{w}'"
        for i, w in enumerate(words)
        if i
    )
    return f"""starts AS (SELECT t0.id, t0.seg, t0.pos FROM tk t0 {joins} WHERE t0.tok = '{words[0]}'),
hit AS (
  SELECT DISTINCT t.id, t.seg, t.k, t.tok, t.pos FROM starts s JOIN tk t
  ON t.id = s.id AND t.seg = s.seg AND t.pos BETWEEN s.pos AND s.pos + {len(words) - 1})"""


def marked(join: str, before: str = "<b>", after: str = "</b>") -> str:
    return f"CASE WHEN {join}.k IS NULL THEN p.piece ELSE '{before}' || p.piece || '{after}' END"


def passages(
    tests: list[str],
    around: int = 5,
    limit: int = 256,
    limit_passages: int = 0,
    limit_words: int = 0,
    single: bool = False,
    force_all: bool = False,
    separator: str = " ... ",
) -> str:
    """psg (ranked passages with text) and kept (the ones that fit)."""
    covers = ", ".join(f"max(CASE WHEN {t} THEN 1 ELSE 0 END) AS c{i}" for i, t in enumerate(tests))
    distinct = " + ".join(f"c{i}" for i in range(len(tests)))
    fits = ["run_len <= " + str(limit)] if limit else []
    fits += [f"run_words <= {limit_words}"] if limit_words else []
    fits += [f"rn <= {limit_passages}"] if limit_passages else []
    fits += ["rn <= 1"] if single else []
    forced = ""
    if force_all:
        forced = " OR " + " OR ".join(f"rn = first_{i}" for i in range(len(tests)))
    firsts = ", ".join(
        f"min(CASE WHEN c{i} = 1 THEN rn END) OVER (PARTITION BY id) AS first_{i}" for i in range(len(tests))
    )
    within = [f"{{len}} <= {limit}"] if limit else []
    within += [f"{{words}} <= {limit_words}"] if limit_words else []

    def fit(length: str, words: str) -> str:
        return " AND ".join(within).format(len=length, words=words) or "true"

    names = ", ".join(f"c{i}" for i in range(len(tests)))
    ends = "greatest(h.pos - {0}, 0)".format(around), "least(g.pos + {0}, x.n - 1)".format(around)
    return f"""gap AS (
  SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY id, seg ORDER BY pos) <= {2 * around + 1} THEN 0 ELSE 1 END AS new
  FROM hit),
isl AS (SELECT *, sum(new) OVER (PARTITION BY id, seg ORDER BY pos) AS grp FROM gap),
span AS (
  SELECT id, seg, grp, min(pos) - {around} AS s0, max(pos) + {around} AS e0, count(*) AS nh, {covers}
  FROM isl GROUP BY id, seg, grp),
chars AS (SELECT id, k, length(piece) AS size, sum(length(piece)) OVER (PARTITION BY id ORDER BY k) AS till FROM pc),
tkc AS (SELECT t.id, t.seg, t.pos, t.k, c.till - c.size AS beg, c.till FROM tk t JOIN chars c ON c.id = t.id AND c.k = t.k),
clip0 AS (
  SELECT x.*, n, greatest(s0, 0) AS s, least(e0, n - 1) AS e, {distinct} AS nd
  FROM span x JOIN ntk ON ntk.id = x.id AND ntk.seg = x.seg),
sized AS (
  SELECT x.*, {fit('b.till - a.beg', 'x.e - x.s + 1')} AS fits FROM clip0 x
  JOIN tkc a ON a.id = x.id AND a.seg = x.seg AND a.pos = x.s
  JOIN tkc b ON b.id = x.id AND b.seg = x.seg AND b.pos = x.e),
wide AS (
  SELECT x.id, x.seg, x.grp, h.pos AS h, {ends[0]} AS s, max({ends[1]}) AS e
  FROM sized x JOIN isl h ON h.id = x.id AND h.seg = x.seg AND h.grp = x.grp
  JOIN isl g ON g.id = x.id AND g.seg = x.seg AND g.grp = x.grp AND g.pos >= h.pos
  JOIN tkc a ON a.id = x.id AND a.seg = x.seg AND a.pos = {ends[0]}
  JOIN tkc b ON b.id = x.id AND b.seg = x.seg AND b.pos = {ends[1]}
  WHERE NOT x.fits AND {fit('b.till - a.beg', f'{ends[1]} - {ends[0]} + 1')}
  GROUP BY ALL),
alone AS (
  SELECT x.id, x.seg, x.grp, h.pos AS h, h.pos AS s, h.pos AS e
  FROM sized x JOIN isl h ON h.id = x.id AND h.seg = x.seg AND h.grp = x.grp
  JOIN tkc a ON a.id = x.id AND a.seg = x.seg AND a.pos = h.pos
  LEFT JOIN wide w ON w.id = x.id AND w.seg = x.seg AND w.h = h.pos
  WHERE NOT x.fits AND w.id IS NULL AND {fit('a.till - a.beg', '1')}),
win AS (SELECT * FROM wide UNION ALL SELECT * FROM alone),
scored AS (
  SELECT w.id, w.seg, w.grp, w.h, w.s, w.e, count(*) AS nh, {covers}
  FROM win w JOIN hit h ON h.id = w.id AND h.seg = w.seg AND h.pos BETWEEN w.s AND w.e GROUP BY w.id, w.seg, w.grp, w.h, w.s, w.e),
best AS (
  SELECT *, {distinct} AS nd FROM scored
  QUALIFY row_number() OVER (PARTITION BY id, seg, grp ORDER BY {distinct} DESC, nh DESC, s, e) = 1),
clip AS (
  SELECT id, seg, s, e, nh, nd, {names} FROM sized WHERE fits UNION ALL SELECT id, seg, s, e, nh, nd, {names} FROM best),
placed AS (
  SELECT c.*, a.k AS ks, b.k AS ke FROM clip c
  JOIN tk a ON a.id = c.id AND a.seg = c.seg AND a.pos = c.s
  JOIN tk b ON b.id = c.id AND b.seg = c.seg AND b.pos = c.e),
txt AS (
  SELECT x.id, x.seg, x.s, sum(length(p.piece)) AS n_len,
         string_agg({marked('h')}, '' ORDER BY p.k) AS txt
  FROM placed x JOIN pc p ON p.id = x.id AND p.k BETWEEN x.ks AND x.ke
  LEFT JOIN hit h ON h.id = p.id AND h.k = p.k
  GROUP BY x.id, x.seg, x.s),
ranked AS (
  SELECT x.*, t.n_len, t.txt, row_number() OVER (PARTITION BY x.id ORDER BY nd DESC, nh DESC, x.seg, x.s) AS rn
  FROM placed x JOIN txt t ON t.id = x.id AND t.seg = x.seg AND t.s = x.s),
psg AS (
  SELECT *, sum(n_len) OVER (PARTITION BY id ORDER BY rn) + {len(separator)} * (rn - 1) AS run_len,
         sum(e - s + 1) OVER (PARTITION BY id ORDER BY rn) AS run_words, {firsts}
  FROM ranked),
kept AS (SELECT * FROM psg WHERE ({' AND '.join(fits) or 'true'}){forced})"""


def head(limit: int) -> str:
    if not limit:
        return "t"
    start = f"substr(t, 1, {limit})"
    return f"""CASE WHEN length(t) <= {limit} THEN t ELSE regexp_replace(
    CASE WHEN regexp_matches(substr(t, {limit}, 2), '^[\\p{{L}}\\p{{N}}_]{{2}}$')
         THEN regexp_replace({start}, '[\\p{{L}}\\p{{N}}_]+$', '') ELSE {start} END,
    '[^\\p{{L}}\\p{{N}}_]+$', '') END"""


def snippets(
    hits: str,
    tests: list[str],
    source: str = SOURCE,
    id: str = "doc_id",
    separator: str = " ... ",
    boundaries: bool = False,
    weight_order: bool = False,
    allow_empty: bool = False,
    applies: str | None = None,
    **limits,
) -> str:
    limit = limits.get("limit", 256)
    whole = limit and not (limits.get("limit_passages") or limits.get("limit_words") or limits.get("single"))
    order = "rn" if weight_order else "seg, s"
    nothing = "''" if allow_empty else head(limit)
    fits = f"length(src.t) <= {limit} AND w.txt IS NOT NULL" if whole else "false"
    extra = f"WHEN NOT ({applies}) THEN {nothing} " if applies else ""
    # Over sentences a short text is shown whole, so its hits are looked up by piece.
    return f"""WITH {pieces(source, boundaries)},
{hits},
{passages(tests, separator=separator, **limits)},
out AS (SELECT id, string_agg(txt, '{separator}' ORDER BY {order}) AS txt FROM kept GROUP BY id),
short AS (
  SELECT p.id, string_agg({marked('h')}, '' ORDER BY p.k) AS txt
  FROM pc p JOIN src ON src.id = p.id AND length(src.t) <= {limit or 0}
  LEFT JOIN hit h ON h.id = p.id AND h.k = p.k
  WHERE p.id IN (SELECT id FROM hit) GROUP BY p.id)
SELECT src.id AS {id}, CASE {extra}WHEN {fits} THEN w.txt WHEN o.txt IS NOT NULL THEN o.txt ELSE {nothing} END AS snippet
FROM src LEFT JOIN out o ON o.id = src.id LEFT JOIN short w ON w.id = src.id"""


def is_word(*words: str) -> list[str]:
    return [f"tok = '{w}'" for w in words]


WORDS = ["the", "license", "la"]
TEXT = "the license la"
BAG = is_word(*WORDS)


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def snippet(spark, sf_dir, words=TEXT, **options):
    return build_excerpts(docs(spark, sf_dir), "doc_id", "text", words, **options)


@query(
    "excerpt_highlight",
    f"""WITH {pieces(SOURCE)}
SELECT id AS doc_id, string_agg(CASE WHEN is_word AND lower(piece) IN ({S.quoted(WORDS)})
       THEN '<em>' || piece || '</em>' ELSE piece END, '' ORDER BY k) AS marked
FROM pc GROUP BY id""",
)
def excerpt_highlight(spark, sf_dir):
    o = ExcerptOptions(before_match="<em>", after_match="</em>")
    return docs(spark, sf_dir).select("doc_id", highlight("text", TEXT, options=o).alias("marked"))


@query("excerpt_passages", snippets(word_hits(BAG), BAG, limit=0, around=3, separator=" | "))
def excerpt_passages(spark, sf_dir):
    return snippet(spark, sf_dir, limit=0, around=3, chunk_separator=" | ")


@query("excerpt_limit", snippets(word_hits(BAG), BAG))
def excerpt_limit(spark, sf_dir):
    return snippet(spark, sf_dir)


@query("excerpt_limit_passages", snippets(word_hits(BAG), BAG, limit=400, limit_passages=3, limit_words=40, around=2))
def excerpt_limit_passages(spark, sf_dir):
    return snippet(spark, sf_dir, limit=400, limit_passages=3, limit_words=40, around=2)


@query("excerpt_exact_phrase", snippets(phrase_hits(["of", "the"]), is_word("of", "the")))
def excerpt_exact_phrase(spark, sf_dir):
    return snippet(spark, sf_dir, "of the", exact_phrase=True)


@query("excerpt_single", snippets(word_hits(BAG), BAG, single=True))
def excerpt_single(spark, sf_dir):
    return snippet(spark, sf_dir, single_passage=True)


@query("excerpt_weight_order", snippets(word_hits(BAG), BAG, weight_order=True, around=2))
def excerpt_weight_order(spark, sf_dir):
    return snippet(spark, sf_dir, weight_order=True, around=2)


@query("excerpt_boundaries", snippets(word_hits(BAG), BAG, boundaries=True))
def excerpt_boundaries(spark, sf_dir):
    return snippet(spark, sf_dir, use_boundaries=True)


QUERY_MODE = "src.id IN (SELECT id FROM starts) AND src.id IN (SELECT id FROM tk WHERE tok = 'license') AND src.id NOT IN (SELECT id FROM tk WHERE tok = 'la')"
QUERY_HITS = phrase_hits(["of", "the"]).replace("hit AS (", "ph AS (") + """,
hit AS (SELECT * FROM ph UNION SELECT id, seg, k, tok, pos FROM tk WHERE tok = 'license')"""


@query("excerpt_query_mode", snippets(QUERY_HITS, is_word("of", "the", "license"), applies=QUERY_MODE))
def excerpt_query_mode(spark, sf_dir):
    tree = And(Phrase("of the"), "license", Not("la"))
    return snippet(spark, sf_dir, tree, query_mode=True)


ALL_WORDS = ["the", "la", "license", "en"]


@query("excerpt_force_all", snippets(word_hits(is_word(*ALL_WORDS)), is_word(*ALL_WORDS), limit=60, around=1, force_all=True))
def excerpt_force_all(spark, sf_dir):
    return snippet(spark, sf_dir, " ".join(ALL_WORDS), limit=60, around=1, force_all_words=True)


@query("excerpt_allow_empty", snippets(word_hits(is_word("license")), is_word("license"), allow_empty=True))
def excerpt_allow_empty(spark, sf_dir):
    return snippet(spark, sf_dir, "license", allow_empty=True)


@query("excerpt_html", snippets(word_hits(is_word("the", "la")), is_word("the", "la"), source=CLEAN_PAGES, id="page_id"))
def excerpt_html(spark, sf_dir):
    o = ExcerptOptions(html_strip_mode="strip")
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", excerpt("html", "the la", options=o).alias("snippet"))


@query(
    "excerpt_passage_ids",
    f"""WITH {pieces(SOURCE)},
{word_hits(BAG)},
{passages(BAG, around=3)}
SELECT id AS doc_id, (row_number() OVER (PARTITION BY id ORDER BY seg, s) + 9)::INTEGER AS passage_id, txt AS passage FROM kept""",
)
def excerpt_passage_ids(spark, sf_dir):
    return build_passages(docs(spark, sf_dir), "doc_id", "text", TEXT, around=3, start_passage_id=10)


WILD = ["tok LIKE 'lic%'", "tok LIKE 'th%n'"]


@query("excerpt_wildcard", snippets(word_hits(WILD), WILD))
def excerpt_wildcard(spark, sf_dir):
    return snippet(spark, sf_dir, "lic* th*n")


