"""Collections from tables, side tables, files and XML; postings; result sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.match import And
from ..operators.updates import update_attributes
from ..search import Search
from ..sources import collection as C
from ..sources.catalog import hydrate as hydrate_page
from ..sources.documents import read_files, read_xml, split_file, write_files
from ..sources.postings import open_postings, write_postings
from ..sources.segments import add_documents, compact, create_segments, delete_documents, open_segments
from ..sources.storage import new_folder, persist_attributes
from . import sql as S
from .registry import query
from .tables import LATER, documents, labelled, orders, short_list, table


@query(
    "src_collection",
    f"""WITH {S.DOCS}
SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, array_to_string(d.tags, ',') AS tags,
       d.title, md5(d.body) AS body_digest
FROM docs d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def src_collection(spark, sf_dir):
    c = documents(spark, sf_dir, labels=True)
    rows = c.finish(c.rows())
    shown = {c: F.coalesce(c, F.lit(-1)) for c in ("quality", "toxic")}
    shown.update(tags=short_list("tags"), body_digest=F.md5("body"))
    return rows.withColumns(shown).drop("body")


@query(
    "src_mva",
    """WITH g AS (
  SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS part_ids
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(part_ids, '') AS part_ids FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""",
)
def src_mva(spark, sf_dir):
    rows = orders(spark, sf_dir, parts=True).attributes()
    return rows.select("o_orderkey", short_list("part_ids").alias("part_ids"))


@query(
    "src_files",
    f"SELECT page_id, len(regexp_extract_all(lower(html), '{S.WORD}'))::INTEGER AS n_tokens, md5(html) AS digest FROM pages",
)
def src_files(spark, sf_dir):
    """Pages written as one file each, then read back as whole-file documents."""
    folder = new_folder(spark, "files")
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    write_files(pages.repartition("page_id"), "page_id", "html", folder)
    id, html = split_file("text")
    return read_files(spark, folder).select(
        id.try_cast("long").alias("page_id"), F.size(T.tokenize(html)).alias("n_tokens"), F.md5(html).alias("digest")
    )


@query(
    "src_xml",
    f"SELECT page_id, url, len(regexp_extract_all(lower(html), '{S.WORD}'))::INTEGER AS n_tokens FROM pages",
)
def src_xml(spark, sf_dir):
    """Pages written as XML documents, then read back with a declared schema."""
    folder = new_folder(spark, "xml")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pages.write.option("rowTag", "document").option("rootTag", "documents").xml(folder)
    rows = read_xml(spark, folder, "document", "page_id long, url string, html string")
    return rows.select("page_id", "url", F.size(T.tokenize("html")).alias("n_tokens"))


@query(
    "postings",
    f"""WITH {S.BASE}
SELECT doc_id, CASE field WHEN 0 THEN 'title' ELSE 'body' END AS field, pos::INTEGER AS pos, tok AS token FROM post""",
)
def postings(spark, sf_dir):
    return C.postings(documents(spark, sf_dir))


@query(
    "postings_search",
    f"""WITH {S.BASE},
{S.all_words(['license', 'the'])},
{S.proximity(['license', 'the'])},
{S.bm25(['license', 'the'])}
SELECT m.doc_id, p.prox * 1000 + b.bm25 AS weight, d.lang
FROM m JOIN prox p ON p.doc_id = m.doc_id JOIN bm25 b ON b.doc_id = m.doc_id JOIN docs d ON d.doc_id = m.doc_id""",
)
def postings_search(spark, sf_dir):
    """The same search, answered from a written word table."""
    path = new_folder(spark, "postings")
    c = documents(spark, sf_dir)
    write_postings(c, path, buckets=16)
    indexed = open_postings(c, path)
    return Search.over(indexed).where(And("license", "the")).found().select("doc_id", "weight", "lang")


CHANGED = f"""docs AS (
  SELECT d.doc_id, d.lang, d.n_chars + (l.doc_id IS NOT NULL)::BIGINT AS n_chars, split_part(text, chr(10), 1) AS title,
         CASE WHEN l.doc_id IS NULL THEN '' ELSE '{LATER}' END || substr(text, length(split_part(text, chr(10), 1)) + 2) AS body
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id
  WHERE d.lang IS DISTINCT FROM 'de'),
{S.POST}"""


def changed_documents(spark, sf_dir):
    """Word tables of all documents, after labelled ones were replaced and those of one language deleted."""
    path = new_folder(spark, "segments")
    c = documents(spark, sf_dir)
    create_segments(c, path, buckets=16)
    add_documents(labelled(spark, sf_dir), path)
    delete_documents(c, path, table(spark, sf_dir, "documents").where("lang = 'de'"))
    return c, path


DELTA = f"""WITH {CHANGED},
{S.all_words(['license', 'the'])},
{S.proximity(['license', 'the'])},
{S.bm25(['license', 'the'])}
SELECT m.doc_id, p.prox * 1000 + b.bm25 AS weight, d.lang, d.n_chars
FROM m JOIN prox p ON p.doc_id = m.doc_id JOIN bm25 b ON b.doc_id = m.doc_id JOIN docs d ON d.doc_id = m.doc_id"""


@query("postings_delta", DELTA)
def postings_delta(spark, sf_dir):
    """A search over word tables to which documents were added and from which some were deleted."""
    c, path = changed_documents(spark, sf_dir)
    found = Search.over(open_segments(c, path)).where(And("license", "the")).found()
    return found.select("doc_id", "weight", "lang", "n_chars")


@query("postings_compacted", DELTA)
def postings_compacted(spark, sf_dir):
    """The same after compaction."""
    c, path = changed_documents(spark, sf_dir)
    compact(c, path)
    found = Search.over(open_segments(c, path)).where(And("license", "the")).found()
    return found.select("doc_id", "weight", "lang", "n_chars")


@query(
    "hydrate",
    f"""WITH {S.found(['the', 'of'])}
SELECT f.doc_id, f.weight, md5(d.text) AS digest FROM f JOIN documents d ON d.doc_id = f.doc_id
ORDER BY f.weight DESC, f.doc_id LIMIT 50""",
)
def hydrate(spark, sf_dir):
    page = Search.over(documents(spark, sf_dir)).match("the of").limits(0, 50).matches()
    source = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = [F.col("weight").desc(), F.col("doc_id").asc()]
    rows = hydrate_page(page.select("doc_id", "weight"), source, "doc_id", order)
    return rows.select("doc_id", "weight", F.md5("text").alias("digest"))


@query(
    "sink_attrs",
    """SELECT d.doc_id, d.lang, coalesce(l.quality * 1000 + l.toxic, d.n_chars)::BIGINT AS n_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def sink_attrs(spark, sf_dir):
    """Updated attributes written as a new snapshot and read back."""
    c = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    updates = labels.select("doc_id", (F.col("quality") * 1000 + F.col("toxic")).alias("n_chars"))
    updated = update_attributes(c, updates).attributes().select("doc_id", "lang", "n_chars")
    return persist_attributes(updated, new_folder(spark, "attrs"))
