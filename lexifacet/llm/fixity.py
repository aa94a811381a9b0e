"""Merkle audit of two replicas of an archive of web records.

Records stand in the order of ``page_id``. A range of ``WIDTH`` consecutive ids is a leaf
range: its digest covers, in order, each record's id, its offset within the range, its
length and its SHA-256. ``WIDTH`` ranges make a node, as many nodes the next, up to ranges of
``WIDTH ** LEVELS`` ids, whose nodes are the roots. Ranges are given by ids, not by counts, so
a lost or added record moves nothing beyond its own range. Roots are compared first; then
only children of differing nodes, level by level, down to the records.

All by column functions; a node has at most ``WIDTH`` children and no task sees more of the archive
than its ranges. What the audit compares is digests; records are hashed once per replica.

Nulls: null url and html count as empty; a record with a null id belongs to a range of
its own. Repeated ids are told apart by their number among records of that id, ordered by
digest. A record is reported as 'changed', 'missing' (in the second replica) or 'added'.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

LEVELS = 3
WIDTH = 64
#: Ids per archive file; offsets of records count from the start of their file.
FILE_IDS = 4096


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of one archive record."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def manifest(records: DataFrame) -> DataFrame:
    """(page_id, number, file, offset, length, digest) of records (page_id, record)."""
    digests = records.select("page_id", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    return (
        digests.withColumn("file", F.floor(F.col("page_id") / FILE_IDS))
        .withColumn("offset", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
        .withColumn("number", F.row_number().over(Window.partitionBy("file", "page_id").orderBy("digest")))
    )


def _digest_of(*parts: Column) -> Column:
    """SHA-256 over the rows of a group in order of the first part, each named by all parts."""
    rows = F.array_sort(F.collect_list(F.struct(*parts)))
    lines = F.transform(rows, lambda r: F.concat_ws(":", *[F.coalesce(r[f"col{i + 1}"].cast("string"), F.lit("")) for i in range(len(parts))]))
    return F.sha2(F.array_join(lines, "\n"), 256)


def tree(listed: DataFrame) -> list[DataFrame]:
    """Node tables (node, digest), leaf ranges first and roots last."""
    leaf = F.floor(F.col("page_id") / WIDTH)
    begin = F.min("offset").over(Window.partitionBy("file", leaf))
    rows = listed.withColumn("node", leaf).withColumn("within", F.col("offset") - begin)
    named = [F.col(c) for c in ("page_id", "number", "within", "length", "digest")]
    named = [c.alias(f"col{i + 1}") for i, c in enumerate(named)]
    levels = [settled(rows.groupBy("node").agg(_digest_of(*named).alias("digest")))]
    while len(levels) < LEVELS:
        child = levels[-1].withColumn("parent", F.floor(F.col("node") / WIDTH))
        up = child.groupBy("parent").agg(_digest_of(F.col("node").alias("col1"), F.col("digest").alias("col2")).alias("digest"))
        levels.append(settled(up.withColumnRenamed("parent", "node")))
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per differing record of two manifests: page_id, number, status, file, and
    offset, length and digest in either replica (null where it is missing)."""
    first, second = settled(first), settled(second)
    ours, theirs = tree(first), tree(second)
    suspects = None
    for a, b in zip(reversed(ours), reversed(theirs)):
        if suspects is not None:
            inside = suspects.withColumnRenamed("node", "above")
            a, b = [
                x.join(inside, F.floor(x["node"] / WIDTH).eqNullSafe(inside["above"]), "left_semi") for x in (a, b)
            ]
        b = b.withColumnsRenamed({"node": "b_node", "digest": "b_digest"})
        both = a.join(b, a["node"].eqNullSafe(b["b_node"]), "full_outer")
        odd = both.where(~F.col("digest").eqNullSafe(F.col("b_digest")))
        suspects = settled(odd.select(F.coalesce("node", "b_node").alias("node")).distinct())
    bad = suspects
    a, b = [
        x.join(bad, F.floor(x["page_id"] / WIDTH).eqNullSafe(bad["node"]), "left_semi").select([F.col(c).alias(p + c) for c in x.columns])
        for x, p in ((first, ""), (second, "second_"))
    ]
    same = a["page_id"].eqNullSafe(b["second_page_id"]) & (a["number"] == b["second_number"])
    both = a.join(b, same, "full_outer")
    status = F.when(F.col("number").isNull(), "added").when(F.col("second_number").isNull(), "missing").otherwise("changed")
    return both.where(~F.col("digest").eqNullSafe(F.col("second_digest"))).select(
        F.coalesce("page_id", "second_page_id").alias("page_id"),
        F.coalesce("number", "second_number").cast("bigint").alias("number"),
        status.alias("status"),
        F.coalesce("file", "second_file").alias("file"),
        "offset",
        "length",
        "digest",
        "second_offset",
        "second_length",
        "second_digest",
    )


def records_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def damaged_replica(pages: DataFrame) -> DataFrame:
    """The records of a second copy with known damage, chosen by the md5 of the id: of 256
    pages about four have a changed byte, one lost its record, one has lost its tail."""
    lot = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    record = F.col("record")
    half = F.floor(F.octet_length("record") / 2).cast("int")
    flipped = F.concat(F.substring(record, F.lit(1), half), F.lit("?").cast("binary"), F.substring(record, half + 2, F.octet_length("record")))
    cut = F.substring(record, F.lit(1), F.octet_length("record") - 4)
    rows = records_of(pages).withColumn("lot", F.coalesce(lot, F.lit("ff"))).where("lot <> '10'")
    return rows.select("page_id", F.when(F.col("lot").between("20", "23"), flipped).when(F.col("lot") == "30", cut).otherwise(record).alias("record"))


AUDIT_SQL = r"""
WITH r AS (
  SELECT page_id, left(md5(CAST(page_id AS VARCHAR)), 2) AS lot, floor(page_id / 4096)::BIGINT AS file,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
      || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
      || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
o AS (SELECT *, sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS UNBOUNDED PRECEDING) - strlen(record) AS a,
    sum(CASE lot WHEN '10' THEN 0 WHEN '30' THEN strlen(record) - 4 ELSE strlen(record) END)
      OVER (PARTITION BY file ORDER BY page_id ROWS UNBOUNDED PRECEDING)
      - CASE lot WHEN '10' THEN 0 WHEN '30' THEN strlen(record) - 4 ELSE strlen(record) END AS b
  FROM r)
SELECT page_id, CAST(1 AS BIGINT) AS number, CASE lot WHEN '10' THEN 'missing' ELSE 'changed' END AS status, file,
  CAST(a AS BIGINT) AS offset, CAST(strlen(record) AS BIGINT) AS length,
  CASE WHEN lot <> '10' THEN CAST(b AS BIGINT) END AS second_offset,
  CASE lot WHEN '10' THEN NULL WHEN '30' THEN CAST(strlen(record) - 4 AS BIGINT) ELSE CAST(strlen(record) AS BIGINT) END AS second_length,
  sha256(record) AS digest
FROM o WHERE lot IN ('10', '30') OR lot BETWEEN '20' AND '23'
"""
