"""Word tables that grow: documents are added, replaced and deleted without writing everything anew.

The tables are those of :mod:`postings`, in parts. A change is one part: the rows of the new documents, the ids
of those that are gone, and, in ``terms``, counts of both (those that are gone count negative), so word statistics stay
sums. The manifest names the parts; a change counts as a whole or not at all.

``postings``  part, bucket | token, id, field, positions, first
``terms``     part, bucket | token, docs, hits
``docs``      part, bucket | id, attributes, _len_i       bucket of the id
``gone``      part | id                                   ids whose rows in earlier parts no longer count

Searching joins the ids that are gone against the rows of the query's words only. :func:`compact` rewrites the buckets that
changes have touched, in one part that stands for them from then on; other buckets stay where they are. Old
files are left for readers that still use them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from ..functions import text as T
from . import manifest
from .collection import Collection
from .literal import small_table
from .postings import IndexedCollection, bucket_of, terms_of_postings, write_buckets, write_field_postings

#: Layout of the written tables.
FORMAT = 2


def create_segments(collection: Collection, path: str, buckets: int = 64) -> None:
    """Begin growing word tables under ``path`` with the documents of ``collection``."""
    columns = [("format", "int"), ("buckets", "int"), ("id", "string"), ("fields", "string")]
    row = (FORMAT, buckets, collection.id, json.dumps(list(collection.fields)))
    small_table(collection.df.sparkSession, columns, [row]).coalesce(1).write.mode("errorifexists").parquet(f"{path}/settings")
    _change(open_segments(collection, path), collection, None, "created")


def add_documents(collection: Collection, path: str) -> None:
    """Add the documents of ``collection``; those whose id is there already are replaced."""
    now = open_segments(collection, path)
    known = now.df.join(collection.df.select(collection.id), collection.id, "left_semi").select(collection.id)
    _change(now, collection, known, "added")


def delete_documents(collection: Collection, path: str, ids: DataFrame) -> None:
    """Delete documents; ``ids`` has the id column. Unknown ids are no error."""
    now = open_segments(collection, path)
    known = now.df.join(ids.select(collection.id), collection.id, "left_semi").select(collection.id)
    _change(now, None, known, "deleted")


def _change(now: SegmentedCollection, new: Collection | None, gone: DataFrame | None, kind: str) -> None:
    spark, path, id = now.spark, now.path, now.id
    part = manifest.new_part()
    terms: list[DataFrame] = []
    touched: set[int] = set()
    if new is not None:
        written = write_field_postings(new, f"{path}/postings/part={part}", now.buckets)
        lengths = {f"_len_{i}": F.size(T.tokenize(f)) for i, f in enumerate(new.fields)}
        docs = new.rows().withColumns(lengths).select(*now.docs_schema().fieldNames())
        write_buckets(docs, f"{path}/docs/part={part}", now.id_bucket(), id)
        terms.append(terms_of_postings(written))
    if gone is not None:
        gone.write.parquet(f"{path}/gone/part={part}")
        gone = spark.read.schema(gone.schema).parquet(f"{path}/gone/part={part}")
        taken = now.terms_of_documents(gone)
        terms.append(taken.select("token", (-F.col("docs")).alias("docs"), (-F.col("hits")).alias("hits")))
        touched |= {now.buckets + r.b for r in gone.select(now.id_bucket().alias("b")).distinct().collect()}
    every = terms[0] if len(terms) == 1 else terms[0].unionByName(terms[1])
    write_buckets(every, f"{path}/terms/part={part}", bucket_of(F.col("token"), now.buckets), "token")
    manifest.commit(spark, path, part, kind, touched | now.written(part))


def compact(collection: Collection, path: str) -> None:
    """Rewrite the buckets that more than one part has rows in, or from which rows are gone."""
    now = open_segments(collection, path)
    holders: dict[int, int] = {}
    for p in now.parts:
        for b in now.live_buckets(p):
            holders[b] = holders.get(b, 0) + 1
    touched = {b for b, n in holders.items() if n > 1} | {b for p in now.deletions() for b in now.live_buckets(p)}
    if not touched:
        return
    part = manifest.new_part()
    by_token, by_id = [b for b in touched if b < now.buckets], [b - now.buckets for b in touched if b >= now.buckets]
    for name in ("postings", "terms"):
        rows = now.table(name).where(F.col("bucket").isin(by_token)).drop("bucket")
        write_buckets(rows, f"{path}/{name}/part={part}", bucket_of(F.col("token"), now.buckets), "token")
    rows = now.documents().where(F.col("bucket").isin(by_id)).drop("bucket")
    write_buckets(rows, f"{path}/docs/part={part}", now.id_bucket(), now.id)
    manifest.commit(now.spark, path, part, "compacted", touched)


@dataclass(frozen=True)
class SegmentedCollection(IndexedCollection):
    """A collection over growing word tables, as they are when it is opened. Token buckets are numbered
    from 0, buckets of ids from ``buckets``."""

    parts: tuple[manifest.Part, ...] = ()
    attr_schema: StructType | None = None

    def docs_schema(self) -> StructType:
        schema = StructType(list(self.attr_schema.fields))
        for i in range(len(self.fields)):
            schema = schema.add(f"_len_{i}", IntegerType())
        return schema

    def id_bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.id), F.lit(self.buckets)).cast("int")

    def written(self, part: str) -> set[int]:
        """The buckets in which a part has rows: at most twice the number of buckets."""
        found = {r.bucket for r in self._read("terms").where(F.col("part") == part).select("bucket").distinct().collect()}
        ids = self._read("docs").where(F.col("part") == part).select("bucket").distinct().collect()
        return found | {self.buckets + r.bucket for r in ids}

    def live_buckets(self, part: manifest.Part) -> frozenset[int]:
        later = [p.buckets for p in self.parts if p.kind == "compacted" and p.number > part.number]
        return part.buckets.difference(*later)

    def deletions(self) -> list[manifest.Part]:
        """Changes whose ``gone`` may still hide rows."""
        return [p for p in self.parts if p.kind in ("added", "deleted") and self.live_buckets(p)]

    def _read(self, name: str) -> DataFrame:
        id = self.attr_schema[self.id]
        schema = {
            "postings": StructType().add("token", StringType()).add(self.id, id.dataType).add("field", IntegerType()).add("positions", ArrayType(IntegerType())).add("first", BooleanType()),
            "terms": StructType().add("token", StringType()).add("docs", LongType()).add("hits", LongType()),
            "docs": self.docs_schema(),
            "gone": StructType().add(self.id, id.dataType),
        }[name]
        schema = schema.add("part", StringType())
        schema = schema if name == "gone" else schema.add("bucket", IntegerType())
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:  # nothing has been written there yet
            return self.spark.createDataFrame([], schema)

    def _live(self, name: str, shift: int = 0) -> DataFrame:
        """Rows of buckets that no compaction has taken over, with the number of their part."""
        rows = self._read(name)
        number, test = F.lit(None).cast("bigint"), F.lit(False)
        for p in self.parts:
            own = sorted(b - shift for b in self.live_buckets(p) if 0 <= b - shift < self.buckets)
            if own:
                here = F.col("part") == p.part
                test = test | (here & F.col("bucket").isin(own))
                number = F.when(here, p.number).otherwise(number)
        return rows.where(test).withColumn("_number", number)

    def _present(self, rows: DataFrame) -> DataFrame:
        """Without the rows of documents that a later change has replaced or deleted."""
        changes = self.deletions()
        if changes:
            number = F.lit(None).cast("bigint")
            for p in changes:
                number = F.when(F.col("part") == p.part, p.number).otherwise(number)
            gone = self._read("gone").where(F.col("part").isin([p.part for p in changes]))
            gone = gone.groupBy(F.col(self.id).alias("_gone")).agg(F.max(number).alias("_last"))
            rows = rows.join(gone, (F.col(self.id) == F.col("_gone")) & (F.col("_number") < F.col("_last")), "left_anti")
        return rows.drop("part", "_number")

    def table(self, name: str) -> DataFrame:
        if name == "postings":
            return self._present(self._live("postings"))
        rows = self._live("terms").groupBy("bucket", "token").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))
        return rows.where("docs > 0").select("token", "docs", "hits", "bucket")

    def terms_of_documents(self, ids: DataFrame) -> DataFrame:
        """(token, docs, hits) of the documents in ``ids`` (id). Positions are only counted, before any join."""
        rows = self._live("postings").withColumn("hits", F.size("positions").cast("long")).drop("positions", "field", "bucket")
        rows = self._present(rows.join(ids, self.id, "left_semi"))
        return rows.groupBy("token").agg(F.count_if("first").alias("docs"), F.sum("hits").alias("hits"))

    def documents(self) -> DataFrame:
        """Id, attributes and lengths of the documents, with the bucket of the id."""
        return self._present(self._live("docs", self.buckets))


def open_segments(collection: Collection, path: str) -> SegmentedCollection:
    """The collection over the parts that count at this moment."""
    spark = collection.df.sparkSession
    written = spark.read.parquet(f"{path}/settings").first()
    found = (written.format, written.id, json.loads(written.fields))
    if found != (FORMAT, collection.id, list(collection.fields)):
        raise ValueError(f"{path} was written as (format, id, fields) {found}")
    kept = collection.df.select(collection.id, *collection.own_attrs).schema
    settings = {f.name: getattr(collection, f.name) for f in fields(Collection)}
    parts = tuple(manifest.live(spark, path))
    opened = SegmentedCollection(**settings, path=path, buckets=written.buckets, parts=parts, attr_schema=kept)
    docs = opened.documents().drop("bucket")
    return SegmentedCollection(**{**settings, "df": docs}, path=path, buckets=written.buckets, parts=parts, attr_schema=kept)
