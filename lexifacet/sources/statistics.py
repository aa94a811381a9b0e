"""Collection-wide word statistics, kept beside a collection of plain texts.

Ranking by BM25 needs the number of documents, their length and in how many of them each query word occurs. Kept here,
they cost a read of the buckets of the query's words in place of a second pass over all texts. They are sums, so
rows that arrive or go are counted alone and added as a part of their own (:func:`add_statistics`,
:func:`remove_statistics`); :func:`merge_statistics` makes one part of many.

``terms``  part, bucket | token, docs, hits       signed: a part of removed rows counts negative
``sizes``  part | n_docs, then tokens per field   signed as well

Which parts count is written last, in the manifest. The numbers are those of the collection as long as every
change of its rows is added: that is the writer's business, as with any index.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hits as H
from ..functions import text as T
from ..functions.frames import compute_once
from . import manifest
from .collection import Collection
from .literal import small_table
from .postings import bucket_of

#: Layout of the written tables.
FORMAT = 1
TERMS = "token string, docs bigint, hits bigint, part string, bucket int"


def write_statistics(collection: Collection, path: str, buckets: int = 64) -> None:
    """Begin statistics of a collection under ``path``, where none may be yet."""
    columns = [("format", "int"), ("buckets", "int"), ("id", "string"), ("fields", "string")]
    row = (FORMAT, buckets, collection.id, json.dumps(list(collection.fields)))
    small_table(collection.df.sparkSession, columns, [row]).coalesce(1).write.mode("errorifexists").parquet(f"{path}/settings")
    _write_part(collection, path, buckets, 1)


def add_statistics(collection: Collection, path: str) -> None:
    """Add documents that have arrived: ``collection`` holds those alone."""
    _write_part(collection, path, _buckets(collection, path), 1)


def remove_statistics(collection: Collection, path: str) -> None:
    """Take off documents that have gone: ``collection`` holds those alone, as they were added."""
    _write_part(collection, path, _buckets(collection, path), -1)


def _buckets(collection: Collection, path: str) -> int:
    """The number of buckets of what was written; another format, id or list of fields is an error."""
    written = collection.df.sparkSession.read.parquet(f"{path}/settings").first()
    found = (written.format, written.id, json.loads(written.fields))
    if found != (FORMAT, collection.id, list(collection.fields)):
        raise ValueError(f"{path} was written as (format, id, fields) {found}")
    return written.buckets


def _write_part(collection: Collection, path: str, buckets: int, sign: int) -> None:
    part = manifest.new_part()
    terms = collection.terms().select("token", (sign * F.col("docs")).alias("docs"), (sign * F.col("hits")).alias("hits"))
    _write_terms(terms, path, part, buckets)
    lengths = {f"_len_{i}": F.size(T.tokenize(f)) for i, f in enumerate(collection.fields)}
    rows = compute_once(collection.df.select(*collection.fields), lengths)
    sums = [F.coalesce(sign * F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in lengths]
    rows.agg((sign * F.count(F.lit(1))).alias("n_docs"), *sums).write.parquet(f"{path}/sizes/part={part}")
    manifest.commit(collection.df.sparkSession, path, part, "rows" if sign > 0 else "removed")


def _write_terms(terms: DataFrame, path: str, part: str, buckets: int) -> None:
    placed = terms.withColumn("bucket", bucket_of(F.col("token"), buckets))
    ordered = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token")
    ordered.write.partitionBy("bucket").parquet(f"{path}/terms/part={part}")


def merge_statistics(collection: Collection, path: str) -> None:
    """One part in place of all that count now. Readers of the old parts are not disturbed."""
    spark = collection.df.sparkSession
    counted = open_statistics(collection, path)
    part = manifest.new_part()
    _write_terms(counted.terms(), path, part, counted.buckets)
    counted.sizes().write.parquet(f"{path}/sizes/part={part}")
    manifest.commit(spark, path, part, "merged", replaces=counted.parts)


@dataclass(frozen=True)
class CountedCollection(Collection):
    """A collection of plain texts that knows its word statistics."""

    path: str = ""
    buckets: int = 64
    parts: tuple[str, ...] = ()

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def sizes(self) -> DataFrame:
        """One row: n_docs and tokens per field, ``_len_i``."""
        names = ["n_docs", *[f"_len_{i}" for i in range(len(self.fields))]]
        schema = ", ".join(f"{n} bigint" for n in names)
        rows = self.spark.read.schema(f"{schema}, part string").parquet(f"{self.path}/sizes").where(F.col("part").isin(list(self.parts)))
        return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])

    def _of(self, forms: Iterable[str] | None) -> DataFrame:
        """Rows of the counting parts; known tokens prune the buckets that are read."""
        df = self.spark.read.schema(TERMS).parquet(f"{self.path}/terms").where(F.col("part").isin(list(self.parts)))
        if forms is None:
            return df
        forms = list(forms)
        df = df.where(F.col("bucket").isin([bucket_of(F.lit(w), self.buckets) for w in forms]))
        return df.where(F.col("token").isin(forms))

    def terms_of(self, asked: DataFrame) -> DataFrame:
        """The written vocabulary has one row per token already."""
        return self.terms().join(asked, "token", "left_semi")

    def terms(self, test: H.WordTest | None = None) -> DataFrame:
        rows = self._of(None if test is None else test.forms)
        rows = rows if test is None else rows.where(test(F.col("token")))
        sums = rows.groupBy("token").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))
        return sums.where("docs > 0")

    def word_docs(self, words: DataFrame) -> DataFrame:
        return self.terms().join(words, "token", "left_semi").select("token", "docs")

    def word_totals(self, tests: Iterable[H.WordTest]) -> DataFrame:
        """As for plain texts. A test of one token is looked up; where several tokens of a test may meet in a
        document, its documents are counted in the texts."""
        tests = list(tests)
        known = {k: t.forms[0] for k, t in enumerate(tests) if t.forms is not None and len(t.forms) == 1}
        other = [k for k in range(len(tests)) if k not in known]
        row = self.spark.range(0, 1, 1, 1)
        if known:
            sums: list[Column] = []
            for k, token in known.items():
                for name in ("docs", "hits"):
                    one = F.sum(F.when(F.col("token") == token, F.col(name)).otherwise(0))
                    sums.append(F.coalesce(one, F.lit(0)).cast("long").alias(f"{name}_{k}"))
            found = self._of(dict.fromkeys(known.values())).agg(F.struct(*sums).alias("s"))
            row = row.withColumn("_known", found.scalar())
        if other:
            counted = super().word_totals([tests[k] for k in other])
            row = row.withColumn("_other", counted.select(F.struct(*counted.columns).alias("s")).scalar())
        columns = []
        for k in range(len(tests)):
            source, at = ("_known", k) if k in known else ("_other", other.index(k))
            columns += [F.col(source)[f"{n}_{at}"].alias(f"{n}_{k}") for n in ("docs", "hits")]
        return row.select(*columns)

    def stats(self, tests: Iterable[H.WordTest] = ()) -> DataFrame:
        """One row as for plain texts; no text is read for tests of one token."""
        tests = list(tests)
        lengths = sum(F.col(f"_len_{i}") for i in range(len(self.fields)))
        size = self.sizes().select(F.struct("n_docs", lengths.alias("total_len")).alias("s"))
        docs = [F.col(f"docs_{k}").alias(f"df_{k}") for k in range(len(tests))]
        return self.word_totals(tests).withColumn("_size", size.scalar()).select("_size.*", *docs)


def open_statistics(collection: Collection, path: str) -> CountedCollection:
    """The collection with the statistics that count at this moment."""
    settings = {f.name: getattr(collection, f.name) for f in fields(Collection)}
    parts = tuple(p.part for p in manifest.live(collection.df.sparkSession, path))
    return CountedCollection(**settings, path=path, buckets=_buckets(collection, path), parts=parts)
