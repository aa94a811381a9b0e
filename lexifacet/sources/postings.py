"""A prepared word table on Parquet, for collections that are searched often.

A search then reads only the partitions of its own words instead of all texts.
Three plain Parquet tables under one path:

``postings``  bucket | token, id, field, positions, first  one row per word of a document field
``docs``      id, attributes, _len_i                attributes and field lengths
``terms``     bucket | token, docs, hits            collection-wide word statistics

``bucket`` is a hash of the token. The exchange before writing is a rebalance, which
adaptive execution splits where a partition is too large: a word in a third of all
documents ends up in many files written by many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from ..functions import hits as H
from ..functions import text as T
from ..functions.frames import compute_once
from .collection import Collection
from .literal import small_table


#: Layout of the written tables.
FORMAT = 2


#: Tokens sorted at a time (a longer document counts as one), and rows of a word handed back to Spark at a time.
SORTED_TOKENS, OUT_ROWS = 1_000_000, 100_000


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """Ids and token lists of runs of documents that have few enough tokens together."""
    ids, *fields = batch.columns
    upto = np.cumsum(sum(pc.fill_null(pc.list_value_length(f), 0).to_numpy(zero_copy_only=False) for f in fields), dtype=np.int64)
    at = 0
    while at < len(ids):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + SORTED_TOKENS, side="right")))
        yield ids.slice(at, end - at), [f.slice(at, end - at) for f in fields]
        at = end


def _cut(batches: Iterator[pa.RecordBatch], id: str) -> Iterator[pa.RecordBatch]:
    """Rows (id, tokens of each field) to rows (token, places), a place being (id, field, positions, first): the tokens
    as numbers, sorted by word, document and field, and cut where one of them changes. The sort is stable, so
    positions ascend."""
    for ids, fields in (piece for batch in batches for piece in _pieces(batch)):
        flat = pa.concat_arrays([f.flatten() for f in fields])
        if not len(flat):
            continue
        docs, at = [], []
        for f in fields:
            sizes = pc.fill_null(pc.list_value_length(f), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            docs.append(np.repeat(np.arange(len(ids)), sizes))
            at.append(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        field = np.repeat(np.arange(len(fields)), [len(d) for d in docs])
        doc, at = np.concatenate(docs), np.concatenate(at).astype(np.int32)
        words = flat.dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        key = (code * len(ids) + doc) * len(fields) + field
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        ends = np.append(starts[1:], len(key))
        rows, code = order[starts], code[order[starts]]
        first = np.diff(key[starts] // len(fields), prepend=-1) != 0
        for low in range(0, len(starts), OUT_ROWS):
            high = min(low + OUT_ROWS, len(starts))
            offsets = np.append(starts[low:high], ends[high - 1]) - starts[low]
            positions = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(at[starts[low] : ends[high - 1]]))
            some = rows[low:high]
            columns = [ids.take(pa.array(doc[some])), pa.array(field[some], pa.int32()), positions, pa.array(first[low:high])]
            cuts = np.flatnonzero(np.diff(code[low:high], prepend=-1))
            tokens = words.dictionary.take(pa.array(code[low + cuts]))
            places = pa.StructArray.from_arrays(columns, [id, "field", "positions", "first"])
            places = pa.ListArray.from_arrays(pa.array(np.append(cuts, high - low), pa.int32()), places)
            yield pa.RecordBatch.from_arrays([tokens, places], ["token", "places"])


def field_postings(collection: Collection) -> DataFrame:
    """(token, places): the places (id, field, positions, first) of a word in some documents that were read together,
    with the field as its number. ``first`` is true in the first field of a document that has the word, so documents of a
    word are a plain count."""
    id = collection.df.schema[collection.id]
    place = StructType([StructField(id.name, id.dataType)]).add("field", IntegerType())
    place = place.add("positions", ArrayType(IntegerType())).add("first", BooleanType())
    tokens = [T.tokenize(f).alias(f"_tok_{i}") for i, f in enumerate(collection.fields)]
    schema = StructType().add("token", StringType()).add("places", ArrayType(place))
    return collection.df.select(collection.id, *tokens).mapInArrow(lambda batches: _cut(batches, id.name), schema)


def terms_of_postings(rows: DataFrame) -> DataFrame:
    """(token, docs, hits) of rows (token, positions, first)."""
    hits = F.sum(F.size("positions").cast("long")).alias("hits")
    return rows.groupBy("token").agg(F.count_if("first").alias("docs"), hits)


def bucket_of(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, path: str, bucket: Column, key: str) -> DataFrame:
    """Write rows, one folder per bucket, sorted by ``key`` inside a file; the rows as written."""
    placed = rows.withColumn("bucket", bucket).hint("rebalance", "bucket").sortWithinPartitions("bucket", key)
    return _write(placed, path)


def write_field_postings(collection: Collection, path: str, buckets: int) -> DataFrame:
    """The same for the postings of a collection. Words are exchanged and sorted with many places in a row, which
    become rows of their own after it, in the same order."""
    placed = field_postings(collection).withColumn("bucket", bucket_of(F.col("token"), buckets))
    placed = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token")
    return _write(placed.select("token", F.inline("places"), "bucket"), path)


def _write(placed: DataFrame, path: str) -> DataFrame:
    placed.write.mode("errorifexists").partitionBy("bucket").parquet(path)
    return placed.sparkSession.read.schema(placed.schema).parquet(path).drop("bucket")


def write_postings(collection: Collection, path: str, buckets: int = 64) -> None:
    """Write the three tables and their settings under ``path``, which must not exist. Words are
    counted in the written postings, so texts are cut once."""
    written = write_field_postings(collection, f"{path}/postings", buckets)
    write_buckets(terms_of_postings(written), f"{path}/terms", bucket_of(F.col("token"), buckets), "token")
    lengths = {f"_len_{i}": F.size(T.tokenize(f)) for i, f in enumerate(collection.fields)}
    docs = collection.rows().withColumns(lengths).drop(*collection.fields)
    docs.write.mode("errorifexists").parquet(f"{path}/docs")
    columns = [("format", "int"), ("buckets", "int"), ("id", "string"), ("fields", "string")]
    row = (FORMAT, buckets, collection.id, json.dumps(list(collection.fields)))
    settings = small_table(collection.df.sparkSession, columns, [row])
    settings.coalesce(1).write.mode("errorifexists").parquet(f"{path}/settings")


@dataclass(frozen=True)
class IndexedCollection(Collection):
    """A collection whose hits come from written postings instead of raw text."""

    path: str = ""
    buckets: int = 64

    def __post_init__(self):
        for name in ("fields", "attrs", "sides", "overlays"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        object.__setattr__(self, "stopwords", frozenset(self.stopwords))

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def rows(self) -> DataFrame:
        return self.df.select(self.id, *self.own_attrs, *[f"_len_{i}" for i in range(len(self.fields))])

    def raw_texts(self) -> list[Column]:
        return []

    def table(self, name: str) -> DataFrame:
        """The rows of ``postings`` or ``terms``, with their bucket."""
        return self.spark.read.parquet(f"{self.path}/{name}")

    def of_words(self, table: str, test: H.WordTest) -> DataFrame:
        """Rows of the words that pass ``test``; known words prune the buckets read."""
        df = self.table(table)
        forms = test.forms
        if forms:
            df = df.filter(F.col("bucket").isin([bucket_of(F.lit(w), self.buckets) for w in forms]))
        return df.filter(test(F.col("token"))).drop("bucket")

    def hit_rows(
        self, test: H.WordTest, narrow: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """As for raw text. One group holds the hits of one document."""
        lists = [
            F.collect_list(
                F.when(F.col("field") == i, F.struct("positions", F.col("token").alias("w")))
            ).alias(f"_rows_{i}")
            for i in range(len(self.fields))
        ]
        grouped = self.of_words("postings", test).groupBy(self.id).agg(*lists)

        def ordered(rows: Column) -> Column:
            every = F.flatten(
                F.transform(
                    rows,
                    lambda r: F.transform(
                        r["positions"], lambda p: F.struct(p.alias("p"), r["w"].alias("w"))
                    ),
                )
            )
            return F.sort_array(every)

        hits = {f"_hits_{i}": ordered(F.col(f"_rows_{i}")) for i in range(len(self.fields))}
        found = compute_once(grouped, hits).select(self.id, *hits)
        docs = self.rows() if narrow is None else narrow(self.rows())
        return docs.join(found, self.id)

    def terms(self, test: H.WordTest | None = None) -> DataFrame:
        if test is None:
            return self.table("terms").drop("bucket")
        return self.of_words("terms", test)

    def terms_of(self, asked: DataFrame) -> DataFrame:
        """The written vocabulary has one row per token already."""
        return self.terms().join(asked, "token", "left_semi")

    def document_words(self) -> DataFrame:
        return self.table("postings").select(self.id, "token")

    def word_docs(self, words: DataFrame) -> DataFrame:
        return self.terms().join(words, "token", "left_semi").select("token", "docs")

    def with_tokens(self, wanted: DataFrame) -> DataFrame:
        """The tokens of the wanted documents only, put together from their postings."""
        rows = self.table("postings").drop("bucket")
        rows = rows.join(wanted.select(self.id).distinct(), self.id, "left_semi")
        lists = [
            F.collect_list(F.when(F.col("field") == i, F.struct("positions", "token"))).alias(f"_rows_{i}")
            for i in range(len(self.fields))
        ]

        def ordered(lists: Column) -> Column:
            placed = F.transform(
                lists,
                lambda r: F.transform(
                    r["positions"], lambda p: F.struct(p.alias("p"), r["token"].alias("w"))
                ),
            )
            return F.transform(F.sort_array(F.flatten(placed)), lambda x: x["w"])

        tokens = [ordered(F.col(f"_rows_{i}")).alias(f"_tok_{i}") for i in range(len(self.fields))]
        return rows.groupBy(self.id).agg(*lists).select(self.id, *tokens).join(wanted, self.id)

    def word_totals(self, tests) -> DataFrame:
        """As for raw text, from the word tables. Several tokens of one test may meet
        in a document, so those documents are counted by id."""
        columns = []
        for k, test in enumerate(tests):
            docs, hits = f"docs_{k}", f"hits_{k}"
            if test.forms is not None and len(test.forms) == 1:
                of = self.of_words("terms", test)
                counted = F.sum("docs"), F.sum("hits")
            else:
                of = self.of_words("postings", test)
                of = of.groupBy(self.id).agg(F.sum(F.size("positions")).alias("n"))
                counted = F.count(F.lit(1)), F.sum("n")
            zero = F.lit(0).cast("long")
            one = of.agg(
                F.struct(*[F.coalesce(c, zero).alias(n) for c, n in zip(counted, (docs, hits))]).alias("s")
            )
            columns.append(one.scalar().alias(f"_{k}"))
        row = self.spark.range(0, 1, 1, 1).select(*columns)
        return row.select(*[f"_{k}.*" for k in range(len(columns))])

    def stats(self, tests=()) -> DataFrame:
        """One row from the small tables; no text is read."""
        total = sum(F.col(f"_len_{i}") for i in range(len(self.fields)))
        length = F.coalesce(F.sum(total), F.lit(0)).alias("total_len")
        size = self.df.agg(F.struct(F.count(F.lit(1)).alias("n_docs"), length).alias("s"))
        tests = list(tests)
        sized = self.word_totals(tests).withColumn("_size", size.scalar())
        docs = [F.col(f"docs_{k}").alias(f"df_{k}") for k in range(len(tests))]
        return sized.select("_size.*", *docs)


def open_postings(collection: Collection, path: str) -> IndexedCollection:
    """The collection over a path written by :func:`write_postings`, read as its
    settings say. Another format, id or list of fields is an error."""
    spark = collection.df.sparkSession
    written = spark.read.parquet(f"{path}/settings").first()
    found = (written.format, written.id, json.loads(written.fields))
    if found != (FORMAT, collection.id, list(collection.fields)):
        raise ValueError(f"{path} was written as (format, id, fields) {found}")
    docs = spark.read.parquet(f"{path}/docs")
    settings = {f.name: getattr(collection, f.name) for f in fields(Collection)}
    return IndexedCollection(**{**settings, "df": docs}, path=path, buckets=written.buckets)
