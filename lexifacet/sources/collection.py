"""A searchable collection: a DataFrame with column roles."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import hits as H
from ..functions import text as T
from ..functions.frames import compute_once


@dataclass(frozen=True)
class FieldHits:
    """One field of a document during a search: its hits and its length in tokens."""

    name: str
    hits: Column
    length: Column


def one_per_id(values: DataFrame, id: str) -> DataFrame:
    """The values, failing on an id that comes twice. The check is in the id itself, which every
    use reads, so no unread column can take it away."""
    rest = [F.any_value(c).alias(c) for c in values.columns if c != id]
    counted = values.groupBy(id).agg(F.count(F.lit(1)).alias("_n"), *rest)
    twice = F.raise_error(F.concat(F.lit("two updates of id "), F.col(id).cast("string")))
    checked = F.when(F.col("_n") == 1, F.col(id)).otherwise(twice.cast(values.schema[id].dataType))
    return counted.withColumn(id, checked).select(*values.columns)


def replace_values(df: DataFrame, id: str, values: DataFrame) -> DataFrame:
    """Put the columns of ``values`` in place on its ids; other rows stay.

    An equi-join on the id without a hint: Spark broadcasts the values only when
    their known size is below its threshold.
    """
    names = [c for c in values.columns if c != id]
    new = values.select(id, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in names])
    joined = df.join(new, id, "left")
    columns = {
        c: F.when(F.col("_hit"), F.col(f"_new_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c in names
    }
    return joined.withColumns(columns).select(*df.columns)


def forms_of(word: str, wordforms: dict[str, str]) -> list[str]:
    """The tokens that stand for a query word: all with its normal form."""
    normal = wordforms.get(word, word)
    found = {t for t, n in wordforms.items() if n == normal}
    if normal not in wordforms:
        found.add(normal)
    return sorted(found)


@dataclass(frozen=True)
class Lexicon:
    """Text settings without rows: enough to read query words."""

    stopwords: frozenset[str] = frozenset()
    wordforms: dict[str, str] = field(default_factory=dict, hash=False)

    def forms(self, word: str) -> list[str]:
        return forms_of(word, self.wordforms)


#: Words of 64 bits in a table of marks (32 kB).
MARK_WORDS = 4096


def _mark(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(64 * MARK_WORDS))


def marks(asked: DataFrame) -> DataFrame:
    """One row, one array of ``MARK_WORDS`` longs: a bit for each token of ``asked`` (token)."""
    at = _mark(F.col("token"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    found = asked.select(F.shiftright(at, 6).alias("id"), bit.alias("bit"))
    found = found.groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = asked.sparkSession.range(0, MARK_WORDS, 1, 1).join(found, "id", "left")
    row = F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return every.agg(F.sort_array(F.collect_list(row))["bits"].alias("marks"))


def is_marked(marks: Column, token: Column) -> Column:
    """Whether the token's bit is set."""
    at = _mark(token)
    return F.getbit(F.get(marks, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


@dataclass(frozen=True)
class Collection:
    """Rows with one id column, ordered text fields and attributes.

    Attributes may stand apart from the text: ``sides`` are frames of the id and
    some attributes, at most one row per id, and ``overlays`` are replaced values.
    Both are joined on the id after matching, when the text columns are gone, so
    a text never goes through an exchange because of an attribute.

    ``stopwords`` are ignored in query texts (token positions stay as they are);
    ``wordforms`` maps a token to its normal form, so a query word meets every
    token with the same normal form.
    """

    name: str
    df: DataFrame
    id: str
    fields: tuple[str, ...] = ()
    attrs: tuple[str, ...] = ()
    stopwords: frozenset[str] = frozenset()
    wordforms: dict[str, str] = field(default_factory=dict, hash=False)
    sides: tuple[DataFrame, ...] = ()
    overlays: tuple[DataFrame, ...] = ()

    def __post_init__(self):
        for name in ("fields", "attrs", "sides", "overlays"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        object.__setattr__(self, "stopwords", frozenset(self.stopwords))
        known = {c for frame in (self.df, *self.sides) for c in frame.columns}
        missing = [c for c in (self.id, *self.fields, *self.attrs) if c not in known]
        if missing:
            raise ValueError(f"collection {self.name}: no such column {missing}")

    # -- query words -----------------------------------------------------------

    def forms(self, word: str) -> list[str]:
        return forms_of(word, self.wordforms)

    # -- attributes ------------------------------------------------------------

    @property
    def own_attrs(self) -> list[str]:
        """Attributes that stand beside the text."""
        return [a for a in self.attrs if a in self.df.columns]

    @property
    def settled_attrs(self) -> list[str]:
        """Own attributes without replaced values: a filter on them can go to the scan."""
        replaced = {c for frame in self.overlays for c in frame.columns}
        return [a for a in self.own_attrs if a not in replaced]

    def finish(self, df: DataFrame) -> DataFrame:
        """Join the attributes that stand apart and put replaced values in place."""
        for side in self.sides:
            names = [c for c in side.columns if c in self.attrs]
            df = df.join(side.select(self.id, *names), self.id, "left")
            for name in names:
                kind = side.schema[name].dataType
                if isinstance(kind, ArrayType):
                    df = df.withColumn(name, F.coalesce(name, F.array().cast(kind)))
        for frame in self.overlays:
            df = replace_values(df, self.id, frame)
        return df

    def attributes(self) -> DataFrame:
        """Id and current attributes of every document; no text is read."""
        df = self.finish(self.df.select(self.id, *self.own_attrs))
        return df.select(self.id, *self.attrs)

    # -- frames ----------------------------------------------------------------

    def rows(self) -> DataFrame:
        """Id, own attributes and fields, nothing else: the scan reads only these."""
        return self.df.select(self.id, *self.own_attrs, *self.fields)

    def raw_texts(self) -> list[Column]:
        """Lower-cased raw fields: a token can only be in a text that contains it, a
        test far cheaper than tokenizing."""
        return [F.lower(F.col(f)) for f in self.fields]

    def hit_rows(
        self, test: H.WordTest, narrow: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """One row per document: id, attributes, ``_hits_i`` and ``_len_i`` per field.

        ``narrow`` filters on attributes or raw fields before any tokenizing.
        """
        df = self.rows()
        if narrow is not None:
            df = narrow(df)
        once = {f"_tok_{i}": T.tokenize(f) for i, f in enumerate(self.fields)}
        df = df.withColumns(once)
        out = {}
        for i in range(len(self.fields)):
            out[f"_hits_{i}"] = H.hits(F.col(f"_tok_{i}"), test)
            out[f"_len_{i}"] = F.size(f"_tok_{i}")
        return compute_once(df, out).drop(*once, *self.fields)

    def field_hits(self) -> list[FieldHits]:
        return [
            FieldHits(f, F.col(f"_hits_{i}"), F.col(f"_len_{i}"))
            for i, f in enumerate(self.fields)
        ]

    def all_tokens(self) -> Column:
        """Tokens of all fields of a row in one array."""
        arrays = [T.tokenize(f) for f in self.fields]
        return F.concat(*arrays) if len(arrays) > 1 else arrays[0]

    def stats(self, tests: Iterable[H.WordTest] = ()) -> DataFrame:
        """One row: n_docs, total_len, and ``df_k`` documents per given test."""
        tests = list(tests)
        every = compute_once(self.df.select(*self.fields), {"_all": self.all_tokens()})
        columns = {"_len": F.size("_all").cast("long")}
        if tests:
            columns["_own"] = F.filter("_all", H.any_test(tests))
        rows = every.select(*[c.alias(n) for n, c in columns.items()])
        flags = [F.count_if(F.exists("_own", t)).alias(f"df_{k}") for k, t in enumerate(tests)]
        total = F.coalesce(F.sum("_len"), F.lit(0)).alias("total_len")
        return rows.agg(F.count(F.lit(1)).alias("n_docs"), total, *flags)


    def terms(self, test: H.WordTest | None = None) -> DataFrame:
        """(token, docs, hits) of the vocabulary, or of the tokens that pass ``test``.

        A document contributes one row per distinct token, so documents are counted
        by a plain count that combines before the exchange.
        """
        tokens = self.all_tokens()
        counts = H.term_counts(tokens if test is None else F.filter(tokens, test))
        rows = self.df.select(F.inline(counts))
        return rows.groupBy("token").agg(F.count(F.lit(1)).alias("docs"), F.sum("hits").alias("hits"))

    def terms_of(self, asked: DataFrame) -> DataFrame:
        """(token, docs, hits) of the tokens in ``asked`` (token), and of few others.

        Each document tests its tokens against the bits of the asked ones, so no others are
        counted and exchanged but those that share a bit. The bits have a fixed size; with very many
        tokens asked they are all set and let every token through.
        """
        marked = self.df.withColumn("_marks", marks(asked).scalar())
        counts = H.term_counts(F.filter(self.all_tokens(), lambda token: is_marked(F.col("_marks"), token)))
        rows = marked.select(F.inline(counts))
        return rows.groupBy("token").agg(F.count(F.lit(1)).alias("docs"), F.sum("hits").alias("hits"))

    def document_words(self) -> DataFrame:
        """(id, token): the words of each document; a word of two fields may be listed twice."""
        return self.df.select(self.id, F.explode(F.array_distinct(self.all_tokens())).alias("token"))

    def word_docs(self, words: DataFrame) -> DataFrame:
        """(token, docs) for a table of distinct tokens; absent ones are left out.

        Where the words are few they are broadcast and only counts are exchanged.
        """
        known = self.document_words().join(words, "token", "left_semi")
        return known.groupBy("token").agg(F.count(F.lit(1)).alias("docs"))

    def with_tokens(self, wanted: DataFrame) -> DataFrame:
        """Rows of ``wanted`` joined on the id with the tokens per field, ``_tok_i``.

        The semi join leaves only wanted documents to tokenize, and keeps Spark from
        taking the texts for the small side, whose compressed size hides what they are.
        """
        ids = wanted.select(self.id).distinct()
        texts = self.df.select(self.id, *self.fields).join(ids, self.id, "left_semi")
        tokens = [T.tokenize(f).alias(f"_tok_{i}") for i, f in enumerate(self.fields)]
        return texts.select(self.id, *tokens).join(wanted, self.id)

    def word_totals(self, tests: Iterable[H.WordTest]) -> DataFrame:
        """One row: ``docs_k`` and ``hits_k`` of each test over all documents."""
        tests = list(tests)
        own = F.filter(self.all_tokens(), H.any_test(tests))
        rows = compute_once(self.df.select(*self.fields), {"_own": own})
        columns = []
        for k, test in enumerate(tests):
            n = F.size(F.filter("_own", test))
            columns.append(F.count_if(n > 0).alias(f"docs_{k}"))
            columns.append(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(f"hits_{k}"))
        return rows.agg(*columns)


def postings(collection: Collection) -> DataFrame:
    """(id, field, pos, token): one row per token, positions 0-based per field."""
    def rows_of(name: str) -> Column:
        return F.transform(
            T.tokenize(name),
            lambda w, i: F.struct(F.lit(name).alias("field"), i.alias("pos"), w.alias("token")),
        )

    parts = [rows_of(name) for name in collection.fields]
    every = F.concat(*parts) if len(parts) > 1 else parts[0]
    return collection.df.select(collection.id, F.inline(every))


def gathered(side: DataFrame, id: str, side_id: str, value: str, name: str) -> DataFrame:
    """(id, name): the sorted distinct ``value``s of a side table as an array per id.

    Duplicates fall away in map-side partial sets before the exchange.
    """
    return side.groupBy(F.col(side_id).alias(id)).agg(F.array_sort(F.collect_set(value)).alias(name))
