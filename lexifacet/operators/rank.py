"""Weights of matching documents, as Columns over their hits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hits as H
from ..sources.collection import Collection, FieldHits
from .match import Condition, any_of, distinct_words, word_sequence

RANKERS = (
    "proximity_bm25",
    "bm25",
    "none",
    "wordcount",
    "proximity",
    "matchany",
    "fieldmask",
    "head_exact",
    "expr",
)

# The ranker each match mode uses unless it lets the user choose.
MODE_RANKERS = {
    "all": "proximity",
    "any": "matchany",
    "phrase": "proximity",
    "boolean": "none",
    "fullscan": "none",
}

BM25_K1 = 1.2
BM25_B = 0.75


def field_weight(name: str, weights: Mapping[str, int]) -> int:
    return int(weights.get(name, 1))


def positional_weights(fields: Sequence[str], weights: Sequence[int]) -> dict[str, int]:
    """Weights given in field order; fields beyond the list keep weight 1."""
    return dict(zip(fields, weights))


def idf(n_docs: Column, docs: Column, flavour: str) -> Column:
    ratio = (n_docs - docs + 1) / docs if flavour == "normalized" else n_docs / docs
    return F.when(docs > 0, F.greatest(F.ln(ratio), F.lit(0.0))).otherwise(0.0)


@dataclass(frozen=True)
class Ranking:
    """Everything a ranker may need about one query over one collection."""

    collection: Collection
    tree: Condition
    weights: Mapping[str, int] = field(default_factory=dict)
    idf_flavour: str = "normalized"

    def __post_init__(self):
        sequence = word_sequence(self.tree, self.collection)
        object.__setattr__(
            self, "sequence", [(at, w.test(self.collection)) for at, w in sequence]
        )
        tests = [w.test(self.collection) for w in distinct_words(sequence)]
        object.__setattr__(self, "tests", tests)

    @property
    def fields(self) -> list[FieldHits]:
        return self.collection.field_hits()

    def weight_of(self, f: FieldHits) -> Column:
        return F.lit(field_weight(f.name, self.weights)).cast("long")

    # -- factors -------------------------------------------------------------------
    #
    # Each factor is one column, named by :meth:`_name`, that walks the hits once.
    # Weights are formulas over those columns, so no walk is repeated.

    def is_query_word(self, w: Column) -> Column:
        return any_of([test(w) for test in self.tests])

    def lcs(self, f: FieldHits) -> Column:
        return H.longest_common_run(f.hits, self.sequence).cast("long")

    def hit_count(self, f: FieldHits) -> Column:
        return H.count_hits(f.hits, self.is_query_word).cast("long")

    def word_count(self, f: FieldHits) -> Column:
        found = [H.has_hit(f.hits, test).cast("long") for test in self.tests]
        return reduce(lambda a, b: a + b, found)

    def min_hit_pos(self, f: FieldHits) -> Column:
        own = F.filter(f.hits, lambda h: self.is_query_word(h["w"]))
        return F.get(own, F.lit(0))["p"].cast("long")

    def exact_hit(self, f: FieldHits) -> Column:
        """The field is the query: as long as it, and one run covers it."""
        m = len(self.sequence)
        return (f.length == m) & (self.of(f, "lcs") == m)

    FACTORS = ("lcs", "hit_count", "word_count", "min_hit_pos", "exact_hit")

    def of(self, f: FieldHits, factor: str) -> Column:
        return F.col(self._name(f, factor))

    def _name(self, f: FieldHits, factor: str) -> str:
        return f"_{factor}_{self.collection.fields.index(f.name)}"

    def with_factors(self, df: DataFrame, *names: str) -> DataFrame:
        """Add the named factors of every field; those built on others come last."""
        walked = [n for n in names if n != "exact_hit"]
        df = df.withColumns({self._name(f, n): getattr(self, n)(f) for n in walked for f in self.fields})
        if "exact_hit" in names:
            df = df.withColumns({self._name(f, "exact_hit"): self.exact_hit(f) for f in self.fields})
        return df

    def over_fields(self, term) -> Column:
        return reduce(lambda a, b: a + b, [term(f) for f in self.fields])

    # -- weights -----------------------------------------------------------------

    def proximity(self) -> Column:
        return self.over_fields(lambda f: self.of(f, "lcs") * self.weight_of(f))

    def wordcount(self) -> Column:
        return self.over_fields(lambda f: self.of(f, "hit_count") * self.weight_of(f))

    def matchany(self) -> Column:
        k = len(self.tests) * len(self.fields)

        def one(f):
            score = self.of(f, "word_count") + (self.of(f, "lcs") - 1) * k
            none = F.lit(0).cast("long")
            return F.when(self.of(f, "lcs") > 0, score * self.weight_of(f)).otherwise(none)

        return self.over_fields(one)

    def fieldmask(self) -> Column:
        bits = [
            F.when(self.of(f, "hit_count") > 0, 1 << i).otherwise(0) for i, f in enumerate(self.fields)
        ]
        return reduce(lambda a, b: a + b, bits).cast("long")

    def head_exact(self) -> Column:
        def one(f):
            head = F.when(self.of(f, "min_hit_pos") == 0, 2).otherwise(0)
            exact = F.when(self.of(f, "exact_hit"), 1).otherwise(0)
            return (4 * self.of(f, "lcs") + head + exact) * self.weight_of(f)

        return self.over_fields(one) * 1000 + F.col("bm25")

    def bm25(self, stats: Column) -> Column:
        """Integer 0..999 over the ``_tf_k`` columns; ``stats`` is the one-row struct of
        collection statistics."""
        length = self.over_fields(lambda f: f.length).cast("double")
        mean = stats["total_len"] / stats["n_docs"]
        norm = 1 - BM25_B + BM25_B * length / mean
        score = best = F.lit(0.0)
        for k in range(len(self.tests)):
            tf = F.col(f"_tf_{k}")
            docs = stats[f"df_{k}"].cast("double")
            weight = idf(stats["n_docs"].cast("double"), docs, self.idf_flavour)
            gain = weight * tf * (BM25_K1 + 1) / (tf + BM25_K1 * norm)
            score = score + F.when(tf > 0, gain).otherwise(0.0)
            best = best + weight * (BM25_K1 + 1)
        scaled = F.floor(F.round(1000 * score / best, 9))
        clamped = F.least(F.greatest(scaled, F.lit(0)), F.lit(999))
        return F.when(best > 0, clamped).otherwise(0).cast("long")

    def with_bm25(self, df: DataFrame) -> DataFrame:
        """Add ``bm25``. The collection's statistics arrive as a scalar subquery:
        one aggregated row, no join."""
        stats = self.collection.stats(self.tests)
        one = stats.select(F.struct(*stats.columns).alias("stats")).scalar()
        counts = {}
        for k, test in enumerate(self.tests):
            counts[f"_tf_{k}"] = self.over_fields(lambda f: H.count_hits(f.hits, test)).cast("double")
        df = df.withColumns({**counts, "_stats": one})
        return df.withColumn("bm25", self.bm25(F.col("_stats"))).drop("_stats", *counts)

    # Which factors each ranker reads, and whether it reads bm25.
    NEEDS = {
        "proximity": ("lcs",),
        "proximity_bm25": ("lcs",),
        "wordcount": ("hit_count",),
        "matchany": ("lcs", "word_count"),
        "fieldmask": ("hit_count",),
        "head_exact": ("lcs", "min_hit_pos", "exact_hit"),
        "expr": FACTORS,
    }
    WITH_BM25 = ("bm25", "proximity_bm25", "head_exact", "expr")

    def weighted(self, df: DataFrame, ranker: str, expr: tuple[str, str] | None = None) -> DataFrame:
        """Add ``weight`` to a frame of hit rows."""
        kept = df.columns
        df = self.with_factors(df, *self.NEEDS.get(ranker, ()))
        if ranker in self.WITH_BM25:
            df = self.with_bm25(df)
        if ranker == "expr":
            df, weight = self.by_formula(df, *expr)
        elif ranker == "none":
            weight = F.lit(1)
        elif ranker == "bm25":
            weight = F.col("bm25")
        elif ranker == "proximity_bm25":
            weight = self.proximity() * 1000 + F.col("bm25")
        else:
            weight = getattr(self, ranker)()
        return df.select(*kept, weight.cast("long").alias("weight"))

    def by_formula(self, df: DataFrame, per_field: str, per_document: str) -> tuple[DataFrame, Column]:
        """``per_field`` is evaluated for each field over its factors and ``user_weight``
        and summed to ``field_sum``; ``per_document`` sees ``field_sum`` and ``bm25``."""
        for i, f in enumerate(self.fields):
            named = {n: self.of(f, n) for n in self.FACTORS}
            own = df.select(*df.columns, *[c.alias(n) for n, c in named.items()], self.weight_of(f).alias("user_weight"))
            df = own.select(*df.columns, F.expr(per_field).alias(f"_sum_{i}"))
        sums = [F.col(f"_sum_{i}") for i in range(len(self.fields))]
        return df.withColumn("field_sum", reduce(lambda a, b: a + b, sums)), F.expr(per_document)

    def factors(self, df: DataFrame) -> DataFrame:
        """One row per (document, field) with a hit: every ranking factor."""
        df = self.with_bm25(self.with_factors(df, *self.FACTORS))
        rows = F.array(
            *[
                F.struct(F.lit(f.name).alias("field"), *[self.of(f, n).alias(n) for n in self.FACTORS])
                for f in self.fields
            ]
        )
        return df.select(self.collection.id, "bm25", F.inline(rows)).filter(F.col("hit_count") > 0)
