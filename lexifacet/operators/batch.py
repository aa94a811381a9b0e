"""Many queries in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hits as H
from ..functions import text as T
from ..functions.calendar import CALENDAR_UNITS, calendar_key
from ..functions.frames import compute_once
from ..sources.collection import Collection
from ..sources.literal import small_table
from ..sources.storage import ensure_checkpoint_dir
from .filters import is_multi
from .order import order_keys, with_tie_break


#: Query words that may be broadcast.
TOKENS_SENT = 1_000_000


class Facet(NamedTuple):
    """One facet of a batch: what it groups by, and if wanted the order of its groups (keys ``@group``,
    ``@count``, ``@weight``, ``@distinct``, ``@id``), how many it shows, and an attribute whose
    distinct values it counts."""

    attr: str
    func: str = "attr"
    sort: str | None = None
    limit: int | None = None
    distinct: str | None = None


def facets(found: DataFrame, id: str, wanted: Sequence[tuple]) -> DataFrame:
    """Several group-bys over one match frame, each a :class:`Facet` or its first values:
    (query_no, group_key, group_count, best id, its weight), with ``group_distinct`` where a facet
    counts distinct values and ``place`` where one has an order or a limit (null for others).

    Every match turns into one row per facet before a single partial aggregation
    and a single exchange, so matching and ranking happen once and nothing is cached. Keys are shown as
    text and ordered as what they are. A limit is applied in every task before groups meet; an order
    without a limit numbers all groups of its facet in one task.
    """
    wanted = [Facet(*w) for w in wanted]
    for w in wanted:
        if w.limit is not None and (isinstance(w.limit, bool) or not isinstance(w.limit, int) or w.limit < 1):
            raise ValueError("the limit of a facet must be an integer of at least 1")

    def rows_of(n: int, attr: str, func: str) -> Column:
        def row(key: Column) -> Column:
            distinct = wanted[n].distinct
            value = [(F.col(distinct).cast("string") if distinct else F.lit(None).cast("string")).alias("_value")] if counted else []
            return F.struct(F.lit(n).alias("query_no"), key.cast("string").alias("group_key"), *value)

        if func in CALENDAR_UNITS:
            return F.array(row(calendar_key(F.col(attr), func)))
        if func != "attr":
            raise ValueError(f"a facet groups by attr, day, week, month or year, not {func}")
        if is_multi(found.schema, attr):
            return F.transform(attr, row)
        return F.array(row(F.col(attr)))

    counted = any(w.distinct for w in wanted)
    rows = [rows_of(n, w.attr, w.func) for n, w in enumerate(wanted)]
    tall = found.select(id, "weight", F.inline(F.concat(*rows) if len(rows) > 1 else rows[0]))
    best = F.min_by(F.struct(id, "weight"), F.struct(-F.col("weight"), F.col(id))).alias("_best")
    counts = [F.count(F.lit(1)).alias("group_count")]
    if counted:
        of = [n for n, w in enumerate(wanted) if w.distinct]
        distinct = F.count_distinct("_value")
        counts.append(F.when(F.col("query_no").isin(of), distinct).alias("group_distinct"))
    grouped = tall.groupBy("query_no", "group_key").agg(*counts, best)
    extra = ["group_distinct"] if counted else []
    grouped = grouped.select("query_no", "group_key", "group_count", f"_best.{id}", "_best.weight", *extra)
    if all(w.sort is None and w.limit is None for w in wanted):
        return grouped
    return _placed(grouped, found.schema, id, wanted)


def _placed(grouped: DataFrame, schema, id: str, wanted: Sequence[Facet]) -> DataFrame:
    """Groups with their ``place`` in the order of their facet, up to its limit."""
    order, free, limits = [], [], {}
    for n, w in enumerate(wanted):
        if w.sort is None and w.limit is None:
            free.append(n)
            continue
        limits[n] = w.limit
        kind = "int" if w.func in CALENDAR_UNITS else schema[w.attr].dataType
        kind = getattr(kind, "elementType", kind)
        for name, ascending in with_tie_break(order_keys(w.sort or "@group desc", id), "group_key"):
            if name not in grouped.columns:
                raise ValueError(f"a facet has nothing to sort by called {name}")
            key = F.col(name).cast(kind) if name == "group_key" else F.col(name)
            # Only the rows of this facet have a value here.
            key = F.when(F.col("query_no") == n, key)
            order.append(key.asc() if ascending else key.desc())
    # A facet without order has a partition per group.
    alone = F.when(F.col("query_no").isin(free), F.struct("group_key")) if free else F.lit(None).cast("string")
    place = F.row_number().over(W.partitionBy("query_no", alone).orderBy(*order))
    placed = grouped.withColumn("place", place)
    if None not in limits.values():
        placed = placed.filter(F.col("place") <= max(limits.values()))
    for n, limit in limits.items():
        if limit is not None:
            placed = placed.filter((F.col("query_no") != n) | (F.col("place") <= limit))
    return placed.withColumn("place", F.when(F.col("query_no").isin(list(limits)), F.col("place")))


def search_table(
    collection: Collection,
    queries: DataFrame,
    query_no: str = "query_no",
    text: str = "text",
    mode: str = "all",
    best: int | None = None,
) -> DataFrame:
    """Run a table of query texts: (query_no, id, weight) of every match, or of the ``best``
    per query. Matches and weights are those of ``Search.match`` without field weights: stop
    words are left out, word forms meet, a repeated word counts once; ``all`` weighs by
    phrase proximity, ``any`` by matchany. Texts are plain, so ``*`` parts words here.
    ``query_no`` is unique; a query without words has no matches.

    ``all`` finds the candidates of a query by its rarest word alone, so a word in a
    third of all documents is joined only for queries that have nothing rarer. Each
    candidate is then one row that holds its query and its hits. ``any`` cannot
    skip a word: it joins on every one.
    """
    if mode not in ("all", "any"):
        raise ValueError("mode must be all or any")
    asked = _with_forms(collection, queries.select(F.col(query_no).alias("query_no"), T.tokenize(text).alias("_words")))
    words = asked.select("query_no", F.posexplode("_words").alias("_q", "_forms"))
    wanted = words.select("query_no", "_q", F.explode("_forms").alias("token"))
    if mode == "all":
        # A word no document has is the rarest and leaves its query without candidates.
        docs = collection.word_docs(wanted.select("token").distinct())
        counted = wanted.join(docs, "token", "left").groupBy("query_no", "_q")
        sized = counted.agg(F.sum(F.coalesce("docs", F.lit(0))).alias("_docs"), F.collect_list("token").alias("_forms"))
        rarest = sized.groupBy("query_no").agg(F.min_by("_forms", F.struct("_docs", "_q")).alias("_forms"))
        wanted = rarest.select("query_no", F.explode("_forms").alias("token"))
    wanted = wanted.select("query_no", "token").distinct()
    pairs = _meeting(collection, wanted, asked).select("query_no", collection.id).distinct()
    flat = asked.withColumn("_flat", F.flatten("_words"))
    rows = collection.with_tokens(pairs.join(flat, "query_no"))
    fields = range(len(collection.fields))
    if mode == "all":
        tokens = [f"_tok_{i}" for i in fields]
        own = F.array_intersect("_flat", F.concat(*tokens) if len(tokens) > 1 else F.col(tokens[0]))
        rows = rows.filter(T.let(own, lambda ws: F.forall("_words", lambda forms: F.arrays_overlap(forms, ws))))
    hits = {f"_hits_{i}": H.hits(F.col(f"_tok_{i}"), lambda w: F.array_contains("_flat", w)) for i in fields}
    rows = compute_once(rows, hits).select("query_no", collection.id, "_words", *hits)
    weight = sum((_weight(F.col(h), mode, len(hits)) for h in hits), F.lit(0).cast("long"))
    weighted = rows.select("query_no", collection.id, weight.alias("weight"))
    if best is None:
        return weighted
    w = W.partitionBy("query_no").orderBy(F.col("weight").desc(), F.col(collection.id).asc())
    return weighted.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= best).drop("_rn")


def _meeting(collection: Collection, wanted: DataFrame, asked: DataFrame) -> DataFrame:
    """The words of the documents that are among the ``wanted`` (query_no, token).

    Exploded texts are far larger than Spark takes them for, and may not be the side
    that is sent around. The wanted tokens are at most those of the queries, which are counted:
    up to ``TOKENS_SENT`` they are, beyond that both sides are shuffled.
    """
    tokens = asked.agg(F.sum(F.size(F.flatten("_words")))).first()[0] or 0
    if tokens <= TOKENS_SENT:
        return collection.document_words().join(F.broadcast(wanted), "token")
    known = collection.document_words().join(wanted.select("token").distinct().hint("merge"), "token", "left_semi")
    return known.join(wanted.hint("merge"), "token")


def _with_forms(collection: Collection, asked: DataFrame) -> DataFrame:
    """(query_no, _words): the distinct words of each query that are no stop words, in order,
    each as the array of tokens that stand for it. Queries without words are left out."""
    words = F.col("_words")
    if collection.stopwords:
        words = F.filter(words, lambda w: ~w.isin(sorted(collection.stopwords)))
    asked = asked.select("query_no", F.array_distinct(words).alias("_words")).filter(F.size("_words") > 0)
    if not collection.wordforms:
        return asked.withColumn("_words", F.transform("_words", lambda w: F.array(w)))
    normal = collection.wordforms
    same: dict[str, set[str]] = {n: set() if n in normal else {n} for n in normal.values()}
    for token, n in normal.items():
        same[n].add(token)
    known = [(w, sorted(same[normal.get(w, w)])) for w in sorted({*normal, *normal.values()})]
    spark = asked.sparkSession
    forms = small_table(spark, [("_word", "string"), ("_forms", "array<string>")], known)
    rows = asked.select("query_no", F.posexplode("_words").alias("_q", "_word")).join(forms, "_word", "left")
    one = F.struct("_q", F.coalesce("_forms", F.array("_word")).alias("f"))
    grouped = rows.groupBy("query_no").agg(F.sort_array(F.collect_list(one)).alias("_words"))
    return grouped.select("query_no", F.col("_words.f").alias("_words"))


def _has(hits: Column, forms: Column) -> Column:
    return F.exists(hits, lambda h: F.array_contains(forms, h["w"]))


def _weight(hits: Column, mode: str, fields: int) -> Column:
    """Weight of one field's hits for the words of its row: the longest run of the words, or
    matchany."""
    words = F.col("_words")

    def offsets(h: Column) -> Column:
        def place(forms: Column, q: Column) -> Column:
            return F.when(F.array_contains(forms, h["w"]), F.struct((h["p"] - q).alias("d"), q.alias("q")))

        return F.array_compact(F.transform(words, place))

    run = H.longest_run(F.sort_array(F.flatten(F.transform(hits, offsets)))).cast("long")
    if mode == "all":
        return run
    found = F.size(F.filter(words, lambda forms: _has(hits, forms)))
    score = found + (run - 1) * F.size(words) * fields
    return F.when(F.size(hits) > 0, score).otherwise(0).cast("long")


def stored(found: DataFrame) -> DataFrame:
    """A match frame kept in the checkpoint folder, for several pages, totals or
    groupings over one match and rank; it survives the loss of an executor."""
    ensure_checkpoint_dir(found.sparkSession)
    return found.checkpoint()


def run_batch(makers: Sequence[Callable[[], DataFrame]]) -> list[DataFrame | Exception]:
    """Build every query of a batch; one that cannot be built does not stop the others."""
    out: list[DataFrame | Exception] = []
    for make in makers:
        try:
            out.append(make())
        except (ValueError, TypeError, AnalysisException) as problem:
            out.append(problem)
    return out


def batch_errors(spark: SparkSession, outcomes: Sequence[DataFrame | Exception]) -> DataFrame:
    """(query_no, error): one row per query, NULL where it is fine."""
    rows = [(n, str(x) if isinstance(x, Exception) else None) for n, x in enumerate(outcomes)]
    return small_table(spark, [("query_no", "int"), ("error", "string")], rows)


def batch_matches(outcomes: Sequence[DataFrame | Exception], columns: Sequence[str]) -> DataFrame | None:
    """The rows of all good queries with their query_no."""
    out = None
    for n, df in enumerate(outcomes):
        if isinstance(df, Exception):
            continue
        tagged = df.select(F.lit(n).alias("query_no"), *columns)
        out = tagged if out is None else out.unionByName(tagged)
    return out
