"""Bottom-k sketches of documents, built from column functions alone.

A text's shingles (five words, fewer only if the text has fewer) are hashed to 64 bits;
the ``k`` smallest distinct hashes are its sketch. The sketch of a union is the ``k``
smallest of the two sketches, so sketches of parts merge in any order. Resemblance,
containment and the number of distinct shingles are estimated from sketches; they are
exact as long as a set has at most ``k`` shingles.

Nulls: a null text is empty. An empty text has an empty sketch; two empty sketches
resemble each other fully, an empty and another not at all. Equal texts have equal
sketches. Other columns of a table are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import literal_array, words

SHINGLE = 5
K = 128


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def sketch(hashes: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The sketch of a text given the hashes of its words."""
    n = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(shingle)])
    )
    shingles = F.when(n >= shingle, windows).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles, 0 to 1."""
    both = F.size(F.array_intersect(F.array_intersect(merged(a, b, k), a), b))
    total = F.size(merged(a, b, k))
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has as well."""
    r, own, other = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(own == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (own + other) / (1 + r) / own))


def as_text(a: Column) -> Column:
    """A sketch as a string: its hashes in order, sixteen hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def merge_groups(df: DataFrame, keys: Sequence[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of rows. Each task keeps its own ``k`` smallest hashes of
    a group before the exchange, so a large group sends ``k`` rows per task."""
    hashes = df.select(*keys, F.explode(column).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
    return (
        hashes.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("h")).alias(column))
    )


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are below ``value`` (0 for null)."""
    steps = [1 << s for s in reversed(range(max(1, len(bounds)).bit_length()))]
    array, last = literal_array(bounds), len(bounds)
    return F.aggregate(
        literal_array(steps, "int"),
        F.lit(0),
        lambda at, step: F.when((at + step <= last) & (F.get(array, at + step - 1) < value), at + step).otherwise(at),
    )


def with_next(docs: DataFrame, rows_per_part: int = 256, most_parts: int = 16384) -> DataFrame:
    """(doc_id, text, part, guest): documents dealt to ranges of ``doc_id``.

    Range bounds are approximate quantiles, at most ``most_parts`` numbers. The first
    document of a range also goes, as a guest, to the range above it (that of the
    highest range to the lowest), so that within a range the next document by falling
    id is always at hand. Only this one exchange moves texts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = max(1, min(most_parts, docs.select("doc_id").count() // rows_per_part))
    fractions = literal_array([i / parts for i in range(1, parts)], "double")
    bounds = []
    if parts > 1:
        found = docs.agg(F.percentile_approx(F.col("doc_id"), fractions, F.lit(10 * parts)).alias("b")).first().b
        bounds = sorted(set(found or []))
    part = _below(bounds, F.col("doc_id")) if bounds else F.lit(0)
    heads = docs.select("doc_id", part.alias("part")).groupBy("part").agg(F.max("doc_id").alias("head")).collect()
    heads = sorted((h.part, h.head) for h in heads)
    head_of = [None] * (len(bounds) + 1)
    guest_in = [0] * (len(bounds) + 1)
    for i, (p, head) in enumerate(heads):
        head_of[p], guest_in[p] = head, heads[(i + 1) % len(heads)][0]
    is_head = F.get(literal_array(head_of), F.col("part")).eqNullSafe(F.col("doc_id"))
    places = F.when(is_head, F.array("part", F.get(literal_array(guest_in, "int"), F.col("part")))).otherwise(F.array("part"))
    return rows.withColumn("part", part).select("doc_id", "text", F.posexplode(places).alias("guest", "part"))


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's sketch, that of its edited text, and its likeness to the edited
    text and to the next document.

    The edited text has its last third replaced by as many leading code points of the
    next document by falling ``doc_id`` (of the first after the last). Documents of one
    id follow each other by text; a null id comes last. A lone document is its own next.
    """
    dealt = with_next(docs).repartition("part")
    hashed = dealt.withColumn("hashes", word_hashes(F.col("text"))).withColumn("sketch", sketch(F.col("hashes"), k)).drop("hashes")
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    paired = hashed.select(
        "doc_id",
        "text",
        "sketch",
        "guest",
        F.char_length("text").alias("n"),
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    ).where("guest = 0")
    third = F.floor(F.col("n") / 3).cast("int")
    edited = (
        paired.withColumn(
            "edited",
            F.concat(F.col("text").substr(F.lit(1), F.col("n") - third), F.col("next_text").substr(F.lit(1), third)),
        )
        .withColumn("edited_hashes", word_hashes(F.col("edited")))
        .withColumn("edited_sketch", sketch(F.col("edited_hashes"), k))
    )
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(other).alias("edited_fingerprint"),
        resemblance(own, other, k).alias("near_edited"),
        resemblance(own, following, k).alias("near_next"),
        distinct_shingles(own, k).alias("distinct_shingles"),
        containment(own, other, k).alias("contained_in_edited"),
    )
