"""Benchmark passages in documents, found by spaced seeds and verified, in column functions alone.

Words are lower-cased runs of letters and digits. A mask (1: the word counts, 0: any word
will do) is laid at every word of every text; the words it selects are hashed. Test and
training hashes are joined; each hit fixes an item, a document and an alignment. Along the
alignment, words of item and document are compared one by one: an alignment is a leak if
some stretch of ``WINDOW`` item words (or the whole item, if shorter) has at most
``MISSES`` differing words (none in an item shorter than ``WINDOW``). The two masks
together meet every stretch of twelve words with two substitutions, whatever their places.

An item of fewer words than the shortest mask has is searched for by an exact mask of its own length, which is
laid at every word like the others, so any text that holds it word for word is found. The alignments of an item and
a document are one row, which holds the document's words once.

Nulls: a null text is empty, nothing is found in it or of it; an item without words is not searched for. Extra
columns are not read; ``without_leaks`` keeps them. Empty tables give no leaks. Repeated rows give one result per (doc_id, item_id): the best alignment.
Rows with a null doc_id or item_id are reported under null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

# The masks.
MASKS = ("110111", "110001011")
WINDOW = 12
MISSES = 2
#: Test hashes that one pass over the documents joins from memory (16 bytes each).
BLOCK_HASHES = 1_000_000
#: Document keys that are sent to all executors at most; more are joined by an exchange.
SENT_KEYS = 200_000


def word_hashes(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    parts = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))
    return F.transform(parts, lambda w: F.xxhash64(w))


def _masked(hashes: Column, mask: str) -> Column:
    """The hash of the words that one mask selects, at every word where it fits."""
    picked = [i for i, c in enumerate(mask) if c == "1"]
    fits = F.sequence(F.lit(0), F.size(hashes) - len(mask))
    made = F.transform(fits, lambda at: F.xxhash64(F.lit(mask), *[F.get(hashes, at + i) for i in picked]))
    return F.when(F.size(hashes) >= len(mask), made).otherwise(F.array().cast("array<bigint>"))


def _seed_rows(df: DataFrame, keys: list[str], masks: list[Column]) -> DataFrame:
    """(keys, hash, at), one row per mask and word."""
    per_mask = df.select(*keys, F.explode(F.array(*masks)).alias("row"))
    return per_mask.select(*keys, F.posexplode("row").alias("at", "hash"))


def _aligned(item: Column, doc: Column, offset: Column) -> Column:
    """Per item word 1 where the document has the same word on this alignment, else 0."""
    return F.transform(
        item,
        lambda w, i: F.when((offset + i >= 0) & (F.get(doc, offset + i) == w), 1).otherwise(0),
    )


def _verified(docs: DataFrame, benchmark: DataFrame, window: int, misses: int) -> DataFrame:
    """One row per alignment that is a leak, with the ``text_hash`` of the text that holds it."""
    items = settled(
        benchmark.select("item_id", word_hashes(F.col("text")).alias("hashes"))
        .where(F.size("hashes") > 0)
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "hashes"))
    )
    # At most as many lengths as the shortest mask has words.
    n, none = F.size("hashes"), F.array().cast("array<bigint>")
    short = items.where(n < min(len(m) for m in MASKS)).select(n.alias("n")).distinct()
    exact = ["1" * r.n for r in short.orderBy("n").collect()]
    own = [F.when(n == len(m), _masked(F.col("hashes"), m)).otherwise(none) for m in exact]
    every = [_masked(F.col("hashes"), m) for m in MASKS]
    tests = settled(_seed_rows(items, ["item"], every + own).distinct())
    passes = max(1, -(-tests.count() // BLOCK_HASHES))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashed = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("hashes"))
    rows = _seed_rows(hashed, ["doc_id", "text_hash"], [_masked(F.col("hashes"), m) for m in [*MASKS, *exact]])
    found = None
    for block in range(passes):
        part = tests.where(F.pmod("hash", F.lit(passes)) == block).withColumnRenamed("at", "item_at")
        # At most about BLOCK_HASHES rows of three numbers.
        hits = rows.join(F.broadcast(part), "hash").select("doc_id", "text_hash", "item", (F.col("at") - F.col("item_at")).alias("offset"))
        found = hits if found is None else found.unionAll(hits)
    candidates = settled(found.groupBy("doc_id", "text_hash", "item").agg(F.collect_set("offset").alias("offsets")))
    keys = candidates.select("doc_id", "text_hash").distinct()
    keys = keys.withColumnsRenamed({"doc_id": "k_doc", "text_hash": "k_text"})
    if candidates.count() <= SENT_KEYS:
        keys = F.broadcast(keys)
    same = F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("text_hash") == F.col("k_text"))
    suspects = (
        texts.withColumn("text_hash", F.xxhash64("text"))
        .join(keys, same, "left_semi")
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", word_hashes(F.col("text")).alias("doc_hashes"))
    )
    c, s = candidates.alias("c"), suspects.alias("s")
    pairs = c.join(s, F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("c.text_hash") == F.col("s.text_hash")))
    pairs = pairs.select("c.doc_id", "c.text_hash", "c.item", "c.offsets", "s.doc_hashes").join(items, "item")
    width = F.least(n, F.lit(window))
    allowed = F.when(n < window, 0).otherwise(misses)

    def compared(offset: Column) -> Column:
        def judged(same: Column) -> Column:
            starts = F.sequence(F.lit(0), n - width)
            best = F.array_max(F.transform(starts, lambda i: F.aggregate(F.slice(same, i + 1, width), F.lit(0), lambda a, b: a + b)))
            matched = F.aggregate(same, F.lit(0), lambda a, b: a + b)
            return F.struct(offset.alias("offset"), matched.alias("matched"), best.alias("best"))

        # The words compared on one alignment are gone before the next is looked at.
        return F.get(F.transform(F.array(_aligned(F.col("hashes"), F.col("doc_hashes"), offset)), judged), F.lit(0))

    good = F.filter(F.transform("offsets", compared), lambda x: x["best"] >= width - allowed)
    return pairs.select("doc_id", "text_hash", "item_id", n.alias("item_words"), F.inline(good))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, misses: int = MISSES) -> DataFrame:
    """(doc_id, item_id, matched_words, item_words, doc_from): one row per leak."""
    return _verified(docs, benchmark, window, misses).groupBy("doc_id", "item_id").agg(
        F.max("matched").cast("bigint").alias("matched_words"),
        F.max("item_words").cast("bigint").alias("item_words"),
        F.min(F.greatest(F.col("offset"), F.lit(0))).cast("bigint").alias("doc_from"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark passage was found, all columns kept. Rows that share
    the id of a leaking document, or the lack of one, go only if they have its text."""
    found = _verified(docs, benchmark, WINDOW, MISSES)
    bad = settled(found.select(F.col("doc_id").alias("_llm_leaked"), F.col("text_hash").alias("_llm_leaked_text")).distinct())
    if bad.count() <= SENT_KEYS:
        bad = F.broadcast(bad)
    same = docs["doc_id"].eqNullSafe(F.col("_llm_leaked"))
    same &= F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_llm_leaked_text")
    return docs.join(bad, same, "left_anti")
