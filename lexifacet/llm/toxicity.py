"""Toxicity by compression distance.

A text is cut into windows of ``WINDOW`` words. Each window is compressed with two
zstandard dictionaries, one made of ordinary and one of toxic text; how many bytes the toxic one saves
is the window's gain. The toxic dictionary is made of stretches of toxic documents, the ordinary
one of windows of ordinary documents; as most of a toxic text is ordinary, the ordinary windows stand at the end of
both, so a gain speaks of what is particular to toxic text. A logistic curve, calibrated on labelled
documents, turns the number of windows above each of some thresholds and the largest gain
into a score from 0 to 1. All windows of a text count, however long it is.

The dictionaries and the curve are fitted on a bounded sample of labelled rows
(``TOXIC_ROWS`` and ``ORDINARY_ROWS``, chosen by a hash of the id among all labelled
ids outside the held-out fold, one text of each id); every document is scored. Window, level, dictionary
sizes and the rules of stretches were chosen by cross-validation over the four other folds.

Nulls: a null or empty text has no windows and the score of a text without gains. A null doc_id is
held out. Documents labelled more than once count as toxic if any label says so; null
labels are ignored. Without labelled rows of both kinds every score is 0. Repeated rows
have equal scores.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .common import fold, tokens_of

WINDOW = 6
TOXIC_ROWS = 1500
ORDINARY_ROWS = 3000
#: Bytes of ordinary windows in both dictionaries, and of toxic stretches.
BACKGROUND = 49152
OWN = 1536
#: Words of a stretch, bytes of the strings that rate it, and how many toxic documents such a
#: string must be in and how much more often than in ordinary ones.
STRETCH = 2
GRAM = 8  # a number of 64 bits
LEAST_TOXIC = 3
LEAST_RATIO = 4.0
#: Gains in bytes at which windows are counted.
THRESHOLDS = (1, 2, 3, 4, 6)
LEVEL = 12


def windows(text: str | None, width: int = WINDOW) -> list[bytes]:
    """The text's words in lower case, ``width`` at a time, between spaces."""
    tokens = tokens_of(text)
    return [b" " + b" ".join(tokens[i : i + width]) + b" " for i in range(0, len(tokens), width)]


class Compressors:
    """Gains of windows under a pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes, level: int = LEVEL):
        self.ordinary, self.toxic = (self._made(d, level) for d in (ordinary, toxic))

    @staticmethod
    def _made(content: bytes, level: int) -> zstandard.ZstdCompressor:
        entries = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        entries.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=entries, write_content_size=False, write_dict_id=False)

    def gains(self, text: str | None) -> np.ndarray:
        plain, toxic = self.ordinary.compress, self.toxic.compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], dtype=np.int64)


def features(gains: np.ndarray) -> list[float]:
    """Numbers of windows at or above each threshold, in all and as a share, and the largest gain."""
    n = max(1, len(gains))
    over = [int((gains >= t).sum()) for t in THRESHOLDS]
    return [math.log1p(x) for x in over] + [x / n for x in over] + [float(gains.max()) if len(gains) else 0.0]


def grams(data: bytes) -> set[bytes]:
    """The distinct strings of ``GRAM`` bytes within ``data``."""
    return {data[i : i + GRAM] for i in range(len(data) - GRAM + 1)}


def numbers(text: str | None) -> np.ndarray:
    """The same strings of a whole text, in order, each as a number of 64 bits."""
    data = b" " + b" ".join(tokens_of(text)) + b" "
    if len(data) < GRAM:
        return np.zeros(0, dtype=np.uint64)
    runs = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), GRAM)
    return np.unique(np.ascontiguousarray(runs).view(np.uint64))


def gram_weights(texts: list[str], marks: list[int]) -> dict[bytes, float]:
    """Byte strings that set toxic texts apart, with their weights."""
    n = {mark: marks.count(mark) for mark in (0, 1)}
    held = [numbers(t) for t, y in zip(texts, marks) if y == 1]
    found, toxic = np.unique(np.concatenate(held or [np.zeros(0, dtype=np.uint64)]), return_counts=True)
    found, toxic = found[toxic >= LEAST_TOXIC], toxic[toxic >= LEAST_TOXIC]
    ordinary = np.zeros(len(found), dtype=np.int64)
    for text, mark in zip(texts, marks):
        if mark == 0:
            ordinary += np.isin(found, numbers(text), assume_unique=True)
    out = {}
    for gram, c, other in zip(found, toxic.tolist(), ordinary.tolist()):
        shares = (c + 0.5) / (n[1] + 1), (other + 0.5) / (n[0] + 1)
        if shares[0] >= LEAST_RATIO * shares[1]:
            out[gram.tobytes()] = c * math.log(shares[0] / shares[1])
    return out


def stretches(text: str | None, size: int = STRETCH) -> set[bytes]:
    """All runs of ``size`` words of a text (all its words, if it has fewer), between spaces."""
    tokens = tokens_of(text)
    return {b" " + b" ".join(tokens[i : i + size]) + b" " for i in range(max(1, len(tokens) - size + 1))} if tokens else set()


def toxic_stretches(texts: list[str], marks: list[int], size: int = OWN) -> list[bytes]:
    """Stretches of toxic texts, of ``size`` bytes together at most, the most telling first.

    A byte string that more toxic documents hold than ordinary ones weighs its number of toxic documents
    times the log ratio of both shares. The stretch with most weight a byte is taken, what
    it holds weighs nothing from then on, and so forth: a dictionary builder's covering
    of frequent strings, with contrast in place of frequency.
    """
    weight = gram_weights(texts, marks)

    def worth(stretch: bytes) -> float:
        return sum(weight.get(g, 0.0) for g in sorted(grams(stretch))) / len(stretch)

    first = {s: w for t, y in zip(texts, marks) if y == 1 for s in stretches(t) if (w := worth(s)) > 0}
    heap = [(-w, s) for s, w in first.items()]
    heapq.heapify(heap)
    chosen, held = [], 0
    while heap:
        old, stretch = heapq.heappop(heap)
        now = worth(stretch)
        if now > 0 and now < -old:
            heapq.heappush(heap, (-now, stretch))
        elif now > 0 and held + len(stretch) <= size:
            chosen.append(stretch)
            held += len(stretch)
            for gram in grams(stretch):
                weight.pop(gram, None)
    return chosen


def dictionaries(texts: list[str], marks: list[int], seed: int = 1) -> tuple[bytes, bytes]:
    """The contents of the ordinary and of the toxic dictionary, of one length: ordinary windows in
    both, at the same place, so that their matches cost the same, and toxic stretches before
    them in the toxic one, the most telling last."""
    toxic = b"".join(reversed(toxic_stretches(texts, marks))).rjust(OWN)
    rng = random.Random(seed)
    plain = [w for t, y in zip(texts, marks) if y == 0 for w in windows(t)]
    rng.shuffle(plain)
    ordinary = b"".join(plain)[:BACKGROUND]
    return b" " * OWN + ordinary, toxic + ordinary


def logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic curve over the columns of ``x`` and a constant; ``each`` row counts so often."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (each * (y - p)) - ridge * w
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(texts: list[str], marks: list[int], rows: dict[int, int] | None = None) -> dict | None:
    """A model from labelled texts: two dictionaries and a curve. ``rows``: how many labelled
    rows of either kind there are in all, of which these are a sample."""
    if not {0, 1} <= set(marks):
        return None
    ordinary, toxic = dictionaries(texts, marks)
    compressors = Compressors(ordinary, toxic)
    x = np.array([features(compressors.gains(t)) for t in texts])
    y = np.array(marks, dtype=float)
    stands_for = {m: (rows or {}).get(m, marks.count(m)) / marks.count(m) for m in (0, 1)}
    each = np.array([stands_for[m] for m in marks])
    return {"ordinary": ordinary, "toxic": toxic, "curve": logistic(x, y, each / each.mean()).tolist()}


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model for ``docs``, learnt from labels (doc_id, toxic) outside the held-out fold."""
    marked = (
        labels.where(F.col("toxic").isNotNull() & (fold("doc_id") != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("mark"))
    )
    counts = {r.mark: r["count"] for r in marked.groupBy("mark").count().collect()}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    wanted = F.lit(False)
    for mark, rows in ((0, ORDINARY_ROWS), (1, TOXIC_ROWS)):
        share = min(1.0, rows / max(1, counts.get(mark, 0)))
        wanted |= (F.col("mark") == mark) & (chance < int(share * (1 << 30)))
    # About TOXIC_ROWS + ORDINARY_ROWS rows of two numbers.
    chosen = F.broadcast(marked.where(wanted))
    # One text of each id, however many rows it has: the one of the smallest hash.
    text = F.coalesce("text", F.lit(""))
    one = F.min(F.struct(F.xxhash64(text).alias("hash"), text.alias("text"))).alias("one")
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "mark").agg(one).collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    return fit([r.one.text for r in rows], [int(r.mark) for r in rows], counts)


def scored(docs: DataFrame, model: dict | None, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in ``column``."""
    if model is None:
        return docs.withColumn(column, F.lit(0.0))

    @pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = Compressors(model["ordinary"], model["toxic"])
        for batch in batches:
            x = np.array([features(compressors.gains(t)) for t in batch]).reshape(len(batch), -1)
            z = np.column_stack([x, np.ones(len(x))]) @ np.array(model["curve"])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return docs.withColumn(column, score("text"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 0, F.lit(True)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below one half, all columns kept."""
    return scored(docs, train(docs, labels), "_llm_score").where("_llm_score < 0.5").select(*[f"`{c}`" for c in docs.columns])
