"""A hidden Markov language model, trained by Baum-Welch over the whole training corpus.

Tokens are lower-cased words and one end per text. The most frequent tokens, at most ``HEAD``, are
symbols of their own; every other word belongs to one of ``CLASSES`` classes by the hash
of its last bytes, and its probability within the class comes from its exact count, one
unseen word per class included. The table of states and symbols thus has a fixed size,
while counts of all words are kept: rare words meet their counts by a join.

Training: texts as symbols, in stretches of ``STRETCH``; each task sums expected counts of
states, transitions and symbols over its rows, the sums of all tasks are added as they
stream by, and the driver, which sees only tables of fixed size, makes the next model. Scoring: the
scaled forward recursion runs over a whole text, however long, and gives the exact
likelihood of its tokens.

Nulls: a null text is empty: its one token is the end. A null doc_id is held out. Without training texts all
counts are 0. Repeated rows are scored each; in training they count each.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, settled, tokens_of

HEAD = 40_000
CLASSES = 4096
STATES = 8
ROUNDS = 5
STRETCH = 128
SUFFIX = 3
HELD_OUT = 1
#: Stretches worked on at a time, and words a task counts before it passes them on.
AT_A_TIME = 4096
COUNTED = 400_000
#: Symbols per row in which tasks pass on expected counts.
BLOCK = 4096
END = b""
#: Stands for a row itself among its rare words; no word holds a space.
ROW = b" "


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; END is counted once per text."""

    def run(batches):
        counts = Counter()

        def table():
            words = pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())
            return pa.RecordBatch.from_arrays(list(words), names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens_of(text.as_py()))
                counts[END] += 1
                if len(counts) > COUNTED:
                    yield table()
                    counts.clear()
        if counts:
            yield table()

    part = texts.select("text").mapInArrow(run, "word binary, n bigint")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % CLASSES


def encoded(texts: DataFrame, index) -> DataFrame:
    """Texts as symbols: columns of ``texts`` but text, and ``symbols`` (16-bit numbers, the end last)."""
    keys = [c for c in texts.columns if c != "text"]

    def run(batches):
        known = index.value
        first = len(known)

        def symbol(word: bytes) -> int:
            found = known.get(word)
            return first + word_class(word) if found is None else found

        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = tokens_of(text.as_py())
                words.append(END)
                rows.append(np.fromiter(map(symbol, words), dtype="<u2", count=len(words)).tobytes())
            columns = [batch.column(k) for k in keys] + [pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "symbols"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    return texts.mapInArrow(run, f"{schema}, symbols binary")


def rare_words(texts: DataFrame, index) -> DataFrame:
    """(doc_id, text_hash, word, times): each text's words outside the head, and one ROW per text."""

    def run(batches):
        known = index.value
        for batch in batches:
            words, times = [], []
            for text in batch.column("text"):
                found = Counter(tokens_of(text.as_py()))
                rare = [w for w in found if w not in known]
                words.append([ROW, *rare])
                times.append([1, *map(found.__getitem__, rare)])
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "words", "times"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    lists = texts.select("doc_id", "text_hash", "text").mapInArrow(run, f"doc_id {kind}, text_hash bigint, words array<binary>, times array<int>")
    rows = lists.select("doc_id", "text_hash", F.explode(F.arrays_zip("words", "times")).alias("w"))
    return rows.select("doc_id", "text_hash", F.col("w.words").alias("word"), F.col("w.times").alias("times"))


def stretches(batch: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into rows of STRETCH symbols, filled up with ``pad``; which rows begin a text."""
    lengths = np.array([len(s) // 2 for s in batch])
    per_text = -(-lengths // STRETCH)
    rows = np.full((int(per_text.sum()), STRETCH), pad, dtype=np.int64)
    begins = np.zeros(len(rows), dtype=bool)
    firsts = np.concatenate([[0], np.cumsum(per_text)[:-1]]).astype(int)
    flat = rows.reshape(-1)
    for first, text, n in zip(firsts, batch, lengths):
        flat[first * STRETCH : first * STRETCH + n] = np.frombuffer(text, dtype="<u2")
    begins[firsts] = True
    return rows, begins


def expected(rows: np.ndarray, begins: np.ndarray, model: dict, out: dict) -> None:
    """Adds the expected counts of some stretches to ``out``."""
    move, give = model["move"], model["give"]
    pad = len(give) - 1
    seen = give[rows]
    n, length, k = seen.shape
    ahead = np.empty((length, n, k), dtype=np.float32)
    scale = np.empty((length, n, 1), dtype=np.float32)
    now = np.where(begins[:, None], model["start"], model["mean"]).astype(np.float32)
    for t in range(length):
        now = (now if t == 0 else now @ move) * seen[:, t]
        scale[t] = now.sum(axis=1, keepdims=True)
        now = now / scale[t]
        ahead[t] = now
    back = np.ones((n, k), dtype=np.float32)
    real = rows != pad
    for t in range(length - 1, -1, -1):
        if t < length - 1:
            coming = seen[:, t + 1] * back / scale[t + 1]
            both = real[:, t + 1]
            out["moves"] += ahead[t][both].T.astype(np.float64) @ coming[both]
            back = coming @ move.T
        ahead[t] *= back
    share = ahead / ahead.sum(axis=2, keepdims=True)
    out["start"] += share[0][begins].sum(axis=0, dtype=np.float64)
    flat = rows.T.reshape(-1)
    for state in range(k):
        out["gives"][:, state] += np.bincount(flat, weights=share[:, :, state].reshape(-1), minlength=pad + 1)


def baum_welch_round(corpus: DataFrame, model: dict) -> dict:
    """Expected counts over all training texts, as one table of fixed size."""
    shipped = corpus.sparkSession.sparkContext.broadcast(model)
    symbols, states = model["give"].shape

    def count(batches):
        now = shipped.value
        out = {"moves": np.zeros((states, states)), "start": np.zeros(states), "gives": np.zeros((symbols, states))}
        for batch in batches:
            rows, begins = stretches([s.as_py() for s in batch.column(0)], symbols - 1)
            for i in range(0, len(rows), AT_A_TIME):
                expected(rows[i : i + AT_A_TIME], begins[i : i + AT_A_TIME], now, out)
        parts = [np.vstack([out["moves"], out["start"][None]])]
        parts += [out["gives"][i : i + BLOCK] for i in range(0, symbols, BLOCK)]
        yield _parts({i: p for i, p in enumerate(parts)})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(data.as_py(), dtype="<f8").reshape(-1, states)
                sums[part] = sums[part] + values if part in sums else values
        yield _parts(sums)

    kind = "part int, data binary"
    each = corpus.where("training").select("symbols").mapInArrow(count, kind)
    rows = each.repartition("part").mapInArrow(add, kind).collect()
    found = {r.part: np.frombuffer(bytes(r.data), dtype="<f8").reshape(-1, states) for r in rows}
    if not found:
        return {"moves": np.zeros((states, states)), "start": np.zeros(states), "gives": np.zeros((symbols, states))}
    gives = np.vstack([found[i] for i in sorted(found) if i])
    return {"moves": found[0][:states] * model["move"], "start": found[0][states], "gives": gives}


def _parts(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    data = pa.array([np.ascontiguousarray(p, dtype="<f8").tobytes() for p in parts.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(parts.keys(), pa.int32()), data], names=["part", "data"])


def first_model(unigram: np.ndarray, states: int = STATES, seed: int = 11) -> dict:
    """States that differ by chance; the last symbol fills stretches up and costs nothing."""
    rng = np.random.default_rng(seed)
    give = unigram[:, None] * rng.gamma(2.0, 0.5, size=(len(unigram), states))
    give /= give.sum(axis=0)
    move = np.full((states, states), 0.1 / (states - 1)) + np.eye(states) * (0.9 - 0.1 / (states - 1))
    return _model(np.full(states, 1 / states), np.full(states, 1 / states), move, give)


def _model(start, mean, move, give) -> dict:
    return {
        "start": start.astype(np.float32),
        "mean": mean.astype(np.float32),
        "move": move.astype(np.float32),
        "give": np.vstack([give, np.ones(give.shape[1])]).astype(np.float32),
    }


def next_model(counts: dict, unigram: np.ndarray) -> dict:
    """The model that expected counts make, smoothed by the unigram distribution."""
    gives = counts["gives"][:-1] + 20.0 * unigram[:, None]
    moves = counts["moves"] + 1.0
    start = counts["start"] + 1.0
    mean = gives.sum(axis=0)
    return _model(start / start.sum(), mean / mean.sum(), moves / moves.sum(axis=1, keepdims=True), gives / gives.sum(axis=0))


def forward(texts: list[bytes], start, move, give) -> np.ndarray:
    """log10 of the likelihood of each text, by the scaled forward recursion; a text's
    steps are those of all texts that are at least as long."""
    rows = [np.frombuffer(t, dtype="<u2") for t in texts]
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    lengths = np.array([len(rows[i]) for i in order])
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    flat = np.concatenate([rows[i] for i in order]).astype(np.int64)
    total = np.zeros(len(rows))
    now = np.tile(start, (len(rows), 1))
    active = len(rows)
    for t in range(int(lengths[0])):
        while lengths[active - 1] <= t:
            active -= 1
        now = now[:active] if t == 0 else now[:active] @ move
        now = now * give[flat[begin[:active] + t]]
        scale = now.sum(axis=1)
        total[:active] += np.log10(scale)
        now /= scale[:, None]
    out = np.empty(len(rows))
    out[order] = total
    return out


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    context = docs.sparkSession.sparkContext
    text = F.coalesce(F.col("text"), F.lit(""))
    trains = F.coalesce(fold("doc_id") != HELD_OUT, F.lit(False))
    texts = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), trains.alias("training"), text.alias("text"))
    counts = settled(word_counts(texts.where("training")))
    facts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    below = facts.n + 0.5 * (facts.v + 1)
    ends = counts.where(F.col("word") == END).collect()
    # Words by steps of frequency, at most a thousand steps; the head is whole steps.
    step = F.floor(16 * F.log2("n"))
    steps = counts.where(F.col("word") != END).groupBy(step.alias("step")).count().collect()
    held, lowest = 0, 1 << 30
    for r in sorted(steps, key=lambda r: -r.step):
        held += r["count"]
        if held > HEAD:
            break
        lowest = r.step
    top = counts.where((F.col("word") != END) & (step >= lowest)).collect()
    top.sort(key=lambda r: (-r.n, bytes(r.word)))
    head = [END, *(bytes(r.word) for r in top)]
    head_counts = np.array([ends[0].n if ends else 0, *(r.n for r in top)], dtype=float)
    index = context.broadcast({w: i for i, w in enumerate(head)})
    rare = counts.where((F.col("word") != END) & (step < lowest))
    suffix = F.when(F.length("word") <= SUFFIX, F.col("word")).otherwise(F.substring("word", -SUFFIX, SUFFIX))
    by_class = rare.groupBy((F.crc32(suffix) % CLASSES).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    class_counts, class_below = np.zeros(CLASSES), np.full(CLASSES, 0.5)
    for r in by_class:
        class_counts[r.c], class_below[r.c] = r.n, r.n + 0.5 * r.v + 0.5
    unigram = np.concatenate([head_counts + 0.5, class_counts + 0.5])
    unigram /= unigram.sum()

    corpus = settled(encoded(texts, index))
    model = first_model(unigram, states)
    for _ in range(rounds):
        model = next_model(baum_welch_round(corpus, model), unigram)

    give = model["give"][:-1].astype(float)
    give[len(head) :] /= class_below[:, None]
    base = np.concatenate([np.log10((head_counts + 0.5) / below), np.full(CLASSES, -np.log10(below))])
    shipped = context.broadcast((model["start"].astype(float), model["move"].astype(float), give, base, head_counts > 0))

    def score(batches):
        start, move, give, base, known = shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = [s.as_py() for s in batch.column("symbols")]
            rows = [np.frombuffer(s, dtype="<u2") for s in symbols]
            likely = forward(symbols, start, move, give)
            plain = [float(base[r].sum()) for r in rows]
            seen = [int(known[r[r < len(known)]].sum()) for r in rows]
            names = ["doc_id", "text_hash", "training"]
            columns = [batch.column(c) for c in names] + [pa.array(x) for x in ([len(r) for r in rows], seen, plain, likely)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_tokens", "n_head", "base", "likely"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    parts = corpus.mapInArrow(score, f"doc_id {kind}, text_hash bigint, training boolean, n_tokens bigint, n_head bigint, base double, likely double")
    n = F.coalesce(F.col("n"), F.lit(0))
    met = rare_words(texts, index).join(rare, "word", "left")
    # Rows equal in id and text share a key; ROW says how many they are.
    tails = met.groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(F.col("word") == ROW, F.col("times"))).alias("rows"),
        F.sum(F.when((F.col("word") != ROW) & (n > 0), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("word") != ROW, F.col("times") * F.log10(n + 0.5)).otherwise(0.0)).alias("logs"),
    )
    tails = tails.select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), (F.col("known") / F.col("rows")).cast("bigint").alias("known"), (F.col("logs") / F.col("rows")).alias("logs"))
    joined = parts.join(tails, parts["doc_id"].eqNullSafe(tails["t_id"]) & (parts["text_hash"] == tails["t_hash"]))
    return joined.select(
        "doc_id",
        (F.coalesce(fold("doc_id"), F.lit(HELD_OUT)) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.col("known")).alias("n_known"),
        F.lit(int(facts.n)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("logs")).alias("base_score"),
        (F.col("likely") + F.col("logs")).alias("score"),
    )
