"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is brought to the form ``(s?(ua)+)?``, a system turn at most and then user and assistant
in turn, by edits: keep a row, give it another role, delete it, insert an empty turn. While rows are read,
the text written so far is in one of four states: nothing, or last written s, u or a. A row is a table: for every state
before it and after it the cheapest edits (insertions before the row, then the row's own edit).

Reconstruction keeps no table of all rows. A forward vector of four costs runs from the start to the
middle of a stretch, a backward vector from its end to the middle, and they meet at the state where their sum is
least; both halves are then solved alike. Among equal sums the crossing whose audit is
ASCII-least counts: the forward vector carries the order of the four audits behind it. Those end at the same row and so
none is the beginning of another; the order of their first halves decides.

Rows are ordered by conversation and turn over range partitions, so a conversation of any length is spread over
tasks. A conversation inside one partition is solved there. One that reaches over several is cut into a piece
per partition: a piece sums up to a table like a row does, and the same meeting of forward and backward vectors over the
pieces gives the states at their borders, from which every piece is solved alone. A partition can only share its first
and its last conversation, so the driver sees at most two small tables per partition. The digest of a
repaired text is SHA-256 of the whole, which has to be read in order: for a conversation
of several pieces one task reads its repaired rows as a stream.

Nulls: a null role or text is one space; a null turn comes first; a null conv_id is a conversation. Rows of
one turn are ordered by role and the MD5 of the text. Empty texts and rows of white space are blank. Repeated rows are
duplicates from the second on. Extra columns are dropped, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

# Costs of the edits and of leaving a truncated row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing written yet, or the initial written last. What may follow each, besides a first system turn.
STATES = ("", "s", "u", "a")
FOLLOWS = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60
#: Cost and edits that end a conversation in each state.
ENDS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))

#: A table: for states before and after, (cost, what orders the ways from one state), None where there is no way.
Table = list[list[tuple[int, object] | None]]


def row_table(initial: str, forced: bool, truncated: bool) -> Table:
    """The cheapest edits of one row, per state before and after it."""
    table: Table = [[None] * 4 for _ in range(4)]
    extra = TRUNCATED if truncated else 0
    for before in range(4):
        state, cost, edits = before, 0, ""
        for _ in range(3):
            ways = [(state, DELETE, "D")]
            if not forced:
                follow = FOLLOWS[state]
                ways.append((follow, REROLE + extra, "R"))
                if initial == STATES[follow]:
                    ways.append((follow, KEEP + extra, "K"))
                if state == 0 and initial == "s":
                    ways.append((1, KEEP + extra, "K"))
            for after, own, letter in ways:
                way = (cost + own, edits + letter)
                if table[before][after] is None or way < table[before][after]:
                    table[before][after] = way
            state, cost, edits = FOLLOWS[state], cost + INSERT, edits + "I"
    return table


ROW_TABLES = {(i, f, t): row_table(i, f, t) for i in (*STATES[1:], "-") for f in (False, True) for t in (False, True)}


def forward(tables: Sequence[Table], low: int, high: int, start: int) -> tuple[list[int], list[int]]:
    """Costs of the four states after ``high - 1``, and the order of the audits that lead there."""
    cost, order = [NEVER] * 4, [0] * 4
    cost[start] = 0
    for t in tables[low:high]:
        ways: list[tuple] = []
        for after in range(4):
            best = (NEVER, 0, 0)
            for before in range(4):
                way = t[before][after]
                if way is not None and cost[before] < NEVER:
                    best = min(best, (cost[before] + way[0], order[before], before))
            ways.append(best)
        cost = [w[0] for w in ways]
        keys = [(w[1], t[w[2]][after][1]) if w[0] < NEVER else None for after, w in enumerate(ways)]
        ranked = sorted(k for k in keys if k is not None)
        order = [ranked.index(k) if k is not None else 0 for k in keys]
    return cost, order


def backward(tables: Sequence[Table], low: int, high: int, end: int) -> list[int]:
    """Costs from the four states before ``low`` to ``end`` after ``high - 1``."""
    cost = [NEVER] * 4
    cost[end] = 0
    for t in reversed(tables[low:high]):
        cost = [min([way[0] + cost[after] for after, way in enumerate(ways) if way is not None], default=NEVER) for ways in t]
    return cost


def crossings(tables: Sequence[Table], start: int, end: int) -> list[int]:
    """The states before the first table, between tables and after the last, on the cheapest and then ASCII-least way."""
    states = [start] * len(tables) + [end]

    def meet(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        cost, order = forward(tables, low, middle, states[low])
        rest = backward(tables, middle, high, states[high])
        states[middle] = min(range(4), key=lambda s: (cost[s] + rest[s], order[s]))
        meet(low, middle)
        meet(middle, high)

    meet(0, len(tables))
    return states


def best_end(tables: Sequence[Table]) -> tuple[int, int]:
    """(state after the last table, cost of everything)."""
    cost, order = forward(tables, 0, len(tables), 0)
    end = min(range(4), key=lambda s: (cost[s] + ENDS[s][0], order[s]))
    return end, cost[end] + ENDS[end][0]


def summed(tables: Sequence[Table]) -> Table:
    """Several tables as one."""
    out: Table = []
    for start in range(4):
        cost, order = forward(tables, 0, len(tables), start)
        out.append([(c, o) if c < NEVER else None for c, o in zip(cost, order)])
    return out


def written(edits: str, state: int, role: str, text: str) -> tuple[list[str], int]:
    """Lines ``role:text`` that one row's edits write, and the state after them."""
    lines = []
    for e in edits:
        if e == "D":
            continue
        if e == "K":
            lines.append(f"{role}:{text}")
            state = STATES.index(role[:1])
        else:
            state = FOLLOWS[state]
            lines.append(f"{ROLES[state]}:{text if e == 'R' else ''}")
    return lines, state


def digest_of(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


class Piece:
    """Rows of one conversation that follow each other in one partition."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.tables: list[Table] = []
        self.seen: set[bytes] = set()
        self.first = self.last = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, seen_before: bool) -> None:
        digest, raw = digest_of(role, text), text.encode().rstrip()
        blank, duplicate = not raw, seen_before or digest in self.seen
        truncated = not blank and raw[-1:] not in (b".", b"!", b"?")
        self.seen.add(digest)
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated and not duplicate
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.first = initial if self.last is None else self.first
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append((role, text))
        self.tables.append(ROW_TABLES[initial if initial in STATES[1:] and initial else "-", blank or duplicate, truncated])

    def counts(self) -> dict:
        return {n: getattr(self, n) for n in ("first", "last", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")}

    def solved(self, start: int, end: int) -> Iterator[tuple[str, list[str]]]:
        """Per row its edits and the lines they write."""
        states = crossings(self.tables, start, end)
        for (role, text), table, before, after in zip(self.rows, self.tables, states, states[1:]):
            edits = table[before][after][1]
            lines, _ = written(edits, before, role, text)
            yield edits, lines


def tail_lines(end: int) -> list[str]:
    return written(ENDS[end][1], end, "", "")[0]


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
TURNS = ("conv_id", "turn", "role", "text", "live", "part", "seen")


def _pieces(batches: Iterator[pa.RecordBatch], skip: frozenset = frozenset()) -> Iterator[tuple[int | None, int, Piece]]:
    """(conv_id, part, piece) of a task's sorted rows."""
    key, piece = None, None
    for batch in batches:
        for conv, turn, role, text, live, part, seen in zip(*[batch.column(c).to_pylist() for c in TURNS]):
            if conv in skip:
                continue
            if (conv, part) != key:
                if piece is not None:
                    yield *key, piece
                key, piece = (conv, part), Piece()
            if live:
                piece.add(turn, role, text, seen)
    if piece is not None:
        yield *key, piece


def _rows(found: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}[c.split()[1]] for c in schema.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=names)


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _whole(shared: frozenset):
    """Results of the conversations that stand in one partition."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for conv, _, p in _pieces(batches, shared):
            end, cost = best_end(p.tables) if p.tables else (0, 0)
            audit, lines = [], []
            for edits, own in p.solved(0, end):
                audit.append(edits)
                lines += own
            audit.append(ENDS[end][1])
            digest = hashlib.sha256("\n".join(lines + tail_lines(end)).encode()).hexdigest()
            found.append((conv, _gaps(p.low, p.high, p.turns), p.blank, p.duplicate, p.truncated, p.illegal, cost, "".join(audit), digest))
            if len(found) == 2048:
                yield _rows(found, RESULT)
                found = []
        yield _rows(found, RESULT)

    return results


SUMMARY = (
    "conv_id bigint, part int, first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "turns bigint, low bigint, high bigint, n bigint, cost array<bigint>, order array<bigint>"
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for conv, part, p in _pieces(batches):
        ways = [w for row in summed(p.tables) for w in row]
        cost, order = [w[0] if w else NEVER for w in ways], [w[1] if w else 0 for w in ways]
        found.append((conv, part, *p.counts().values(), len(p.rows), cost, order))
    yield _rows(found, SUMMARY)


LINES = "conv_id bigint, part int, number bigint, edits string, lines string"


def _solved_pieces(borders: dict):
    """Per row of a shared conversation its edits and what they write."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for conv, part, p in _pieces(batches):
            for number, (edits, lines) in enumerate(p.solved(*borders[conv, part])):
                found.append((conv, part, number, edits, "".join(f"\n{line}" for line in lines)))
                if len(found) == 2048:
                    yield _rows(found, LINES)
                    found = []
        yield _rows(found, LINES)

    return results


def _digested(totals: dict):
    """Results of shared conversations from their sorted lines, read as a stream."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, audit, digest, begun = None, [], None, False
        found = []

        def close() -> None:
            end, facts = totals[at]
            for line in tail_lines(end):
                update(f"\n{line}")
            found.append((at, *facts, "".join(audit) + ENDS[end][1], digest.hexdigest()))

        def update(lines: str) -> None:
            nonlocal begun
            digest.update((lines if begun else lines[1:]).encode())
            begun = begun or bool(lines)

        for batch in batches:
            for conv, edits, lines in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "edits", "lines")]):
                if digest is None or conv != at:
                    if digest is not None:
                        close()
                    at, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(edits)
                update(lines)
        if digest is not None:
            close()
        yield _rows(found, RESULT)

    return results


def _order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn"), F.col("role"), F.md5("text"), F.col("tie")]


def placed(turns: DataFrame) -> DataFrame:
    """The rows in order over range partitions, each with the number of its partition, written once."""
    live = F.col("live") if "live" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        live.alias("live"),
    )
    # Equal rows may change places: the number only lets a range end between them.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    return settled(ranged.withColumns({"part": F.spark_partition_id(), "seen": F.lit(False)}))


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a task."""
    ends: list = []
    for batch in batches:
        if len(batch):
            first, last = ([batch.column(c)[i].as_py() for c in ("conv_id", "part")] for i in (0, -1))
            ends = [*ends[:1], first, last] if not ends else [ends[0], last]
    yield _rows([tuple(e) for e in dict.fromkeys(map(tuple, ends))], "conv_id bigint, part int")


def _shared(rows: DataFrame) -> DataFrame:
    """Results of the conversations of several pieces."""
    spark = rows.sparkSession
    # What an earlier piece has said; within a piece each text counts once.
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    marked = rows.withColumn("said", F.when(F.col("live"), digest))
    first = marked.groupBy(F.col("conv_id").alias("k_conv"), F.col("said").alias("k_said")).agg(F.min("part").alias("k_part"), F.max("part").alias("k_last"))
    first = first.where("k_part < k_last and k_said is not null").drop("k_last")
    same = F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("said") == F.col("k_said"))
    joined = marked.join(first, same, "left").withColumn("seen", F.coalesce(F.col("part") > F.col("k_part"), F.lit(False)))
    ordered = settled(joined.drop("said", "k_conv", "k_said", "k_part").repartition("part").sortWithinPartitions("part", *_order()))
    pieces: dict = {}
    # At most two rows per partition.
    for r in ordered.select(*TURNS).mapInArrow(_summaries, SUMMARY).collect():
        pieces.setdefault(r.conv_id, []).append(r)
    borders, totals = {}, {}
    for conv, own in pieces.items():
        own.sort(key=lambda r: r.part)
        own = [r for r in own if r.n] or own[:1]
        tables = [[[(c, o) if c < NEVER else None for c, o in zip(r.cost[4 * s : 4 * s + 4], r.order[4 * s : 4 * s + 4])] for s in range(4)] for r in own]
        end, cost = best_end(tables)
        states = crossings(tables, 0, end)
        borders.update({(conv, r.part): (a, b) for r, a, b in zip(own, states, states[1:])})
        timed = [r for r in own if r.low is not None]
        turns = sum(r.turns for r in timed) - sum(a.high == b.low for a, b in zip(timed, timed[1:]))
        gaps = _gaps(timed[0].low, timed[-1].high, turns) if timed else 0
        between = sum(a.last + b.first not in LEGAL for a, b in zip(own, own[1:]))
        faults = [sum(r[n] for r in own) for n in ("blank", "duplicate", "truncated", "illegal")]
        totals[conv] = (end, (gaps, *faults[:3], faults[3] + between, cost))
    borders.update({(r.conv_id, r.part): (0, 0) for own in pieces.values() for r in own if (r.conv_id, r.part) not in borders})
    lines = ordered.select(*TURNS).mapInArrow(_solved_pieces(borders), LINES)
    silent = [(c, *f, ENDS[e][1], hashlib.sha256(b"").hexdigest()) for c, (e, f) in totals.items() if not any(r.n for r in pieces[c])]
    spoken = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(_digested(totals), RESULT)
    return spoken.unionAll(spark.createDataFrame(silent, RESULT)) if silent else spoken


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; ``live``: false for rows that only name their
    conversation): gaps, faults, cost, audit of the edits, digest of the repaired text."""
    rows = placed(turns)
    # At most two rows per partition.
    ends = rows.select("conv_id", "part").mapInArrow(_ends_of, "conv_id bigint, part int").collect()
    parts: dict = {}
    for r in ends:
        parts.setdefault(r.conv_id, set()).add(r.part)
    shared = frozenset(c for c, p in parts.items() if len(p) > 1)
    whole = rows.select(*TURNS).mapInArrow(_whole(shared), RESULT)
    if not shared:
        return whole
    named = rows.sparkSession.createDataFrame([(c,) for c in shared], "s_conv bigint")
    own = rows.join(F.broadcast(named), F.col("conv_id").eqNullSafe(F.col("s_conv")), "left_semi")
    return whole.unionAll(_shared(own))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): rows with known faults, chosen by the CRC of conversation and turn."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("live"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")
