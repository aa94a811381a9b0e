"""Repair of conversations against a search through all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexifacet.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, live boolean, seen int"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def slow(rows):
    """(cost, audit, repaired) by uniform-cost search over written initials."""
    found = faults(rows)
    heap, done = [(0, "", 0, ())], {}
    good = re.compile("(s?(ua)+)?")
    while heap:
        cost, audit, at, said = heapq.heappop(heap)
        initials = "".join(r[:1] if len(r[:1]) else "?" for r, _ in said)
        state = (at, initials[-1:], bool(initials))
        if done.setdefault(state, (cost, audit)) < (cost, audit):
            continue
        if at == len(rows) and good.fullmatch(initials):
            return cost, audit, said
        follow = "assistant" if initials.endswith("u") else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", at, (*said, (follow, ""))))
        if at < len(rows):
            role, text = rows[at][2:]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, said))
            extra = 3 * (found[at] == "truncated")
            if found[at] in ("", "truncated"):
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, (*said, (follow, text))))
                if role[:1] == follow[0] or (role[:1] == "s" and not initials):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, (*said, (role, text))))


def expected(rows, every):
    out = {}
    for conv in every:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(faults(own))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = slow(own)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    out = []
    for c in range(150):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "sage"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut", "", " \n", None, "é", "ok. "]) if rng.random() < 0.4 else f"{rng.random()}{rng.choice('.?,')}"
            out.append((c, rng.choice([t, t, 2 * t, None]), role, text))
    out += [(None, 1, "user", "hi."), (None, None, "assistant", "so."), (800, 5, "user", "x" * 100000)]
    return out


def check(got, want):
    got = {r.conv_id: tuple(r) for r in got.collect()}
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv] == row


def test_repair(spark, rows):
    df = spark.createDataFrame([(*r, 1, False, 2) for r in rows], SCHEMA).drop("live")
    want = expected(damaged(rows), {r[0] for r in rows})
    check(repair.repair(repair.damaged(df)), want)
    assert repair.repair(df.limit(0)).count() == 0


def test_long_conversations_reach_over_partitions(spark):
    rng = random.Random(14)
    roles = ["user", "assistant", "system"]
    rows = [(1, t // 3, rng.choice(roles), rng.choice([f"{rng.random()}.", f"{rng.random()}", "Again.", ""])) for t in range(700)]
    rows += [(2, 0, "user", "Same.")] * 300 + [(3, t, "tool", "") for t in range(200)] + [(4, 0, "user", "hi.")]
    df = spark.createDataFrame([(*r, 1, r[0] != 4, 2) for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repair.placed(df).groupBy("conv_id").agg(F.countDistinct("part").alias("n")).where("n > 1").count() >= 3
        check(repair.repair(df), expected([r for r in rows if r[0] != 4], {1, 2, 3, 4}))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_crossings_are_least():
    rng = random.Random(15)
    for _ in range(300):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"{i}.", f"{i}", "", "a."])) for i in range(rng.randint(0, 12))]
        piece = repair.Piece()
        for _, turn, role, text in rows:
            piece.add(turn, role, text, False)
        end, cost = repair.best_end(piece.tables)
        audit = "".join(e for e, _ in piece.solved(0, end)) + repair.ENDS[end][1]
        assert (cost, audit) == slow(rows)[:2]
