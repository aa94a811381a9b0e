"""Conversations as training text, by a state machine over roles and a declarative template.

The machine reads a conversation's turns in order. Each role moves it along the
template's table of turns; a role the table does not allow marks the turn as out of order
and leaves the state. Every turn becomes one chunk of text, with spans that say which characters
count for the loss. Control strings inside texts are escaped, so that the output can be
read back exactly. Turns are dealt by conversation and sorted within partitions; the
machine streams over them, so a conversation of any length needs little memory.

Nulls: null text and null role are empty. Null conv_id: those rows are one conversation.
Null turns come first. Rows of one turn number follow each other by role and text; repeated rows are
turns of their own. Roles outside the template keep their name in the output.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

#: role: (before, after, whether its text counts for the loss); turns: state -> role -> state.
TEMPLATE = {
    "begin": "<s>",
    "roles": {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n", False),
        "user": ("[INST] ", " [/INST]", False),
        "assistant": (" ", "</s>", True),
    },
    "other": ("<<ROLE>>", "<</ROLE>>", "<</TURN>>"),
    "turns": {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
}


def controls(template: dict) -> list[str]:
    """The strings that must not occur inside texts, longest first."""
    parts = [template["begin"], *template["other"]]
    parts += [p for before, after, _ in template["roles"].values() for p in (before, after)]
    return sorted({p.strip() for p in parts if p.strip()}, key=lambda p: (-len(p), p))


class Format:
    """Writes turns by a template and reads them back."""

    def __init__(self, template: dict = TEMPLATE):
        self.template = template
        self._special = re.compile("|".join([r"\\", *map(re.escape, controls(template))]))
        roles = "|".join(
            f"(?P<{name}>{re.escape(before)}(?P<{name}_text>.*?){re.escape(after)})"
            for name, (before, after, _) in sorted(template["roles"].items(), key=lambda r: -len(r[1][0]))
        )
        a, b, c = map(re.escape, template["other"])
        self._turn = re.compile(f"(?:{re.escape(template['begin'])})?(?:{a}(?P<role>.*?){b}(?P<text>.*?){c}|{roles})", re.DOTALL)

    def escape(self, text: str) -> str:
        """A backslash is doubled; another goes behind the first character of a control string."""
        return self._special.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The state after a role, and whether the role was in order."""
        after = self.template["turns"].get(state, {}).get(role)
        return (state, False) if after is None else (after, True)

    def write(self, role: str, text: str, first: bool) -> tuple[str, list[dict]]:
        """A turn's chunk and its spans."""
        if role in self.template["roles"]:
            before, after, loss = self.template["roles"][role]
        else:
            a, b, after = self.template["other"]
            before, loss = a + self.escape(role) + b, False
        before = (self.template["begin"] if first else "") + before
        inner = self.escape(text)
        begin, end = len(before), len(before) + len(inner)
        spans = [(0, begin, False), (begin, end, loss), (end, end + len(after), False)]
        return before + inner + after, [{"from": x, "to": y, "loss": z} for x, y, z in spans if y > x]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a formatted conversation or chunk."""
        turns, at = [], 0
        while at < len(formatted):
            m = self._turn.match(formatted, at)
            if m is None:
                raise ValueError(f"no turn at character {at}")
            role = next((r for r in self.template["roles"] if m[r] is not None), None)
            turn = (self.unescape(m["role"]), m["text"]) if role is None else (role, m[f"{role}_text"])
            turns.append((turn[0], self.unescape(turn[1])))
            at = m.end()
        return turns


CHUNKS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("number", pa.int64()),
        ("in_order", pa.bool_()),
        ("chunk", pa.string()),
        ("spans", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("loss", pa.bool_())]))),
    ]
)
CHUNKS_DDL = "conv_id bigint, number bigint, in_order boolean, chunk string, spans array<struct<from:int,to:int,loss:boolean>>"
DIGESTS_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, in_order boolean"
)


def format_turns(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn, conversations whole and in order within partitions."""

    def run(batches):
        form, current, state, number = Format(template), [], "", 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if current != [conv]:
                    current, state, number = [conv], "start", 0
                state, good = form.step(state, role or "")
                chunk, spans = form.write(role or "", text or "", number == 0)
                rows.append((conv, number, good, chunk, spans))
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNKS)] if rows else [pa.array([], f.type) for f in CHUNKS], schema=CHUNKS)

    turns = conversations.selectExpr("CAST(conv_id AS bigint) AS conv_id", "turn", "role", "text")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, CHUNKS_DDL)


def digests(chunks: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation, read back from the chunks of ``format_turns``."""

    def run(batches):
        form, current, tally = Format(template), [], None

        def row():
            n, turns, chars, loss, total, good = tally
            return current[0], n, turns.hexdigest(), chars, loss.hexdigest(), total, good

        def table(rows):
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            rows = []
            for conv, good, chunk, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "in_order", "chunk", "spans"))):
                if current != [conv]:
                    if current:
                        rows.append(row())
                    current, tally = [conv], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                for role, text in form.read(chunk):
                    tally[0] += 1
                    tally[1].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    if span["loss"]:
                        counted = form.unescape(chunk[span["from"] : span["to"]])
                        tally[2] += len(counted)
                        tally[3].update(counted.encode())
                tally[4] += len(chunk)
                tally[5] = tally[5] and good
            yield table(rows)
        if current:
            yield table([row()])

    return chunks.mapInArrow(run, DIGESTS_DDL)
