"""Token counts by a compiled finite-state transducer.

The byte-pair merges of a tokenizer file are compiled, as texts need it, into a
deterministic transducer over bytes. A state holds the stretches of input that may still
become a token, each with the token before it; a transition is annotated with the change
in the number of emitted tokens. A piece's count is the sum along its path. It is exact:
of all tokens that could end at a byte just one follows its predecessor as the merges
would have it.

Texts are read in chunks. What a chunk does to a count is a state map of three parts: an
open head up to its first certain piece boundary (a character that is no space, followed
by a space), the tokens up to its last, and an open tail. These maps compose
associatively, whatever the chunks' bounds, so the maps of a long text's chunks are scanned.

Nulls: a null or empty text has no tokens. Strings of special tokens inside texts are one
token each, as in the library's default. Repeated ids stay rows of their own; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, reduce

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

LIMIT = 512
CHUNK = 1 << 20
#: Pieces and transitions a task keeps at most; beyond it starts compiling afresh.
KEPT = 400_000

# Fixed value: the splitting pattern of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BOUNDARY = r"(?<=\S)\s"


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in such files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load(path: str) -> tuple[dict, list[str]]:
    """(rank of each pair of byte strings, special strings) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError("only byte-level BPE files are supported")
    table = byte_characters()
    as_bytes = lambda s: bytes(table[c] for c in s)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
    return ranks, [t["content"] for t in spec.get("added_tokens", []) if t["special"]]


class Transducer:
    def __init__(self, ranks: dict):
        self.ranks = ranks
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in ranks}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.fits = lru_cache(maxsize=KEPT)(self._fits)
        self._forget()

    def _forget(self) -> None:
        start = ((b"", b"", 0),)
        self.states, self.number, self.moves = [start], {start: 0}, {}

    def merge(self, data: bytes) -> list[bytes]:
        """The tokens of a short byte string, by the merges themselves."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, before: bytes, token: bytes) -> bool:
        return self.merge(before + token) == ([before, token] if before else [token])

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state on a byte: (next state, change in the count)."""
        letter = bytes([byte])
        grown = [(part + letter, before, count) for part, before, count in self.states[state]]
        token, change = next((t, c + 1) for t, before, c in grown if t in self.tokens and self.fits(before, t))
        live = tuple((part, before, c - change) for part, before, c in grown if part in self.prefixes)
        target = (*live, (b"", token, 0))
        number = self.number.setdefault(target, len(self.states))
        if number == len(self.states):
            self.states.append(target)
        self.moves[state, byte] = move = (number, change)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.moves) > KEPT:
            self._forget()
        state = total = 0
        for byte in piece:
            state, change = self.moves.get((state, byte)) or self._compile(state, byte)
            total += change
        return total


class Pieces(dict):
    """Counts of pieces seen before; others run through the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        if len(self) > KEPT:
            self.clear()
        self[piece] = n = self.transducer.count(piece.encode("utf-8"))
        return n


class TokenCounter:
    def __init__(self, ranks: dict, special: list[str]):
        self.pieces = Pieces(Transducer(ranks))
        self.find = regex.compile(PATTERN).findall
        self.boundary = regex.compile(BOUNDARY)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def span(self, text: str) -> int:
        """Tokens of a stretch between certain boundaries."""
        parts = [text]
        extra = 0
        if self.special is not None:
            parts = self.special.split(text)
            extra = len(parts) - 1
        return extra + sum(sum(map(self.pieces.__getitem__, self.find(p))) for p in parts)

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens, tail); tokens is None if no boundary is certain within."""
        first = self.boundary.search(chunk)
        if first is None:
            return chunk, None, ""
        last = first.start()
        for m in self.boundary.finditer(chunk, max(last, len(chunk) - 4096)):
            last = m.start()
        return chunk[: first.start()], self.span(chunk[first.start() : last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks together."""
        if a[1] is None:
            joined = a[0] + b[0]
            if b[1] is None:
                return self.state_map(joined)
            head, n, tail = self.state_map(joined)
            return (joined, b[1], b[2]) if n is None else (head, n + self.span(tail) + b[1], b[2])
        middle = a[2] + b[0]
        if b[1] is not None:
            return a[0], a[1] + self.span(middle) + b[1], b[2]
        head, n, tail = self.state_map(middle)
        return (a[0], a[1], middle) if n is None else (a[0], a[1] + self.span(head) + n, tail)

    def count(self, text: str | None, chunk: int = CHUNK) -> int:
        if not text:
            return 0
        if len(text) <= chunk:
            return self.span(text)
        maps = (self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk))
        head, n, tail = reduce(self.compose, maps)
        return self.span(head) + (n or 0) + self.span(tail)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, by the tokenizer file at ``path``."""
    shipped = docs.sparkSession.sparkContext.broadcast(load(path))

    @pandas_udf(LongType())
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(*shipped.value)
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        tokens("text").alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
