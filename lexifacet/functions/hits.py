"""Row-local work on hits.

A hit is ``struct<p: int, w: string>``: token position and token. One document
is one row and one field's hits are one array in it, ordered by position, so
match predicates and ranking factors need no exchange at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

HIT_TYPE = "array<struct<p:int,w:string>>"

WordTest = Callable[[Column], Column]


def token_test(forms: Sequence[str], wild: Sequence[WordTest] = ()) -> WordTest:
    """A test that passes for the given tokens and for what the wildcards accept.
    Its ``forms`` are the tokens, or None when wildcards take part."""
    forms = list(forms)

    def test(token: Column) -> Column:
        checks = [token.isin(forms) if len(forms) > 1 else token == forms[0]] if forms else []
        return reduce(lambda a, b: a | b, checks + [t(token) for t in wild])

    test.forms = None if wild else forms
    return test


def any_test(tests: Iterable[WordTest]) -> WordTest:
    """A test that passes where any of the tests does."""
    tests = list(tests)
    plain = sorted({form for t in tests if t.forms is not None for form in t.forms})
    return token_test(plain, [t for t in tests if t.forms is None])


def positions(tokens: Column, test: WordTest) -> Column:
    """Positions of the tokens that pass ``test``."""
    return F.filter(
        F.transform(tokens, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull()
    )


def hits(tokens: Column, test: WordTest) -> Column:
    """Hits among ``tokens``; ``tokens`` is evaluated once."""
    return let(
        tokens,
        lambda ws: F.transform(
            positions(ws, test), lambda i: F.struct(i.alias("p"), F.get(ws, i).alias("w"))
        ),
    )


def count_hits(field_hits: Column, test: WordTest) -> Column:
    return F.size(F.filter(field_hits, lambda h: test(h["w"])))


def has_hit(field_hits: Column, test: WordTest) -> Column:
    return F.exists(field_hits, lambda h: test(h["w"]))


def aligned(field_hits: Column, query: Sequence[tuple[int, WordTest]]) -> Column:
    """Sorted ``(d, q)`` pairs: query word number q stands at offset d + its position."""
    pairs = F.flatten(
        F.transform(
            field_hits,
            lambda h: F.array(
                *[
                    F.when(
                        test(h["w"]),
                        F.struct((h["p"] - F.lit(at)).alias("d"), F.lit(q).alias("q")),
                    )
                    for q, (at, test) in enumerate(query)
                ]
            ),
        )
    )
    return F.sort_array(F.array_compact(pairs))


def longest_run(pairs: Column) -> Column:
    """Longest chain of consecutive q under one d in sorted ``(d, q)`` pairs."""
    start = F.struct(
        F.lit(None).cast("int").alias("d"),
        F.lit(0).alias("q"),
        F.lit(0).alias("run"),
        F.lit(0).alias("best"),
    )

    def step(acc: Column, pair: Column) -> Column:
        run = F.when(
            acc["d"].eqNullSafe(pair["d"]) & (pair["q"] == acc["q"] + 1), acc["run"] + 1
        ).otherwise(1)
        return F.struct(
            pair["d"].alias("d"),
            pair["q"].alias("q"),
            run.alias("run"),
            F.greatest(acc["best"], run).alias("best"),
        )

    return F.aggregate(pairs, start, step, lambda acc: acc["best"])


def longest_common_run(field_hits: Column, query: Sequence[tuple[int, WordTest]]) -> Column:
    """How many query words stand together, in order, at the best place of the field."""
    if len(query) == 1:
        return has_hit(field_hits, query[0][1]).cast("int")
    return longest_run(aligned(field_hits, query))


def within_span(field_hits: Column, tests: Sequence[WordTest], span: int) -> Column:
    """True when one window of ``span`` tokens holds a hit of every test."""
    unseen = F.lit(-1)
    start = F.struct(
        *[unseen.alias(f"s{k}") for k in range(len(tests))], F.lit(False).alias("found")
    )

    def step(acc: Column, h: Column) -> Column:
        last = [F.when(test(h["w"]), h["p"]).otherwise(acc[f"s{k}"]) for k, test in enumerate(tests)]
        oldest = F.least(*last) if len(last) > 1 else last[0]
        found = acc["found"] | ((oldest >= 0) & (h["p"] - oldest < span))
        return F.struct(*[c.alias(f"s{k}") for k, c in enumerate(last)], found.alias("found"))

    return F.aggregate(field_hits, start, step, lambda acc: acc["found"])


def term_counts(tokens: Column) -> Column:
    """``array<struct<token, hits>>`` of one row's tokens: sorted, then cut into runs."""

    def cut(ws: Column) -> Column:
        starts = F.filter(
            F.transform(ws, lambda w, i: F.when((i == 0) | (w != F.get(ws, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(ws, i).alias("token"),
                    (F.coalesce(F.get(at, k + 1), F.size(ws)) - i).alias("hits"),
                ),
            ),
        )

    return let(F.sort_array(tokens), cut)
