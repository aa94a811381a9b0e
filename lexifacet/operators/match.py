"""Match conditions as predicate objects.

Users compose these objects instead of writing a query string; each becomes one
row-local Column over the hits of a document.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import hits as H
from ..functions import text as T
from ..sources.collection import Collection, FieldHits


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


class Condition:
    """Base of all match conditions; ``&``, ``|`` and ``~`` combine them."""

    def __and__(self, other):
        return And(self, other)

    def __or__(self, other):
        return Or(self, other)

    def __invert__(self):
        return Not(self)

    def leaves(self) -> list[Condition]:
        """Word-bearing parts outside any negation, in writing order."""
        return [self]

    def parts(self) -> list[Condition]:
        """Every word-bearing part, negated or not."""
        return [self]

    def without(self, stopwords: frozenset[str]) -> Condition | None:
        """The condition with its stop words left out; None when nothing remains."""
        kept = [w for _, w in self.words() if w.text.lower() not in stopwords]
        return self if kept else None


def _pick(fields: Sequence[FieldHits], names) -> list[FieldHits]:
    if names is None:
        return list(fields)
    unknown = set(names) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"no such field: {sorted(unknown)}")
    return [f for f in fields if f.name in names]


def _names(fields):
    return None if fields is None else tuple([fields] if isinstance(fields, str) else fields)


@dataclass(frozen=True)
class Word(Condition):
    """A word, ``pre*fix`` wildcard or, with ``exact``, an un-normalised token."""

    text: str
    fields: tuple[str, ...] | str | None = None
    first: bool = False
    last: bool = False
    exact: bool = False

    def __post_init__(self):
        if not isinstance(self.text, str):
            raise TypeError("a word must be a string")
        # Marks may come from folding the case of a letter.
        if not regex.fullmatch(r"[\p{L}\p{N}\p{M}_*]+", self.text):
            raise ValueError(f"a word is one token, which {self.text!r} is not: use Phrase or match()")

    def words(self):
        return [(0, self)]

    def test(self, collection: Collection) -> H.WordTest:
        """The token test of this word; ``forms`` lists its tokens, None for a wildcard."""
        text = self.text.lower()
        if "*" in text:
            pattern = text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
            pattern = pattern.replace("*", "%")
            return H.token_test([], [lambda w: w.like(pattern)])
        return H.token_test([text] if self.exact else collection.forms(text))

    def holds(self, collection, fields) -> Column:
        test = self.test(collection)

        def in_field(f: FieldHits) -> Column:
            def at_place(h: Column) -> Column:
                checks = [test(h["w"])]
                if self.first:
                    checks.append(h["p"] == 0)
                if self.last:
                    checks.append(h["p"] == f.length - 1)
                return all_of(checks)

            return F.exists(f.hits, at_place)

        return any_of([in_field(f) for f in _pick(fields, _names(self.fields))])

    def may_hold(self, collection, texts) -> Column | None:
        """A cheap necessary condition on the lower-cased raw fields."""
        text = self.text.lower()
        forms = text.split("*") if "*" in text else collection.forms(text)
        if "*" in text:
            literal = [p for p in forms if p]
            return any_of([all_of([t.contains(p) for p in literal]) for t in texts]) if literal else None
        if self.exact:
            forms = [text]
        return any_of([t.contains(f) for f in forms for t in texts])


class _Sequence(Condition):
    """Shared by conditions made of several words."""

    def words(self):
        return list(enumerate([Word(w) for w in self.texts]))

    def kept(self, collection):
        return [(i, w) for i, w in self.words() if w.text.lower() not in collection.stopwords]

    def distinct(self, collection):
        seen = {}
        for _, w in self.kept(collection):
            seen.setdefault(w.text.lower(), w)
        return list(seen.values())


@dataclass(frozen=True)
class Phrase(_Sequence):
    """Words side by side, in order, inside one field."""

    texts: tuple[str, ...]
    fields: tuple[str, ...] | str | None = None

    def __post_init__(self):
        given = T.query_words(self.texts) if isinstance(self.texts, str) else self.texts
        object.__setattr__(self, "texts", tuple(given))

    def holds(self, collection, fields) -> Column:
        query = [(at, w.test(collection)) for at, w in self.kept(collection)]
        return any_of(
            [
                H.longest_common_run(f.hits, query) == len(query)
                for f in _pick(fields, _names(self.fields))
            ]
        )

    def may_hold(self, collection, texts):
        return And(*self.distinct(collection)).may_hold(collection, texts)


@dataclass(frozen=True)
class Near(_Sequence):
    """All words inside one window of ``span`` tokens of one field."""

    texts: tuple[str, ...]
    span: int
    fields: tuple[str, ...] | str | None = None

    def __post_init__(self):
        given = T.query_words(self.texts) if isinstance(self.texts, str) else self.texts
        object.__setattr__(self, "texts", tuple(given))
        if self.span < 1:
            raise ValueError("span must be positive")

    def holds(self, collection, fields) -> Column:
        tests = [w.test(collection) for w in self.distinct(collection)]
        return any_of(
            [H.within_span(f.hits, tests, self.span) for f in _pick(fields, _names(self.fields))]
        )

    def may_hold(self, collection, texts):
        return And(*self.distinct(collection)).may_hold(collection, texts)


@dataclass(frozen=True)
class Quorum(_Sequence):
    """At least ``least`` of the distinct words, in any of the fields."""

    texts: tuple[str, ...]
    least: int
    fields: tuple[str, ...] | str | None = None

    def __post_init__(self):
        given = T.query_words(self.texts) if isinstance(self.texts, str) else self.texts
        object.__setattr__(self, "texts", tuple(given))
        if self.least < 1:
            raise ValueError("a quorum needs at least one word")

    def holds(self, collection, fields) -> Column:
        names = _names(self.fields)
        found = [
            Word(w.text, names).holds(collection, fields).cast("int")
            for w in self.distinct(collection)
        ]
        return reduce(lambda a, b: a + b, found) >= self.least

    def may_hold(self, collection, texts):
        return Or(*self.distinct(collection)).may_hold(collection, texts)


class _Combined(Condition):
    def __init__(self, *conditions):
        self.conditions = tuple(Word(c) if isinstance(c, str) else c for c in conditions)
        if not self.conditions:
            raise ValueError("nothing to combine")

    def leaves(self):
        return [leaf for c in self.conditions for leaf in c.leaves()]

    def parts(self):
        return [part for c in self.conditions for part in c.parts()]

    def without(self, stopwords):
        kept = [c.without(stopwords) for c in self.conditions]
        kept = [c for c in kept if c is not None]
        return type(self)(*kept) if kept else None


class And(_Combined):
    def holds(self, collection, fields):
        return all_of([c.holds(collection, fields) for c in self.conditions])

    def may_hold(self, collection, texts):
        known = [c.may_hold(collection, texts) for c in self.conditions]
        known = [k for k in known if k is not None]
        return all_of(known) if known else None


class Or(_Combined):
    def holds(self, collection, fields):
        return any_of([c.holds(collection, fields) for c in self.conditions])

    def may_hold(self, collection, texts):
        known = [c.may_hold(collection, texts) for c in self.conditions]
        return None if any(k is None for k in known) else any_of(known)


class Not(_Combined):
    def __init__(self, condition):
        super().__init__(condition)

    def leaves(self):
        return []

    def holds(self, collection, fields):
        return ~self.conditions[0].holds(collection, fields)

    def may_hold(self, collection, texts):
        return None


def positive_only(tree: Condition) -> bool:
    """A tree is usable when each branch it can match by names a word to look for."""
    if isinstance(tree, Not):
        return False
    if isinstance(tree, And):
        return any(positive_only(c) for c in tree.conditions)
    if isinstance(tree, Or):
        return all(positive_only(c) for c in tree.conditions)
    return True


def from_text(text: str, mode: str, stopwords=frozenset()) -> Condition | None:
    """The condition of a plain query text under a word-bag mode; None without words."""
    words = T.query_words(text)
    kept = [w for w in words if w not in stopwords]
    if not kept:
        return None
    if mode == "phrase":
        return Phrase(tuple(words))
    distinct = [Word(w) for w in dict.fromkeys(kept)]
    return (Or if mode == "any" else And)(*distinct)


def word_sequence(tree: Condition, collection: Collection) -> list[tuple[int, Word]]:
    """(position in the query, word) of every positive word, stopwords left out."""
    out, start = [], 0
    for leaf in tree.leaves():
        words = leaf.words()
        out += [(start + at, w) for at, w in words if w.text.lower() not in collection.stopwords]
        start += len(words)
    return out


def distinct_words(sequence: list[tuple[int, Word]]) -> list[Word]:
    return list({(w.text.lower(), w.exact): w for _, w in sequence}.values())


def any_word_test(tree: Condition, collection: Collection) -> H.WordTest:
    """A token test that passes for the tokens of every word in the tree."""
    return H.any_test(w.test(collection) for part in tree.parts() for _, w in part.words())
