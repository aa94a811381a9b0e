"""The query builder: an immutable description that becomes one Spark plan.

Every method returns a new ``Search`` and runs no job. Arguments are checked when
they are given.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from numbers import Integral, Real
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.calendar import time_segment
from .functions.frames import compute_once
from .functions.geo import haversine
from .operators import filters as flt
from .operators import groups as grp
from .operators import match as m
from .operators import order as o
from .operators.keywords import word_stats
from .operators.match import Word
from .operators.merge import merge_collections
from .operators.overrides import check_values, override_frame
from .operators.rank import MODE_RANKERS, RANKERS, Ranking, positional_weights
from .sources.collection import Collection, one_per_id

# Match mode names and the defaults of a new query.
MATCH_MODES = ("all", "any", "phrase", "boolean", "extended", "extended2", "fullscan")
IDF_FLAVOURS = ("normalized", "plain")
DEFAULT_LIMIT = 20
DEFAULT_MAX_MATCHES = 1000
DEFAULT_GROUP_SORT = "@group desc"

_ALIASED = re.compile(r"(?is)\sas\s+`?([A-Za-z_]\w*)`?\s*$")
#: Functions that make a selected expression an aggregate of its group.
_AGGREGATE = re.compile(r"(?is)^\s*(avg|min|max|sum|count)\s*\(")
_NAME = re.compile(r"^\s*(\*|@?[A-Za-z_]\w*)\s*$")


def _choice(value: str, allowed: Sequence[str], what: str) -> str:
    if not isinstance(value, str):
        raise TypeError(f"{what} must be a string")
    if value.lower() not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}")
    return value.lower()


def _count(value, what: str, least: int) -> int:
    if isinstance(value, bool) or not isinstance(value, Integral):
        raise TypeError(f"{what} must be an integer")
    if value < least:
        raise ValueError(f"{what} must be at least {least}")
    return int(value)


def _text(value, what: str) -> str:
    if not isinstance(value, str):
        raise TypeError(f"{what} must be a string")
    return value


def _weights(weights, what: str) -> dict[str, int]:
    if not isinstance(weights, Mapping):
        raise TypeError(f"{what} must map names to integers")
    for name, weight in weights.items():
        _text(name, f"each name in {what}")
        if isinstance(weight, bool) or not isinstance(weight, Integral):
            raise TypeError(f"each weight in {what} must be an integer")
    return dict(weights)


class Result(NamedTuple):
    matches: DataFrame
    totals: DataFrame
    words: DataFrame | None
    fields: tuple[str, ...]
    attrs: tuple[str, ...]


@dataclass(frozen=True)
class Search:
    collections: tuple[Collection, ...]
    text: str = ""
    tree: m.Condition | None = None
    mode: str = "all"
    ranker: str | None = None
    rank_expr: tuple[str, str] | None = None
    idf_flavour: str = "normalized"
    weights: Mapping[str, int] = field(default_factory=dict)
    positional: tuple[int, ...] = ()
    collection_weights: Mapping[str, int] | None = None
    filters: tuple = ()
    computed_filters: tuple = ()
    ids: tuple[int, int] = (0, 0)
    anchor: tuple | None = None
    overrides: tuple = ()
    selected: tuple[str, ...] = ("*",)
    sort: tuple = ("relevance", None)
    group: tuple | None = None
    distinct: str | None = None
    distinct_error: float | None = None
    group_columns: Mapping[str, Column] = field(default_factory=dict)
    offset: int = 0
    limit: int = DEFAULT_LIMIT
    max_matches: int = DEFAULT_MAX_MATCHES
    cutoff: int = 0
    outer: tuple | None = None

    @classmethod
    def over(cls, *collections: Collection) -> Search:
        if not collections or not all(isinstance(c, Collection) for c in collections):
            raise TypeError("a search runs over one or more collections")
        return cls(tuple(collections))

    # -- what to match -----------------------------------------------------------

    def match(self, text: str, mode: str = "all") -> Search:
        """Match a plain text: all words, any word, or the phrase."""
        mode = _choice(mode, MATCH_MODES, "match mode")
        if mode in ("boolean", "extended", "extended2"):
            raise ValueError(f"mode {mode} takes a condition: use where()")
        return replace(self, text=_text(text, "text"), tree=None, mode=mode)

    def where(self, tree: m.Condition | str, mode: str = "extended") -> Search:
        """Match a condition built from Word, Phrase, Near, Quorum, And, Or, Not."""
        mode = _choice(mode, ("boolean", "extended", "extended2"), "match mode")
        tree = m.Word(tree) if isinstance(tree, str) else tree
        if not isinstance(tree, m.Condition):
            raise TypeError("where() takes a match condition")
        if not m.positive_only(tree):
            raise ValueError("a condition needs at least one word to look for")
        return replace(self, text="", tree=tree, mode=mode)

    def everything(self) -> Search:
        """Full scan: every document, filters only, weight 1."""
        return replace(self, text="", tree=None, mode="fullscan")

    # -- weights -----------------------------------------------------------------

    def rank(self, ranker: str, per_field: str = "", per_document: str = "field_sum") -> Search:
        """Choose the ranker of extended matches. ``expr`` needs the formula summed
        over fields and the formula of the document."""
        ranker = _choice(ranker, RANKERS, "ranker")
        _text(per_field, "per_field"), _text(per_document, "per_document")
        if ranker == "expr" and not (per_field and per_document):
            raise ValueError("the expr ranker needs a formula")
        return replace(self, ranker=ranker, rank_expr=(per_field, per_document))

    def idf(self, flavour: str) -> Search:
        return replace(self, idf_flavour=_choice(flavour, IDF_FLAVOURS, "idf"))

    def field_weights(self, weights: Mapping[str, int] | Sequence[int]) -> Search:
        """Weights by field name, or a list in field order. Default is 1."""
        if isinstance(weights, (list, tuple)):
            return replace(self, positional=tuple(_count(w, "each weight", -(2**63)) for w in weights))
        return replace(self, weights=_weights(weights, "field weights"))

    def index_weights(self, weights: Mapping[str, int]) -> Search:
        """Sum the weights a document has in several collections, times these."""
        return replace(self, collection_weights=_weights(weights, "collection weights"))

    # -- filters -----------------------------------------------------------------

    def _filtered(self, attr: str, make) -> Search:
        """Add a filter; one on a computed column waits until that column exists."""
        if all(attr in (c.id, *c.attrs) for c in self.collections):
            return replace(self, filters=(*self.filters, (attr, make)))
        if attr not in self.computed_names():
            raise ValueError(f"no such attribute: {attr}")
        return replace(self, computed_filters=(*self.computed_filters, make))

    def filter_values(self, attr: str, values, exclude: bool = False) -> Search:
        attr = o.MAGIC_COLUMNS.get(_text(attr, "attribute"), attr)
        flt.values(attr, values, False, exclude)
        return self._filtered(attr, lambda s: flt.values(attr, values, flt.is_multi(s, attr), exclude, flt.kind_of(s, attr)))

    def filter_range(self, attr: str, low: int, high: int, exclude: bool = False) -> Search:
        attr = o.MAGIC_COLUMNS.get(_text(attr, "attribute"), attr)
        flt.int_range(attr, low, high, False, exclude)
        return self._filtered(
            attr, lambda s: flt.int_range(attr, low, high, flt.is_multi(s, attr), exclude, flt.kind_of(s, attr))
        )

    def filter_float_range(self, attr: str, low: float, high: float, exclude: bool = False) -> Search:
        attr = o.MAGIC_COLUMNS.get(_text(attr, "attribute"), attr)
        flt.float_range(attr, low, high, False, exclude)
        return self._filtered(
            attr, lambda s: flt.float_range(attr, low, high, flt.is_multi(s, attr), exclude)
        )

    def computed_names(self) -> set[str]:
        names = {"weight"} | ({"geodist"} if self.anchor else set())
        return names | {a.group(1) for a in map(_ALIASED.search, self.selected) if a}

    def id_range(self, low: int, high: int) -> Search:
        flt.id_range("id", low, high)
        return replace(self, ids=(low, high))

    def reset_filters(self) -> Search:
        """Drop all filters, the id range excepted, and the geo anchor."""
        return replace(self, filters=(), computed_filters=(), anchor=None)

    # -- columns -----------------------------------------------------------------

    def geo_anchor(self, lat: str, lon: str, at_lat: float, at_lon: float) -> Search:
        """Add ``geodist``: metres from the anchor, angles in radians."""
        _text(lat, "latitude attribute"), _text(lon, "longitude attribute")
        for value in (at_lat, at_lon):
            if isinstance(value, bool) or not isinstance(value, Real):
                raise TypeError("the anchor must be given as numbers")
        return replace(self, anchor=(lat, lon, float(at_lat), float(at_lon)))

    def override(self, attr: str, kind: str, values: Mapping) -> Search:
        """Replace an attribute on some ids for this query; the last call per attribute counts."""
        _text(attr, "attribute")
        kind = _text(kind, "type").lower()
        check_values(kind, values)
        rest = tuple(x for x in self.overrides if x[0] != attr)
        return replace(self, overrides=(*rest, (attr, kind, dict(values))))

    def override_frame(self, attr: str, values: DataFrame) -> Search:
        """As :meth:`override`, with (id, attribute) rows of any number."""
        rest = tuple(x for x in self.overrides if x[0] != _text(attr, "attribute"))
        return replace(self, overrides=(*rest, (attr, "frame", values)))

    def reset_overrides(self) -> Search:
        return replace(self, overrides=())

    def select(self, *columns: str) -> Search:
        """Attributes, ``*`` and expressions; each expression ends in ``AS name``."""
        if not columns:
            raise ValueError("select needs at least one column")
        for c in columns:
            if not (_NAME.match(_text(c, "column")) or _ALIASED.search(c)):
                raise ValueError(f"expression needs an alias: {c}")
        return replace(self, selected=tuple(columns))

    # -- order and limits ----------------------------------------------------------

    def sort_by(self, mode: str, by=None, now=None) -> Search:
        mode = _choice(mode, o.SORT_MODES, "sort mode")
        if mode != "relevance" and not by:
            raise ValueError(f"sort mode {mode} needs what to sort by")
        if mode == "time_segments" and now is None:
            raise ValueError("time segments need the moment they are counted from")
        return replace(self, sort=(mode, by, now))

    def limits(self, offset: int, limit: int, max_matches: int | None = None, cutoff: int | None = None) -> Search:
        """Page of the result. None or 0 leaves max_matches and cutoff as they are."""
        return replace(
            self,
            offset=_count(offset, "offset", 0),
            limit=_count(limit, "limit", 1),
            max_matches=_count(max_matches or 0, "max_matches", 0) or self.max_matches,
            cutoff=_count(cutoff or 0, "cutoff", 0) or self.cutoff,
        )

    def outer_select(self, order_by, offset: int, limit: int) -> Search:
        """Sort the kept matches again and page that."""
        if not order_by:
            raise ValueError("outer select needs a sort clause")
        return replace(
            self, outer=(order_by, _count(offset, "offset", 0), _count(limit, "limit", 1))
        )

    def reset_outer_select(self) -> Search:
        return replace(self, outer=None)

    # -- grouping ----------------------------------------------------------------

    def group_by(self, attr: str, func: str = "attr", sort=DEFAULT_GROUP_SORT) -> Search:
        func = _choice(func, grp.GROUP_FUNCTIONS, "group function")
        if not sort:
            raise ValueError("group sort must not be empty")
        return replace(self, group=(_text(attr, "attribute"), func, sort))

    def group_distinct(self, attr: str, error: float | None = None) -> Search:
        """Count distinct values per group; with ``error``, approximately."""
        return replace(self, distinct=_text(attr, "attribute"), distinct_error=error)

    def group_select(self, **aggregates: Column) -> Search:
        """Extra aggregates per group, by name."""
        return replace(self, group_columns=dict(aggregates))

    def reset_group_by(self) -> Search:
        return replace(self, group=None, distinct=None, distinct_error=None, group_columns={})

    # -- frames ------------------------------------------------------------------

    @property
    def id(self) -> str:
        return self.collections[0].id

    def _tree(self, c: Collection) -> m.Condition | None:
        if self.tree is not None:
            tree = self.tree.without(c.stopwords)
            return tree if tree is not None and m.positive_only(tree) else None
        return None if self.mode == "fullscan" else m.from_text(self.text, self.mode, c.stopwords)

    def _overlaid(self, c: Collection) -> Collection:
        """The collection with this query's overrides on top."""
        frames = []
        for attr, kind, values in self.overrides:
            if attr not in c.attrs:
                raise ValueError(f"no such attribute: {attr}")
            if kind == "frame":
                values = one_per_id(values, c.id)
            else:
                values = override_frame(c.df.sparkSession, c.id, attr, kind, values)
            frames.append(values)
        return replace(c, overlays=(*c.overlays, *frames)) if frames else c

    def _filter(self, df: DataFrame, attrs) -> DataFrame:
        for attr, make in self.filters:
            test = make(df.schema) if attr in attrs else None
            df = df if test is None else df.filter(test)
        return df

    def _narrow(self, c: Collection, df: DataFrame, tree: m.Condition | None) -> DataFrame:
        """Everything that can be decided before tokenizing: filters that reach the
        scan, and for words whether the raw text contains them at all."""
        df = self._filter(df, {c.id, *c.settled_attrs})
        ids = flt.id_range(c.id, *self.ids)
        df = df if ids is None else df.filter(ids)
        texts = c.raw_texts()
        hint = tree.may_hold(c, texts) if tree is not None and texts else None
        return df if hint is None else df.filter(hint)

    def _ranking(self, c: Collection, tree: m.Condition) -> Ranking:
        weights = {**positional_weights(c.fields, self.positional), **self.weights}
        return Ranking(c, tree, weights, self.idf_flavour)

    def hit_rows(self, c: Collection) -> tuple[DataFrame, m.Condition | None]:
        """Matching documents of one collection with their hits, not yet weighted."""
        c = self._overlaid(c)
        tree = self._tree(c)
        if tree is None:
            df = self._narrow(c, c.rows(), None).drop(*c.fields)
            # Without a word to look for nothing matches, unless the query is a full
            # scan or has no text at all.
            if self.tree is not None or (self.mode != "fullscan" and self.text.strip()):
                df = df.filter(F.lit(False))
        else:
            df = c.hit_rows(m.any_word_test(tree, c), lambda rows: self._narrow(c, rows, tree))
            df = df.filter(tree.holds(c, c.field_hits()))
        df = self._filter(c.finish(df), set(c.attrs) - set(c.settled_attrs))
        if self.cutoff:
            # Only ids go to one task; the kept matches are ranked where they are.
            first = df.select(c.id).orderBy(c.id).limit(self.cutoff)
            df = df.filter(F.col(c.id) <= first.agg(F.max(c.id)).scalar())
        return df, tree

    def _found_in(self, c: Collection) -> DataFrame:
        df, tree = self.hit_rows(c)
        ranker = MODE_RANKERS.get(self.mode) or self.ranker or "proximity_bm25"
        if tree is None:
            df = df.withColumn("weight", F.lit(1).cast("long"))
        else:
            df = self._ranking(c, tree).weighted(df, ranker, self.rank_expr)
        return df.select(F.col(c.id).alias(self.id), "weight", *self.common_attrs)

    @property
    def common_attrs(self) -> list[str]:
        """Attributes that every collection of the search has."""
        first, *rest = self.collections
        return [a for a in first.attrs if all(a in c.attrs for c in rest)]

    def factors(self) -> DataFrame:
        """Ranking factors per (document, field) of the matches in every collection."""
        parts = []
        for c in self.collections:
            df, tree = self.hit_rows(c)
            if tree is None:
                raise ValueError("a full scan has no ranking factors")
            parts.append(self._ranking(c, tree).factors(df).withColumnRenamed(c.id, self.id))
        return reduce(DataFrame.unionByName, parts)

    def found(self) -> DataFrame:
        """All matches: id, weight, attributes, computed columns. Not sorted or cut."""
        parts = [self._found_in(c) for c in self.collections]
        df = parts[0]
        if len(parts) > 1:
            names = [c.name for c in self.collections]
            df = merge_collections(parts, self.id, names, self.collection_weights)
        elif self.collection_weights:
            name = self.collections[0].name
            df = df.withColumn("weight", F.col("weight") * self.collection_weights.get(name, 1))
        computed = {}
        if self.anchor:
            lat, lon, lat0, lon0 = self.anchor
            computed["geodist"] = haversine(F.col(lat), F.col(lon), lat0, lon0)
        if computed:
            df = self._with(df, computed)
        exprs = self._selected_expressions(aggregates=False)
        if exprs:
            df = self._with(df, exprs)
        for make in self.computed_filters:
            test = make(df.schema)
            df = df if test is None else df.filter(test)
        return df

    def _with(self, df: DataFrame, columns: dict[str, Column]) -> DataFrame:
        return compute_once(df, columns) if self.computed_filters else df.withColumns(columns)

    def _selected_expressions(self, aggregates: bool) -> dict[str, Column]:
        """The selected expressions by name; with groups, those of AVG, MIN, MAX, SUM or COUNT
        are aggregates over the matches of a group, all others belong to a match."""
        every = [(a.group(1), _ALIASED.sub("", c)) for c in self.selected if (a := _ALIASED.search(c))]
        grouped = self.group is not None
        kept = [(n, e) for n, e in every if (grouped and bool(_AGGREGATE.match(e))) == aggregates]
        return {n: F.expr(self._plain(e)) for n, e in kept}

    def _plain(self, expr: str) -> str:
        names = {**o.MAGIC_COLUMNS, "@id": self.id}
        return re.sub(r"@\w+", lambda x: names.get(x.group(0), x.group(0)), expr)

    def _sorted(self, df: DataFrame) -> tuple[DataFrame, list[o.OrderKey]]:
        mode, by, now = (*self.sort, None, None)[:3]
        if mode == "relevance":
            keys = [("weight", False)]
        elif mode in ("attr_desc", "attr_asc"):
            keys = [({**o.MAGIC_COLUMNS, "@id": self.id}.get(by, by), mode == "attr_asc"), ("weight", False)]
        elif mode == "time_segments":
            df = df.withColumn("time_segment", time_segment(F.col(by), F.lit(now)))
            keys = [("time_segment", False), ("weight", False), (by, False)]
        elif mode == "extended":
            keys = o.order_keys(by, self.id)
        else:
            df = df.withColumn("sort_expr", F.expr(self._plain(by)))
            keys = [("sort_expr", False)]
        return df, o.with_tie_break(keys, self.id)

    def groups(self, found: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """All groups with their best match. Not sorted or cut. ``columns`` names what to
        take of the best match; without it, everything."""
        df, keys = self._sorted(self.found() if found is None else found)
        attr, func, _ = self.group
        df = grp.with_group_key(df, attr, func, self.collections[0].attrs)
        aggregates = {**self._selected_expressions(aggregates=True), **self.group_columns}
        return grp.best_per_group(df, keys, self.distinct, aggregates, self.distinct_error, columns)

    def _group_columns(self) -> list[str] | None:
        """What a page of groups takes of each best match: what is selected or sorted on; None for everything."""
        if "*" in [c.strip() for c in self.selected]:
            return None
        aggregates = {*self._selected_expressions(aggregates=True), *self.group_columns}
        made = {"group_key", "group_count", "group_distinct", *aggregates}
        order = [name for clause in (self.group[2], self.outer and self.outer[0]) if clause for name, _ in o.order_keys(clause, self.id)]
        named = [a.group(1) if (a := _ALIASED.search(c)) else self._plain(c.strip()) for c in self.selected]
        extra = [x for x, there in (("geodist", self.anchor), ("sort_expr", self.sort[0] == "expr"), ("time_segment", self.sort[0] == "time_segments")) if there]
        return [c for c in dict.fromkeys([self.id, "weight", *named, *order, *extra]) if c not in made]

    def _visible(self, df: DataFrame) -> DataFrame:
        if "*" in [c.strip() for c in self.selected]:
            return df
        extra = [c for c in ("geodist", "sort_expr", "time_segment", "group_key", "group_count", "group_distinct", *self.group_columns) if c in df.columns]
        wanted = []
        for c in self.selected:
            alias = _ALIASED.search(c)
            wanted.append(alias.group(1) if alias else self._plain(c.strip()))
        return df.select(*dict.fromkeys([self.id, "weight", *wanted, *extra]))

    def listed(self) -> DataFrame:
        """All matches with the selected columns only. Not sorted or cut."""
        return self._visible(self.found())

    def matches(self, found: DataFrame | None = None) -> DataFrame:
        """The page of matches, or of groups, in order.

        ``found`` is a stored result of :meth:`found`, to page it again without
        matching and ranking again.
        """
        if self.group is not None:
            df = self.groups(found, self._group_columns())
            keys = o.with_tie_break(o.order_keys(self.group[2], self.id), "group_key")
        else:
            df, keys = self._sorted(self.found() if found is None else found)
        df = self._visible(df) if self.outer is None else df
        if self.outer is None:
            return o.page(df, keys, self.max_matches, self.offset, self.limit)
        order_by, offset, limit = self.outer
        kept = df.orderBy(*o.sort_columns(keys)).limit(self.max_matches)
        last = "group_key" if self.group is not None else self.id
        again = o.with_tie_break(o.order_keys(order_by, self.id), last)
        return o.page(self._visible(kept), again, self.max_matches, offset, limit)

    def totals(self, found: DataFrame | None = None) -> DataFrame:
        """One row: total, total_found. They count groups when there are any."""
        if self.group is not None:
            return o.totals(self.groups(found, ()), self.max_matches)
        return o.totals(self.found() if found is None else found, self.max_matches)

    def words(self) -> DataFrame | None:
        """(word, docs, hits) of the query's words over all collections searched."""
        parts = []
        for c in self.collections:
            tree = self._tree(c)
            if tree is None:
                return None
            found = [w for part in tree.parts() for _, w in part.words()]
            words = [Word(w.text.lower(), exact=w.exact) for w in found]
            parts.append(word_stats(c, [w for w in words if w.exact or w.text not in c.stopwords]))
        if len(parts) == 1:
            return parts[0]
        every = reduce(DataFrame.unionByName, parts)
        return every.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))

    def result(self) -> Result:
        c = self.collections[0]
        return Result(self.matches(), self.totals(), self.words(), c.fields, c.attrs)
