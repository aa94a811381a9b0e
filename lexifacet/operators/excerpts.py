"""Excerpts: highlighted passages of every document of a table.

A document's excerpt is one Column expression over its own text, so a job over
any number of documents is a single stage without an exchange.
"""

from __future__ import annotations

from dataclasses import dataclass
from numbers import Integral

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hits as H
from ..functions import text as T
from ..sources.collection import FieldHits, Lexicon
from .match import Condition, Or, Phrase, Word, all_of, any_of, any_word_test, distinct_words, word_sequence

SENTENCE = r"([^.!?]+[.!?]*|[.!?]+)"
STRIP_MODES = ("none", "strip")
BOUNDARIES = ("none", "sentence")


@dataclass(frozen=True)
class ExcerptOptions:
    """Option names and defaults. 0 switches a limit off."""

    before_match: str = "<b>"
    after_match: str = "</b>"
    chunk_separator: str = " ... "
    limit: int = 256
    limit_passages: int = 0
    limit_words: int = 0
    around: int = 5
    exact_phrase: bool = False
    single_passage: bool = False
    use_boundaries: bool = False
    weight_order: bool = False
    query_mode: bool = False
    force_all_words: bool = False
    start_passage_id: int = 1
    html_strip_mode: str = "none"
    allow_empty: bool = False
    passage_boundary: str = "none"

    def __post_init__(self):
        for name in ("before_match", "after_match", "chunk_separator"):
            if not isinstance(getattr(self, name), str):
                raise TypeError(f"{name} must be a string")
        for name in ("limit", "limit_passages", "limit_words", "around", "start_passage_id"):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, Integral):
                raise TypeError(f"{name} must be an integer")
            if value < 0:
                raise ValueError(f"{name} must not be negative")
        if self.html_strip_mode not in STRIP_MODES:
            raise ValueError(f"html_strip_mode must be one of {STRIP_MODES}")
        if self.passage_boundary not in BOUNDARIES:
            raise ValueError(f"passage_boundary must be one of {BOUNDARIES}")


def _anchored(leaf: Condition) -> bool:
    return isinstance(leaf, Word) and (leaf.first or leaf.last)


class _Marker:
    """Which tokens of a text are hits, for one set of words."""

    def __init__(self, words: str | Condition, lexicon, options: ExcerptOptions):
        self.lexicon = lexicon
        if isinstance(words, Condition):
            if not options.query_mode:
                raise ValueError("a condition needs query_mode")
            self.tree, self.leaves = words, words.leaves()
        elif isinstance(words, str):
            found = [w for w in T.query_words(words) if w not in lexicon.stopwords]
            if not found:
                raise ValueError("no words to highlight")
            self.leaves = [Phrase(words)] if options.exact_phrase else [Word(w) for w in found]
            self.tree = Or(*self.leaves)
        else:
            raise TypeError("words must be a text or, in query mode, a condition")
        self.query_mode = options.query_mode
        sequence = word_sequence(self.tree, lexicon)
        self.tests = [w.test(lexicon) for w in distinct_words(sequence)]

    def at(self, tokens: Column, i: Column) -> Column:
        """True when token ``i`` is a hit."""
        return self._hit(tokens, F.get(tokens, i), i)

    def _hit(self, tokens: Column, word: Column, i: Column) -> Column:
        plain = [leaf for leaf in self.leaves if not isinstance(leaf, Phrase) and not _anchored(leaf)]
        rest = [leaf for leaf in self.leaves if leaf not in plain]
        tests = [any_word_test(Or(*plain), self.lexicon)(word)] if plain else []
        return any_of(tests + [self._leaf_at(leaf, tokens, word, i) for leaf in rest])

    def _leaf_at(self, leaf, tokens: Column, word: Column, i: Column) -> Column:
        if isinstance(leaf, Phrase):
            query = [(at, w.test(self.lexicon)) for at, w in leaf.kept(self.lexicon)]
            places = [
                all_of(
                    [F.coalesce(test(F.get(tokens, i + (at - own))), F.lit(False)) for at, test in query]
                )
                for own, _ in query
            ]
            return any_of(places)
        checks = [H.any_test(w.test(self.lexicon) for _, w in leaf.words())(word)]
        if isinstance(leaf, Word) and leaf.first:
            checks.append(i == 0)
        if isinstance(leaf, Word) and leaf.last:
            checks.append(i == F.size(tokens) - 1)
        return all_of(checks)

    def flags(self, tokens: Column) -> Column:
        """Per token whether it is a hit."""
        return F.transform(tokens, lambda w, i: F.coalesce(self._hit(tokens, w, i), F.lit(False)))

    def applies(self, text: Column) -> Column:
        """In query mode only texts that satisfy the condition get passages."""
        if not self.query_mode:
            return F.lit(True)
        wanted = [w.test(self.lexicon) for part in self.tree.parts() for _, w in part.words()]

        def holds(tokens: Column) -> Column:
            found = H.hits(tokens, H.any_test(wanted))
            return self.tree.holds(self.lexicon, [FieldHits("text", found, F.size(tokens))])

        return T.let(T.tokenize(text), holds)


def _cut(text: Column) -> Column:
    """struct(ps: pieces, off: piece index of the first token)."""
    starts_with_word = F.coalesce(F.substring(text, 1, 1).rlike(T.TOKEN), F.lit(False))
    return F.struct(
        T.split_pieces(text).alias("ps"), F.when(starts_with_word, 0).otherwise(1).alias("off")
    )


def _with_tokens(text: Column, body) -> Column:
    """Call ``body(pieces, off, tokens)`` with each of them evaluated once."""

    def tokens_of(cut: Column) -> Column:
        ps, off = cut["ps"], cut["off"]
        words = F.transform(
            F.filter(ps, lambda _, k: k % 2 == off), lambda p: F.lower(p)
        )
        return T.let(
            F.struct(ps.alias("ps"), off.alias("off"), words.alias("ws")),
            lambda c: body(c["ps"], c["off"], c["ws"]),
        )

    return T.let(_cut(text), tokens_of)


def highlight(text, words: str | Condition, lexicon=None, options: ExcerptOptions | None = None) -> Column:
    """The whole text with every hit marked."""
    options = options or ExcerptOptions()
    marker = _Marker(words, lexicon or Lexicon(), options)
    text = F.coalesce(T.as_column(text), F.lit(""))
    marked = _highlighted(text, marker, options)
    return F.when(marker.applies(text), marked).otherwise(text) if options.query_mode else marked


def _highlighted(text: Column, marker: _Marker, o: ExcerptOptions) -> Column:
    def mark(ps, off, ws):
        def one(p: Column, k: Column) -> Column:
            hit = (k % 2 == off) & marker.at(ws, F.floor((k - off) / 2).cast("int"))
            return F.when(hit, F.concat(F.lit(o.before_match), p, F.lit(o.after_match))).otherwise(p)

        return F.array_join(F.transform(ps, one), "")

    return _with_tokens(text, mark)


def _passages_of(text: Column, segment: Column, marker: _Marker, o: ExcerptOptions) -> Column:
    """Passages of one segment: hits closer than two contexts share a passage. One that is longer than the
    limits gives way to its best window that is not. Work grows with the text, times the limit at most."""

    def passages(ps, off, ws):
        def pieces(s: Column, count: Column) -> Column:
            return F.slice(ps, off + 2 * s + 1, count)

        def from_hits(flags: Column, hs: Column) -> Column:
            gap = 2 * o.around + 1
            starts = F.filter(
                F.transform(
                    hs, lambda h, k: F.when((k == 0) | (h - F.get(hs, k - 1) > gap), k)
                ),
                lambda k: k.isNotNull(),
            )
            spans = T.let(starts, lambda at: F.transform(at, lambda a, j: span(flags, hs, at, a, j)))
            kept = F.filter(spans, lambda x: x.isNotNull()) if o.limit or o.limit_words else spans
            return F.transform(kept, lambda x: describe(flags, x))

        def span(flags, hs, at, a, j):
            b = F.coalesce(F.get(at, j + 1), F.size(hs)) - 1
            s = F.greatest(F.get(hs, a) - o.around, F.lit(0))
            e = F.least(F.get(hs, b) + o.around, F.size(ws) - 1)
            whole = F.struct(s.alias("s"), e.alias("e"))
            if not (o.limit or o.limit_words):
                return whole
            fits = []
            if o.limit:
                fits.append(F.length(F.array_join(pieces(s, 2 * (e - s) + 1), "")) <= o.limit)
            if o.limit_words:
                fits.append(e - s + 1 <= o.limit_words)
            best = T.let(F.slice(hs, a + 1, b - a + 1), lambda own: best_window(flags, own))
            return F.when(all_of(fits), whole).otherwise(best)

        #: Pieces that can be within the limits: each has a character at least.
        most = min([x for x in (o.limit, 2 * o.limit_words) if x], default=0)

        def best_window(flags, own):
            """The window of most distinct words, then of most hits, then the first; NULL if none fits."""
            windows = F.transform(own, lambda h, i: T.let(window(own, h, i), lambda x: scored(flags, x)))
            best = F.array_min(F.array_compact(windows))
            return F.when(best.isNotNull(), F.struct(best["s"].alias("s"), best["e"].alias("e")))

        def window(own, h, i):
            """From hit ``i`` with its context as far as it goes, or the word alone."""
            s = F.greatest(h - o.around, F.lit(0))
            start = F.struct(F.lit(0).alias("len"), F.lit(0).alias("k"), (s - 1).alias("t"))

            def step(acc: Column, piece: Column) -> Column:
                length, k = acc["len"] + F.length(piece), acc["k"]
                fits = [k % 2 == 0]
                if o.limit:
                    fits.append(length <= o.limit)
                if o.limit_words:
                    fits.append(k < 2 * o.limit_words)
                t = F.when(all_of(fits), s + F.floor(k / 2).cast("int")).otherwise(acc["t"])
                return F.struct(length.alias("len"), (k + 1).alias("k"), t.alias("t"))

            reach = F.aggregate(pieces(s, F.lit(most)), start, step, lambda acc: acc["t"])

            def widest(t: Column) -> Column:
                near = F.filter(F.slice(own, i + 1, most), lambda x: F.least(x + o.around, F.size(ws) - 1) <= t)
                end = F.least(F.element_at(near, -1) + o.around, F.size(ws) - 1)
                alone = F.length(F.get(ps, off + 2 * h)) <= o.limit if o.limit else F.lit(True)
                wide = F.when(F.size(near) > 0, F.struct(s.alias("s"), end.alias("e")))
                return F.coalesce(wide, F.when(alone, F.struct(h.alias("s"), h.alias("e"))))

            return T.let(reach, widest)

        def scored(flags, x):
            cover = [F.exists(hit_words(flags, x), test) for test in marker.tests]
            nd = sum([c.cast("int") for c in cover], F.lit(0))
            score = F.struct((-nd).alias("nd"), (-F.size(hit_words(flags, x))).alias("nh"), x["s"].alias("s"), x["e"].alias("e"))
            return F.when(x.isNotNull(), score)

        def hit_words(flags, x):
            words = F.slice(ws, x["s"] + 1, x["e"] - x["s"] + 1)
            return F.array_compact(F.transform(words, lambda w, k: F.when(F.get(flags, x["s"] + k), w)))

        def describe(flags, x: Column) -> Column:
            s, e = x["s"], x["e"]
            parts = F.struct(hit_words(flags, x).alias("own"), pieces(s, 2 * (e - s) + 1).alias("raw"))

            def with_parts(y: Column) -> Column:
                cover = F.array(*[F.exists(y["own"], test) for test in marker.tests])
                return F.struct(
                    (-F.size(F.filter(cover, lambda c: c))).alias("nd"),
                    (-F.size(y["own"])).alias("nh"),
                    segment.alias("seg"),
                    s.alias("s"),
                    F.length(F.array_join(y["raw"], "")).alias("len"),
                    (e - s + 1).alias("words"),
                    cover.alias("cover"),
                    y["raw"].alias("raw"),
                    F.slice(flags, s + 1, e - s + 1).alias("flags"),
                )

            return T.let(parts, with_parts)

        def flagged(flags: Column) -> Column:
            hs = F.filter(F.transform(flags, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
            return T.let(hs, lambda x: from_hits(flags, x))

        return T.let(marker.flags(ws), flagged)

    return _with_tokens(text, passages)


def _marked(p: Column, o: ExcerptOptions) -> Column:
    """The text of a passage with its hits marked."""

    def mark(piece: Column, k: Column) -> Column:
        hit = (k % 2 == 0) & F.get(p["flags"], F.floor(k / 2).cast("int"))
        return F.when(hit, F.concat(F.lit(o.before_match), piece, F.lit(o.after_match))).otherwise(piece)

    return F.array_join(F.transform(p["raw"], mark), "")


def _kept(best_first: Column, marker: _Marker, o: ExcerptOptions) -> Column:
    """The passages that fit together with what separates them, best first."""
    zero = F.struct(F.lit(0).alias("len"), F.lit(0).alias("words"), F.lit(0).alias("n"), F.lit(0).alias("r"))

    def step(acc: Column, p: Column) -> Column:
        between = F.when(acc["n"] > 0, len(o.chunk_separator)).otherwise(0)
        length, words, n = acc["len"] + between + p["len"], acc["words"] + p["words"], acc["n"] + 1
        fits = F.lit(True)
        if o.limit:
            fits = fits & (length <= o.limit)
        if o.limit_words:
            fits = fits & (words <= o.limit_words)
        if o.limit_passages:
            fits = fits & (n <= o.limit_passages)
        if o.single_passage:
            fits = fits & (n <= 1)
        r = F.when(fits, n).otherwise(acc["r"])
        return F.struct(length.alias("len"), words.alias("words"), n.alias("n"), r.alias("r"))

    fitting = F.aggregate(best_first, zero, step, lambda acc: acc["r"])
    if not o.force_all_words:
        return F.slice(best_first, F.lit(1), fitting)
    firsts = F.array(
        *[
            F.array_position(F.transform(best_first, lambda p: F.get(p["cover"], F.lit(k))), F.lit(True))
            for k in range(len(marker.tests))
        ]
    )
    return T.let(
        F.struct(fitting.alias("r"), firsts.alias("firsts")),
        lambda x: F.filter(
            best_first,
            lambda _, i: (i < x["r"]) | F.array_contains(x["firsts"], (i + 1).cast("long")),
        ),
    )


def _passage_texts(text: Column, marker: _Marker, o: ExcerptOptions) -> Column:
    """Marked passages in print order."""
    if o.use_boundaries or o.passage_boundary == "sentence":
        segments = F.regexp_extract_all(text, F.lit(SENTENCE))
    else:
        segments = F.array(text)
    every = F.flatten(F.transform(segments, lambda t, j: _passages_of(t, j, marker, o)))

    def choose(best_first: Column) -> Column:
        kept = _kept(best_first, marker, o)
        if o.weight_order:
            return F.transform(kept, lambda p: _marked(p, o))
        placed = F.transform(
            kept, lambda p: F.struct(p["seg"].alias("seg"), p["s"].alias("s"), p.alias("p"))
        )
        return F.transform(F.sort_array(placed), lambda x: _marked(x["p"], o))

    return T.let(F.sort_array(every), choose)


def _head(text: Column, limit: int) -> Column:
    """The first ``limit`` characters, cut at the end of a word."""
    if not limit:
        return text
    start = F.substring(text, 1, limit)
    splits_word = F.substring(text, limit, 2).rlike(r"^[\p{L}\p{N}_]{2}\z")
    whole_words = F.when(splits_word, F.regexp_replace(start, r"[\p{L}\p{N}_]+\z", "")).otherwise(start)
    cut = F.regexp_replace(whole_words, r"[^\p{L}\p{N}_]+\z", "")
    return F.when(F.length(text) <= limit, text).otherwise(cut)


def _prepared(text, options: ExcerptOptions) -> Column:
    text = F.coalesce(T.as_column(text), F.lit(""))
    return T.strip_markup(text) if options.html_strip_mode == "strip" else text


def excerpt(text, words: str | Condition, lexicon=None, options: ExcerptOptions | None = None) -> Column:
    """The excerpt of one text column."""
    o = options or ExcerptOptions()
    marker = _Marker(words, lexicon or Lexicon(), o)
    whole_if_fits = o.limit and not (o.limit_passages or o.limit_words or o.single_passage)

    def build(t: Column) -> Column:
        nothing = F.lit("") if o.allow_empty else _head(t, o.limit)

        def from_passages(ps: Column) -> Column:
            return F.when(F.size(ps) > 0, F.array_join(ps, o.chunk_separator)).otherwise(nothing)

        chosen = T.let(_passage_texts(t, marker, o), from_passages)
        if whole_if_fits:
            found = T.let(T.tokenize(t), lambda ws: F.exists(marker.flags(ws), lambda f: f))
            short = F.when(found, _highlighted(t, marker, o)).otherwise(nothing)
            chosen = F.when(F.length(t) <= o.limit, short).otherwise(chosen)
        return F.when(marker.applies(t), chosen).otherwise(nothing) if o.query_mode else chosen

    return T.let(_prepared(text, o), build)


def build_excerpts(
    docs: DataFrame, id: str, text: str, words: str | Condition, lexicon=None, **options
) -> DataFrame:
    """(id, snippet) for every row of ``docs``."""
    o = ExcerptOptions(**options)
    return docs.select(id, excerpt(text, words, lexicon, o).alias("snippet"))


def build_passages(
    docs: DataFrame, id: str, text: str, words: str | Condition, lexicon=None, **options
) -> DataFrame:
    """(id, passage_id, passage): the kept passages as rows, numbered in print order."""
    o = ExcerptOptions(**options)
    marker = _Marker(words, lexicon or Lexicon(), o)
    texts = T.let(_prepared(text, o), lambda t: _passage_texts(t, marker, o))
    rows = docs.select(id, F.posexplode(texts).alias("_at", "passage"))
    number = F.col("_at") + o.start_passage_id
    return rows.select(id, number.alias("passage_id"), "passage")
