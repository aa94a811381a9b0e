"""Tokenizing, escaping and markup stripping as plain Column expressions."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a token is, how a text splits into word and gap pieces,
# which characters a query text must escape, and what markup is.
TOKEN = r"([\p{L}\p{N}_]+)"
PIECE = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"
QUERY_SPECIALS = r'([\\()|\-!@~"&/^$=])'
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"


def as_column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col) -> Column:
    """Case-folded words of a text; a NULL text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(as_column(col), F.lit(""))), F.lit(TOKEN))


def split_pieces(col) -> Column:
    """Alternating words and gaps whose concatenation is the text."""
    return F.regexp_extract_all(F.coalesce(as_column(col), F.lit("")), F.lit(PIECE))


def escape_query(col) -> Column:
    """Put a backslash before every character with a meaning in query texts."""
    return F.regexp_replace(as_column(col), QUERY_SPECIALS, r"\\$1")


def strip_markup(col) -> Column:
    """Replace scripts, styles, comments and tags by one space each."""
    return F.regexp_replace(as_column(col), MARKUP, " ")


def query_words(text: str) -> list[str]:
    """Words of a short query text; ``*`` stays, as the wildcard."""
    found = regex.findall(r"[\p{L}\p{N}_*]+", text.lower())
    return [w for w in found if w.strip("*")]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a lambda over Columns)."""
    return F.element_at(F.transform(F.array(value), body), 1)
