"""Named queries over the test tables, each with its SQL twin beside it."""

from . import attributes, excerpts, grouping, matching, merging, ordering, ranking, sources, texts, updating
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "attributes",
    "excerpts",
    "grouping",
    "matching",
    "merging",
    "ordering",
    "ranking",
    "sources",
    "texts",
    "updating",
]
