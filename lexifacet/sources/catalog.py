"""Collections by name, and keeping a result's order when fetching source rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .collection import Collection


class Catalog:
    """Named collections; ``pick("main delta")`` gives them in the order asked for."""

    def __init__(self, *collections: Collection):
        self._by_name = {c.name: c for c in collections}

    def pick(self, names: str = "*") -> list[Collection]:
        """Collections named in a text, separated by spaces, commas or semicolons;
        ``*`` means all."""
        wanted = [n for n in re.split(r"[\s,;]+", names) if n]
        if not wanted:
            raise ValueError("no collection named")
        if wanted == ["*"]:
            return list(self._by_name.values())
        unknown = [n for n in wanted if n not in self._by_name]
        if unknown:
            raise ValueError(f"unknown collection {', '.join(unknown)}")
        return [self._by_name[n] for n in wanted]


def hydrate(page: DataFrame, source: DataFrame, id: str, order: list) -> DataFrame:
    """Source rows of a result page, in the page's order.

    The page is bounded by its own limit; the source is read once, for its own
    columns only, and the same order is applied again after the join.
    """
    extra = [c for c in source.columns if c == id or c not in page.columns]
    return page.join(source.select(*extra), id).orderBy(*order)
