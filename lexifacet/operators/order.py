"""Sort clauses, pages and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of computed result columns as users write them in clauses.
MAGIC_COLUMNS = {
    "@weight": "weight",
    "@relevance": "weight",
    "@rank": "weight",
    "@group": "group_key",
    "@count": "group_count",
    "@distinct": "group_distinct",
    "@geodist": "geodist",
    "@expr": "sort_expr",
}

SORT_MODES = ("relevance", "attr_desc", "attr_asc", "time_segments", "extended", "expr")

OrderKey = tuple[str, bool]  # (column name, ascending)


def order_keys(clause, id: str) -> list[OrderKey]:
    """Keys of a clause: ``"@weight DESC, price ASC"`` or a list of
    ``"price desc"`` / ``("price", "desc")``."""
    items = clause.split(",") if isinstance(clause, str) else clause
    names: Mapping[str, str] = {**MAGIC_COLUMNS, "@id": id}
    out = []
    for item in items:
        parts = item.split() if isinstance(item, str) else list(item)
        if not 1 <= len(parts) <= 2:
            raise ValueError(f"not a sort key: {item!r}")
        direction = parts[1].lower() if len(parts) == 2 else "asc"
        if direction not in ("asc", "desc"):
            raise ValueError(f"not a sort direction: {parts[1]!r}")
        out.append((names.get(parts[0], parts[0]), direction == "asc"))
    if not out:
        raise ValueError("empty sort clause")
    return out


def with_tie_break(keys: Sequence[OrderKey], *last: str) -> list[OrderKey]:
    """Append ascending columns that are not sorted on yet, so no order is left open."""
    out = list(keys)
    for name in last:
        if name not in [k for k, _ in out]:
            out.append((name, True))
    return out


def sort_columns(keys: Sequence[OrderKey]) -> list[Column]:
    return [F.col(name).asc() if asc else F.col(name).desc() for name, asc in keys]


def best_first(schema: T.StructType, keys: Sequence[OrderKey]) -> Column | None:
    """A struct whose smallest value marks the first row of the given order.

    Descending numbers, times and booleans are mirrored. Text cannot be mirrored,
    so an order with a descending text key has no such struct (None).
    """
    parts = []
    for name, asc in keys:
        col, kind = F.col(name), schema[name].dataType
        if asc:
            parts.append(col)
            continue
        if isinstance(kind, T.StringType):
            return None
        if isinstance(kind, T.TimestampNTZType):
            col = F.unix_micros(col.cast("timestamp"))
        elif isinstance(kind, T.TimestampType):
            col = F.unix_micros(col)
        elif isinstance(kind, T.DateType):
            col = F.unix_date(col)
        elif isinstance(kind, T.BooleanType):
            col = col.cast("int")
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            mirrored = -col
        else:
            mirrored = F.bitwise_not(col)
        parts.append(F.isnull(F.col(name)))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            parts.append(~F.isnan(F.coalesce(F.col(name), F.lit(0.0))))
        parts.append(mirrored)
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def page(df: DataFrame, keys: Sequence[OrderKey], max_matches: int, offset: int, limit: int) -> DataFrame:
    """The best ``max_matches`` rows, then one page of them."""
    top = df.orderBy(*sort_columns(keys)).limit(min(max_matches, offset + limit))
    return top.offset(offset).limit(limit) if offset else top


def totals(df: DataFrame, max_matches: int) -> DataFrame:
    """total (what a user can page through) and total_found (all matches)."""
    found = F.count(F.lit(1))
    return df.agg(F.least(found, F.lit(max_matches).cast("long")).alias("total"), found.alias("total_found"))
