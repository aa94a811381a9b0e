"""Attribute filters. All are plain Columns, so they reach the Parquet scan.

Multi-valued attributes pass when any element passes. An excluding filter is the
negation and lets NULL attributes through.
"""

from __future__ import annotations

from collections.abc import Sequence
from numbers import Integral, Real

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _integer(value, what: str) -> int:
    if isinstance(value, bool) or not isinstance(value, Integral):
        raise TypeError(f"{what} must be an integer")
    return int(value)


def _number(value, what: str) -> float:
    if isinstance(value, bool) or not isinstance(value, Real):
        raise TypeError(f"{what} must be a number")
    return float(value)


def _bounds(low, high):
    if low > high:
        raise ValueError("the lower bound must not exceed the upper bound")


def _signed(condition: Column, exclude: bool) -> Column:
    if not isinstance(exclude, bool):
        raise TypeError("exclude must be a boolean")
    return ~F.coalesce(condition, F.lit(False)) if exclude else condition


def _typed(value: int, kind: T.DataType | None) -> Column:
    """An integer as a literal of the attribute's type, so that the filter reaches the
    scan: seconds of the epoch for a timestamp, 0 and 1 for a boolean."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.lit(value))
    if isinstance(kind, T.BooleanType):
        return F.lit(bool(value)) if value in (0, 1) else F.lit(None).cast("boolean")
    return F.lit(value)


def kind_of(schema: T.StructType, attr: str) -> T.DataType:
    return schema[attr].dataType


def is_multi(schema: T.StructType, attr: str) -> bool:
    return isinstance(schema[attr].dataType, T.ArrayType)


def values(attr: str, given: int | Sequence[int], multi: bool, exclude: bool = False, kind: T.DataType | None = None) -> Column | None:
    """Attribute in a set of integers; an empty set filters nothing."""
    if isinstance(given, Integral) and not isinstance(given, bool):
        given = [given]
    if isinstance(given, (str, bytes)) or not isinstance(given, Sequence):
        raise TypeError("values must be an integer or a sequence of integers")
    wanted = [_integer(v, "each value") for v in given]
    if not wanted:
        return None
    col = F.col(attr)
    if multi:
        test = F.arrays_overlap(col.cast("array<bigint>"), F.array(*[F.lit(v).cast("long") for v in wanted]))
    else:
        test = col.isin([_typed(v, kind) for v in wanted] if isinstance(kind, (T.TimestampType, T.BooleanType)) else wanted)
    return _signed(test, exclude)


def int_range(
    attr: str, low: int, high: int, multi: bool, exclude: bool = False, kind: T.DataType | None = None
) -> Column:
    """low <= attribute <= high for signed 64-bit integers."""
    low, high = _integer(low, "min"), _integer(high, "max")
    _bounds(low, high)
    col = F.col(attr)
    if multi:
        test = F.exists(col, lambda v: v.between(low, high))
    elif isinstance(kind, T.TimestampType):
        test = col.between(_typed(low, kind), _typed(high, kind))
    else:
        col = col.cast("int") if isinstance(kind, T.BooleanType) else col
        test = col.between(low, high)
    return _signed(test, exclude)


def float_range(attr: str, low: float, high: float, multi: bool = False, exclude: bool = False) -> Column:
    """low <= attribute <= high for doubles."""
    low, high = _number(low, "min"), _number(high, "max")
    _bounds(low, high)
    col = F.col(attr)
    test = F.exists(col, lambda v: v.between(low, high)) if multi else col.between(low, high)
    return _signed(test, exclude)


def id_range(id: str, low: int, high: int) -> Column | None:
    """low <= id <= high; 0 and 0 mean no limit."""
    low, high = _integer(low, "min"), _integer(high, "max")
    _bounds(low, high)
    return None if low == 0 and high == 0 else F.col(id).between(low, high)
