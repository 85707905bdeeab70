"""Change predicates used to decide whether a new version of a row is needed.

Two NULL policies:

* ``"sentinel"`` -- NULL is replaced by a per-type default before comparing
  (``''`` for text, ``0`` for numbers, ``1900-01-01`` for dates), so NULL and
  the default are *not* a change.
* ``"null_safe"`` -- NULL equals only NULL (``<=>``).

An optional collation (e.g. ``"UTF8_LCASE_RTRIM"``) makes text comparisons
case- and trailing-space-insensitive.
"""

from __future__ import annotations

import datetime as _dt
import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL_TEXT = ""
SENTINEL_NUMBER = 0
SENTINEL_DATE = _dt.date(1900, 1, 1)
SENTINEL_TIMESTAMP = _dt.datetime(1900, 1, 1)


def sentinel_for(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit(SENTINEL_TEXT)
    if isinstance(dtype, T.DateType):
        return F.lit(SENTINEL_DATE)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(SENTINEL_TIMESTAMP).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(SENTINEL_NUMBER).cast(dtype)
    raise TypeError(f"no sentinel for {dtype.simpleString()}")


def differs(a: Column, b: Column, dtype: T.DataType, mode: str = "sentinel",
            collation: str | None = None) -> Column:
    """True when ``a`` and ``b`` count as different under ``mode``; never NULL."""
    if collation and isinstance(dtype, T.StringType):
        a, b = F.collate(a, collation), F.collate(b, collation)
    if mode == "sentinel":
        d = sentinel_for(dtype)
        if collation and isinstance(dtype, T.StringType):
            d = F.collate(d, collation)
        return F.coalesce(a, d) != F.coalesce(b, d)
    if mode == "null_safe":
        return ~a.eqNullSafe(b)
    raise ValueError(f"unknown compare mode {mode!r}")


def changed(pairs: Iterable[tuple[Column, Column, T.DataType]], mode: str = "sentinel",
            collation: str | None = None) -> Column:
    """OR of ``differs`` over ``(old, new, type)`` triples."""
    terms = [differs(a, b, t, mode, collation) for a, b, t in pairs]
    if not terms:
        return F.lit(False)
    return functools.reduce(operator.or_, terms)
