"""Row filters, de-duplication and per-key ordering operators.

Skew: any key may hold a large share of all rows.  ``latest_per_key`` relies
on Catalyst's ``WindowGroupLimit``, which keeps only the top row per key in
every map task *before* the shuffle, so a hot key sends at most one row per
map task.  The operators that must keep every row (``flag_latest``,
``derive_end_date``, ``flag_open``) order a key's rows in one task only up to
``hot_rows``.  Keys with more are laid out in order over all partitions, written once, and
a table with one row per partition (so safe to broadcast) stitches
the partitions together; rows alike in every column are spread as well.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.session import frozen
from histdim.sources.schemas import ACTIVE, INACTIVE

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _sort_cols(order) -> list[Column]:
    if order is None:
        return []
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(o).asc() if isinstance(o, str) else o for o in order]


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, _UNORDERABLE):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def total_order(df: DataFrame, keys, order) -> list[Column]:
    """``order`` followed by every other orderable column ascending, so that
    ties are broken the same way on every run (which of several exact
    duplicates wins does not matter)."""
    keys = _keys(keys)
    cols = _sort_cols(order)
    named = set(keys) | {o for o in (order if isinstance(order, (list, tuple)) else [order])
                         if isinstance(o, str)}
    tail = [F.col(f.name).asc() for f in df.schema.fields
            if f.name not in named and _orderable(f.dataType)]
    return cols + tail


# --- simple filters -------------------------------------------------------

def require_key(df: DataFrame, keys) -> DataFrame:
    """Drop rows whose business key (any part of it) is NULL."""
    cond = None
    for k in _keys(keys):
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def current_rows(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.filter(F.col(flag) == F.lit(ACTIVE))


def open_rows(df: DataFrame, end_col: str) -> DataFrame:
    """Rows whose validity has no end date."""
    return df.filter(F.col(end_col).isNull())


def exact_dedupe(df: DataFrame) -> DataFrame:
    """Remove full-row duplicates; NULLs compare equal.  Planned as a partial
    (map-side) plus final hash aggregate, so duplicated rows collapse before
    the shuffle."""
    return df.dropDuplicates()


# --- top-1 per key --------------------------------------------------------

def latest_per_key(df: DataFrame, keys, order, tie_break: bool = True) -> DataFrame:
    """Keep the first row per key under ``order`` (e.g. ``F.col("d").desc()``).

    With ``tie_break`` the remaining columns complete the order so that the
    kept row is deterministic.
    """
    keys = _keys(keys)
    ordering = total_order(df, keys, order) if tie_break else _sort_cols(order)
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


# --- ordered windows that keep every row ------------------------------------

#: Rows of one key that a task may order; a key with more is laid out over many.
HOT_ROWS = 1_000_000
_POS_BITS = 33


def ordered_layout(df: DataFrame, ordering: list[Column], num_partitions: int | None = None) -> DataFrame:
    """``df`` with its rows in order, written once to the shared scratch folder: ``__p`` is a
    row's partition and ``__pos`` its place there, and both ascend with ``ordering``.

    The rows are written with a number first, which ends the order: rows alike in every column
    are spread too, and a retried task deals them as before."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = frozen(df.withColumn("__n", F.monotonically_increasing_id()), "numbered")
    rid = F.col("__rid")
    placed = frozen(numbered.repartitionByRange(n, *ordering, "__n").sortWithinPartitions(*ordering, "__n")
                    .drop("__n").withColumn("__rid", F.monotonically_increasing_id()), "ordered")
    return placed.withColumns({"__p": F.shiftright(rid, _POS_BITS),
                               "__pos": rid.bitwiseAND(F.lit((1 << _POS_BITS) - 1))}).drop("__rid")


def _first_and_next(df: DataFrame, keys: list[str], ordering: list[Column], value: str | None) -> DataFrame:
    """The plain window: ``__first`` of its key and, if ``value`` is given, the ``__next`` row's."""
    w = Window.partitionBy(*keys).orderBy(*ordering)
    out = df.withColumn("__first", F.row_number().over(w) == 1)
    return out if value is None else out.withColumn("__next", F.lead(F.col(value)).over(w))


def _first_and_next_by_layout(df: DataFrame, keys: list[str], ordering: list[Column], value: str | None,
                              num_partitions: int | None = None) -> DataFrame:
    """The same for keys with any number of rows.  Each partition of the stored layout orders its own
    rows; a table with one row per partition (its first and last key and its first ``value``), scanned in order
    and broadcast, stitches them together."""
    laid = ordered_layout(df, [*(F.col(k).asc() for k in keys), *ordering], num_partitions)
    key = F.struct(*[F.col(k) for k in keys])
    ends = [F.min_by(key, "__pos").alias("head"), F.max_by(key, "__pos").alias("tail")]
    if value is not None:
        ends.append(F.min_by(F.struct(F.col(value).alias("v")), "__pos").alias("value"))
    edge = laid.groupBy("__p").agg(*ends)
    scan = Window.orderBy("__p")      # one row per partition
    edge = edge.select("__p", F.lag("tail").over(scan).alias("__tail"), F.lead("head").over(scan).alias("__head"),
                       *([F.lead("value").over(scan).alias("__value")] if value is not None else []))
    w = Window.partitionBy("__p", *keys).orderBy("__pos")
    runs = laid.withColumn("__rn", F.row_number().over(w))
    if value is not None:
        runs = runs.withColumn("__here", F.lead(F.struct(F.col(value).alias("v"))).over(w))
    met = runs.join(F.broadcast(edge), "__p", "left")
    out = met.withColumn("__first", (F.col("__rn") == 1) & ~key.eqNullSafe(F.col("__tail")))
    if value is not None:
        beyond = F.when(key.eqNullSafe(F.col("__head")), F.col("__value.v"))
        out = out.withColumn("__next", F.when(F.col("__here").isNotNull(), F.col("__here.v")).otherwise(beyond))
    return out.select(*df.columns, "__first", *(["__next"] if value is not None else []))


def _ordered(df: DataFrame, keys: list[str], ordering: list[Column], value: str | None = None,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``__first`` and ``__next``.  Rows are counted per key first (partial counts, so
    only keys are shuffled); a key of more than ``hot_rows`` takes the stored layout, the others one shuffle."""
    counts = df.groupBy(*[F.col(k).alias(f"__h_{k}") for k in keys]).count().filter(F.col("count") > hot_rows).drop("count")
    hot = frozen(counts, "hot-keys")
    if hot.isEmpty():
        return _first_and_next(df, keys, ordering, value)
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in keys])
    return _first_and_next(df.join(hot, same, "left_anti"), keys, ordering, value).unionByName(
        _first_and_next_by_layout(df.join(hot, same, "left_semi"), keys, ordering, value))


def flag_latest(df: DataFrame, keys, order, flag_col: str = "is_current",
                tie_break: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mark the first row per key under ``order`` 'A' and every other row 'I'.
    Keeps all rows; skew-safe (see module doc)."""
    keys = _keys(keys)
    ordering = total_order(df, keys, order) if tie_break else _sort_cols(order)
    cols = [c for c in df.columns if c != flag_col]
    rows = _ordered(df, keys, ordering, hot_rows=hot_rows)
    return rows.select(*cols, F.when(F.col("__first"), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias(flag_col))


def _next_start(df: DataFrame, keys, start: str, order_extra=None, tie_break: bool = True, hot_rows: int = HOT_ROWS):
    keys = _keys(keys)
    order = [start] + list(order_extra or [])
    ordering = total_order(df, keys, order) if tie_break else _sort_cols(order)
    return _ordered(df, keys, ordering, value=start, hot_rows=hot_rows)


def derive_end_date(df: DataFrame, keys, start: str, end_col: str = "end_date",
                    flag_col: str | None = None, order_extra=None,
                    tie_break: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """End of validity = the next version's start minus one day, per key,
    ordered by ``start``; the last version has no end.  With ``flag_col``
    also flag open versions 'A' and closed ones 'I'."""
    j = _next_start(df, keys, start, order_extra, tie_break, hot_rows)
    end = F.date_sub(F.col("__next").cast("date"), 1)
    out = [c for c in df.columns if c not in (end_col, flag_col)]
    sel = [F.col(c) for c in out] + [end.alias(end_col)]
    if flag_col:
        sel.append(F.when(end.isNull(), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias(flag_col))
    return j.select(*sel)


def flag_open(df: DataFrame, keys, start: str, flag_col: str = "is_current",
              order_extra=None, tie_break: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """'A' for the version with no successor per key (ordered by ``start``),
    'I' otherwise."""
    j = _next_start(df, keys, start, order_extra, tie_break, hot_rows)
    end = F.date_sub(F.col("__next").cast("date"), 1)
    out = [c for c in df.columns if c != flag_col]
    return j.select(*out, F.when(end.isNull(), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE))
                    .alias(flag_col))
