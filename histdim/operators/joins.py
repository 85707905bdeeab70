"""Lookups and set differences by key.

Hot keys -- including a flood of NULL keys, which all hash to one shuffle
partition -- are left to AQE's skew-join handling
(``spark.sql.adaptive.skewJoin.enabled``): an oversized partition on the
preserved side of a left outer or left anti join is split into several tasks
and the matching partition of the other side is replicated to each.  Routing
NULL keys around the join by hand would scan and compute the input twice.
Broadcast is left to AQE's runtime size check
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) because the looked-up
tables grow with the data.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _all(conds: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conds) if conds else F.lit(True)


def lookup(left: DataFrame, right: DataFrame, left_on, right_on=None,
           select=None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on equal keys (plain ``=``; a NULL key
    finds nothing).  ``select`` names the right-side columns to bring
    (default: all but the right keys)."""
    lk = _names(left_on)
    rk = _names(right_on) if right_on is not None else lk
    bring = _names(select) if select is not None else [c for c in right.columns if c not in rk]
    tag = "__lk_"
    r = right.select(*[F.col(k).alias(f"{tag}{i}") for i, k in enumerate(rk)], *bring)
    cond = _all([F.col(l) == F.col(f"{tag}{i}") for i, l in enumerate(lk)])
    return left.join(r, cond, "left").drop(*[f"{tag}{i}" for i in range(len(rk))])


def anti_by(src: DataFrame, tgt: DataFrame, on: Sequence, null_safe: bool = False,
            src_exprs: Sequence[Column] | None = None,
            tgt_exprs: Sequence[Column] | None = None) -> DataFrame:
    """Rows of ``src`` with no row in ``tgt`` equal on every ``on`` column
    (``NOT EXISTS``).  With plain ``=`` a NULL on either side never matches;
    ``null_safe`` uses ``<=>``.  ``src_exprs`` / ``tgt_exprs`` replace the
    columns by expressions (e.g. ``coalesce(key, 0)``)."""
    on = list(on)
    s_ex = list(src_exprs) if src_exprs is not None else [F.col(c) for c in on]
    t_ex = list(tgt_exprs) if tgt_exprs is not None else [F.col(c) for c in on]
    names = [f"__ak{i}" for i in range(len(on))]
    t = tgt.select(*[e.alias(n) for e, n in zip(t_ex, names)])
    if null_safe:
        cond = _all([e.eqNullSafe(F.col(n)) for e, n in zip(s_ex, names)])
    else:
        cond = _all([e == F.col(n) for e, n in zip(s_ex, names)])
    return src.join(t, cond, "left_anti")


def append_new_exact(src: DataFrame, tgt: DataFrame, cols: Sequence[str] | None = None,
                     null_safe: bool = False) -> DataFrame:
    """Source rows that are not already in the target, comparing ``cols``
    (default: all source columns).  Plain ``=`` re-admits rows holding a NULL
    in any compared column on every load; ``null_safe`` treats NULL = NULL."""
    cols = list(cols) if cols is not None else src.columns
    return anti_by(src, tgt, cols, null_safe=null_safe)


def append_new_hashed(src: DataFrame, tgt: DataFrame, cols: Sequence[str],
                      null_safe: bool = False) -> DataFrame:
    """As ``append_new_exact``; rows meet on one hash of ``cols`` and are compared
    column by column there, so many columns make no wide join key."""
    t = tgt.select(*[F.col(c).cast(src.schema[c].dataType).alias(f"__ah_{c}") for c in cols])
    t = t.withColumn("__ah", F.xxhash64(*t.columns))
    equal = [F.col(c).eqNullSafe(F.col(f"__ah_{c}")) if null_safe else F.col(c) == F.col(f"__ah_{c}")
             for c in cols]
    return (src.withColumn("__h", F.xxhash64(*cols))
            .join(t, _all([F.col("__h") == F.col("__ah"), *equal]), "left_anti").drop("__h"))


def new_keys_only(src: DataFrame, tgt: DataFrame, keys, tgt_keys=None) -> DataFrame:
    """Source rows whose key appears in no target row (any version)."""
    keys = _names(keys)
    tk = _names(tgt_keys) if tgt_keys is not None else keys
    return anti_by(src, tgt, keys, tgt_exprs=[F.col(c) for c in tk])


def append_new_keyed(src: DataFrame, tgt: DataFrame, defaulted: dict, exact: Sequence[str],
                     tgt_names: dict | None = None, null_safe: bool = False) -> DataFrame:
    """``NOT EXISTS`` where the ``defaulted`` columns compare as
    ``coalesce(col, default)`` on both sides and the ``exact`` columns with
    plain ``=`` (or ``<=>`` when ``null_safe``).  ``tgt_names`` maps a source
    column name to the target's name for it."""
    tn = tgt_names or {}
    on = list(defaulted) + list(exact)
    s_ex = ([F.coalesce(F.col(c), F.lit(d)) for c, d in defaulted.items()]
            + [F.col(c) for c in exact])
    t_ex = ([F.coalesce(F.col(tn.get(c, c)), F.lit(d)) for c, d in defaulted.items()]
            + [F.col(tn.get(c, c)) for c in exact])
    if null_safe:
        return anti_by(src, tgt, on, null_safe=True, src_exprs=s_ex, tgt_exprs=t_ex)
    return anti_by(src, tgt, on, src_exprs=s_ex, tgt_exprs=t_ex)
