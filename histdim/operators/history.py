"""Type-2 history maintenance as DataFrame operators.

A history table has business columns plus ``dwh_create_date`` (load time),
``is_current`` ('A' active, 'I' inactive) and ``modified_dt`` (expiry day).
Spark has no row-level ``MERGE`` on plain Parquet, so an upsert is expressed as
a join that emits every output row exactly once.

``scd2_merge`` plan: history ('I') rows pass through untouched and are never
shuffled; only the active slice and the source are hash-partitioned on the key.
The active rows are judged against the source per key, then both meet in one full outer
join.  Each joined pair emits one or two rows through ``inline(array(...))`` in
the same pass: the target row (kept, or expired) and the source row (new key,
or new version).  NULL keys never match, so NULL-key rows skip the join instead
of piling into one task.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.functions.clean import load_time
from histdim.functions.compare import changed as _changed
from histdim.session import frozen
from histdim.sources.schemas import ACTIVE, INACTIVE

HISTORY_COLS = ("dwh_create_date", "is_current", "modified_dt")
ACTION = "_action"
# action tags produced with ``with_action=True`` (read by ``load_audit``)
HISTORY, UNTOUCHED, UNCHANGED, EXPIRED, INSERTED, NEW_VERSION = (
    "history", "untouched", "unchanged", "expired", "inserted", "new_version")


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _any_null(cols) -> Column:
    return functools.reduce(operator.or_, [F.col(c).isNull() for c in cols])


def _ts(load_ts) -> Column:
    return load_time(load_ts)


def with_load_defaults(df: DataFrame, load_ts, flag: str = ACTIVE) -> DataFrame:
    """Add the three history columns for freshly inserted rows."""
    return df.withColumns({
        "dwh_create_date": _ts(load_ts),
        "is_current": F.lit(flag),
        "modified_dt": F.lit(None).cast(T.DateType()),
    })


def _business_cols(target: DataFrame, extra_excluded=()) -> list[str]:
    return [c for c in target.columns if c not in HISTORY_COLS and c not in extra_excluded]


def _by_flag(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(active rows, all others): a row whose flag is NULL isn't active, and is kept as history."""
    active = F.col("is_current").eqNullSafe(F.lit(ACTIVE))
    return table.filter(active), table.filter(~active)


def one_per_key(source: DataFrame, keys) -> DataFrame:
    """``source``, failing the query if two rows share a (non-NULL) key."""
    keys = _names(keys)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    fails = F.raise_error(F.concat(F.lit("several source rows for one key: "),
                                   F.to_json(F.struct(*keys)))).cast("boolean")
    return (source.withColumn("__turn", turn)
            .filter(F.when((F.col("__turn") == 1) | _any_null(keys), F.lit(True)).otherwise(fails))
            .drop("__turn"))


def scd2_merge(target: DataFrame, source: DataFrame, keys, load_ts,
               compare: Sequence[str] | None = None, mode: str = "sentinel",
               collation: str | None = None, with_action: bool = False,
               null_keys: bool = True, check_source: bool = True) -> DataFrame:
    """Type-2 upsert of ``source`` into ``target``; returns the whole new table.

    * target active row, key absent from source -> kept
    * matched and equal on ``compare``            -> kept
    * matched and different                      -> target row expired
      (``is_current='I'``, ``modified_dt`` = load day)
    * source row without an active target row equal to it -> inserted, once
      per key, however many active rows a dirty target has for it (also when the key
      only has expired rows)

    ``source`` must hold at most one row per key (use ``latest_per_key``), or the query
    fails, and every business column of ``target``.  ``compare`` defaults to all
    non-key business columns; ``mode`` / ``collation`` as in
    :func:`histdim.functions.compare.differs`.  ``null_keys=False`` says that neither
    side has NULL keys, which spares their branch of the plan; ``check_source=False`` that
    ``source`` is known to hold one row per key.
    """
    keys = _names(keys)
    biz = _business_cols(target)
    compare = list(compare) if compare is not None else [c for c in biz if c not in keys]
    types = {f.name: f.dataType for f in target.schema.fields}
    load_day = load_time(load_ts).cast(T.DateType())

    act, hist = _by_flag(target)
    src = source.select(*[F.col(c).cast(types[c]).alias(c) for c in biz])
    src = one_per_key(src, keys) if check_source else src

    t_cols = biz + list(HISTORY_COLS)
    t = act.filter(~_any_null(keys)) if null_keys else act
    s = src.filter(~_any_null(keys)) if null_keys else src
    t = t.select(*[F.col(c).alias(f"__t_{c}") for c in t_cols], F.lit(True).alias("__t"))

    def side(p):
        return s.select(*[F.col(c).alias(f"{p}{c}") for c in biz], F.lit(True).alias(p + "in"))

    def matches(p):
        return functools.reduce(operator.and_, [F.col(f"__t_{k}") == F.col(f"{p}{k}") for k in keys])

    def diff(p):
        return _changed([(F.col(f"__t_{c}"), F.col(f"{p}{c}"), types[c]) for c in compare],
                        mode, collation)

    # per key, over its active rows: is one equal to the source; which one comes first
    same_key = Window.partitionBy(*[f"__t_{k}" for k in keys])
    t = (t.join(side("__e_"), matches("__e_"), "left")
         .withColumn("__same", F.max(F.col("__e_in").isNotNull() & ~diff("__e_")).over(same_key))
         .withColumn("__first", F.row_number().over(same_key.orderBy("__t_dwh_create_date")) == 1)
         .drop(*[f"__e_{c}" for c in [*biz, "in"]]))
    j = t.join(side("__s_"), matches("__s_"), "full_outer")

    has_t, has_s = F.col("__t").isNotNull(), F.col("__s_in").isNotNull()
    chg = has_t & has_s & diff("__s_")

    out_fields = t_cols + [ACTION]
    t_row = F.when(has_t, F.struct(
        *[F.col(f"__t_{c}").alias(c) for c in biz],
        F.col("__t_dwh_create_date").alias("dwh_create_date"),
        F.when(chg, F.lit(INACTIVE)).otherwise(F.col("__t_is_current")).alias("is_current"),
        F.when(chg, load_day).otherwise(F.col("__t_modified_dt")).alias("modified_dt"),
        F.when(chg, F.lit(EXPIRED)).when(has_s, F.lit(UNCHANGED)).otherwise(F.lit(UNTOUCHED))
         .alias(ACTION)))
    s_row = F.when(has_s & (~has_t | (F.col("__first") & ~F.col("__same"))), F.struct(
        *[F.col(f"__s_{c}").alias(c) for c in biz],
        _ts(load_ts).alias("dwh_create_date"),
        F.lit(ACTIVE).alias("is_current"),
        F.lit(None).cast(T.DateType()).alias("modified_dt"),
        F.when(has_t, F.lit(NEW_VERSION)).otherwise(F.lit(INSERTED)).alias(ACTION)))
    out = (j.select(F.inline(F.filter(F.array(t_row, s_row), lambda x: x.isNotNull())))
           .select(*out_fields))

    if null_keys:      # an active target row is kept, a source row is inserted
        t_null = act.filter(_any_null(keys)).select(*t_cols, F.lit(UNTOUCHED).alias(ACTION))
        s_null = with_load_defaults(src.filter(_any_null(keys)), load_ts).select(
            *t_cols, F.lit(INSERTED).alias(ACTION))
        out = out.unionByName(t_null).unionByName(s_null)
    out = out.unionByName(hist.select(*t_cols, F.lit(HISTORY).alias(ACTION)))
    out = out.select(*[F.col(c).cast(types[c]).alias(c) for c in t_cols], ACTION)
    return out if with_action else out.drop(ACTION)


def _branch(action: str):
    def op(target, source, keys, load_ts, compare=None, mode="sentinel", collation=None):
        return (scd2_merge(target, source, keys, load_ts, compare, mode, collation,
                           with_action=True)
                .filter(F.col(ACTION) == F.lit(action)).drop(ACTION))
    return op


expire_changed = _branch(EXPIRED)
expire_changed.__doc__ = "Active target rows that differ from the source, expired."
insert_unmatched = _branch(INSERTED)
insert_unmatched.__doc__ = "Source rows whose key has no active target row, as new rows."
insert_new_version = _branch(NEW_VERSION)
insert_new_version.__doc__ = "New active versions for keys whose active row changed."


def detect_changes(source: DataFrame, dim: DataFrame, src_key: str, dim_key: str,
                   compare: Sequence[tuple[str, str]], mode: str = "sentinel",
                   collation: str | None = None) -> DataFrame:
    """Source rows that differ from every *current* version of their key, each
    once (equal source rows count as one).

    ``compare`` pairs ``(dim column, source column)``; the sentinel used for a
    NULL follows the dim column's type.  Returns source columns only.
    """
    types = {f.name: f.dataType for f in dim.schema.fields}
    cur = dim.filter(F.col("is_current") == F.lit(ACTIVE))
    d = cur.select(F.col(dim_key).alias("__dk"),
                   *[F.col(dc).alias(f"__d_{dc}") for dc, _ in compare])
    j = source.filter(F.col(src_key).isNotNull()).join(d, F.col(src_key) == F.col("__dk"), "inner")
    diff = _changed([(F.col(f"__d_{dc}"), F.col(sc), types[dc]) for dc, sc in compare],
                    mode, collation)
    return (j.groupBy(*source.columns).agg(F.min(diff).alias("__all_differ"))
            .filter("__all_differ").select(*source.columns))


def scd2_dim_load(dim: DataFrame, source: DataFrame, key: str, surrogate: str, load_ts,
                  compare: Sequence[str], mode: str = "sentinel",
                  collation: str | None = None, with_action: bool = False,
                  unique_source: bool = True, last_key: int | None = None, expired: DataFrame | None = None) -> DataFrame:
    """Type-2 load of a star-schema dimension that owns a surrogate key.  ``dim`` is the whole dimension, or
    its active rows if the others are given as ``expired`` (which leaves stored buckets of the former as they are).

    ``source`` carries the dimension's business columns (already renamed), at most
    one row per key, or the query fails (``unique_source=False``: the least row per key counts).  A source row that differs from every current version
    of its key replaces them: they are expired and it is inserted, once.  Source rows
    whose key has *no* row at all in the dimension are inserted.  A key that only
    has expired rows is not re-inserted.  Inserted rows get surrogate keys
    after the current maximum (``last_key``, if the caller knows it; else it is looked up): changed rows first, then new keys, each in
    business-key order.  Existing surrogate keys never change.

    The source is computed once (frozen in the scratch folder).  It meets the active
    versions in one join; the verdict per key is aggregated there, without another
    shuffle, and of older versions only the distinct keys are moved.
    """
    from histdim.operators.dedupe import latest_per_key
    from histdim.operators.keys import assign_surrogate_keys

    types = {f.name: f.dataType for f in dim.schema.fields}
    biz = [c for c in _business_cols(dim) if c != surrogate]
    src = source.select(*[F.col(c).cast(types[c]).alias(c) for c in biz]).filter(F.col(key).isNotNull())
    src = frozen(one_per_key(src, key) if unique_source else latest_per_key(src, key, []), "dim-source")
    load_day = load_time(load_ts).cast(T.DateType())
    cols = [surrogate] + biz + list(HISTORY_COLS)

    act, hist = _by_flag(dim) if expired is None else (dim, expired)
    met = act.join(src.select(*[F.col(c).alias(f"__s_{c}") for c in biz], F.lit(True).alias("__s")),
                   F.col(key) == F.col(f"__s_{key}"), "left")
    diff = _changed([(F.col(c), F.col(f"__s_{c}"), types[c]) for c in compare], mode, collation)
    chg = F.col("__s").isNotNull() & diff
    act_out = met.select(
        surrogate, *biz, "dwh_create_date",
        F.when(chg, F.lit(INACTIVE)).otherwise(F.col("is_current")).alias("is_current"),
        F.when(chg, load_day).otherwise(F.col("modified_dt")).alias("modified_dt"),
        F.when(chg, F.lit(EXPIRED)).when(F.col("__s").isNotNull(), F.lit(UNCHANGED))
         .otherwise(F.lit(UNTOUCHED)).alias(ACTION))
    verdict = met.groupBy(F.col(key).alias("__k")).agg(F.min(chg).alias("__changed"))
    old = hist.select(F.col(key).alias("__h")).distinct()
    judged = (src.join(verdict, F.col(key) == F.col("__k"), "left")
              .join(old, F.col(key) == F.col("__h"), "left"))
    step = F.when(F.col("__changed"), F.lit(1)).when(F.col("__k").isNull() & F.col("__h").isNull(),
                                                     F.lit(2))
    inserts = judged.withColumn("__step", step).filter("__step is not null").select(*biz, "__step")
    if last_key is None:
        last_key = max(x.agg(F.max(surrogate)).first()[0] or 0 for x in ([dim] if expired is None else [act, hist]))
    start = last_key + 1
    keyed = assign_surrogate_keys(inserts, surrogate, ["__step", key], start=start)
    keyed = with_load_defaults(keyed.withColumn(
        ACTION, F.when(F.col("__step") == 1, F.lit(NEW_VERSION)).otherwise(F.lit(INSERTED))), load_ts)
    out = (act_out.unionByName(keyed.select(*cols, ACTION))
           .unionByName(hist.select(*cols, F.lit(HISTORY).alias(ACTION))))
    out = out.select(*[F.col(c).cast(types[c]).alias(c) for c in cols], ACTION)
    return out if with_action else out.drop(ACTION)
