"""The three load pipelines: raw files -> raw tables -> stage history ->
report star schema, composed from the operators.

Every step takes the load id and ``load_ts`` as arguments (never the wall
clock), reads committed state and what this very load has written, writes only its
own ``load=<id>`` directories (see :mod:`histdim.sources.store`) and commits at
the end, so a failed or repeated load can simply be run again.  ``safe=True``
applies the settled semantics (NULL-safe exact matching of sales rows,
current-version joins, business-key fact matching, NULL keys dropped everywhere);
``safe=False`` follows the rules as originally written.  Change detection
uses the sentinel rule (NULL equals the type's default) in both modes.

A safe load's fact work follows the batch: only the sales staged by this load
and the fact rows that still wait for a dimension row are resolved, and of the
settled fact only the batch's order months are compared.

What a load did is counted while it writes (observed metrics), never by reading it back.  The checks
of the star schema are incremental too: counters of what is settled are stored with each load, and a load
reads what it wrote itself, and of older dimension rows only keys that its own fact rows
have and its active slice lacks.  A failed check keeps the load from being committed.  Scratch data of a load is removed at its end.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.functions.clean import parse_packed_date
from histdim.operators.audit import action_counts, audit_rows, counted, dq_checks, dq_star, observed, row_checks, rows_where
from histdim.operators.history import ACTION, HISTORY, scd2_dim_load, scd2_merge
from histdim.operators.star import (conform_customers, enrich_products, is_pending,
                                    load_fact, load_fact_incremental, load_sales_stage, month_of)
from histdim.plans import cleaning
from histdim.session import frozen, in_threads, scratch_owner
from histdim.sources.files import RejectedRows, batch_path, split_delimited
from histdim.sources.schemas import ACTIVE, FACT_STORED, RAW, REPORT, STAGE, STAGE_KEYS, conform, enforced, lengths
from histdim.sources.store import Warehouse

RAW_LAYER, STAGE_LAYER, REPORT_LAYER, CHECK_LAYER = "stg0", "stage", "report", "checks"
SALES, FACT = "crm_sales_details", "fact_sales"

# compared columns of the two report dimensions (customer number and create
# date are deliberately not compared for customers)
CUSTOMER_COMPARE = ["first_name", "last_name", "country", "marital_status", "gender",
                    "birthdate"]
PRODUCT_COMPARE = ["product_number", "product_name", "category_id", "category", "subcategory",
                   "maintenance", "cost", "product_line", "start_date"]

_MONTH = T.StructField("order_month", T.IntegerType())
_SALES_PARTS = T.StructType([*STAGE[SALES].fields, _MONTH])
_FACT_PARTS = T.StructType([*FACT_STORED.fields, T.StructField("state", T.StringType()), _MONTH])


def _record(records: list, table: str, step: str, seconds: float, counts: dict[str, int]) -> None:
    records += [{"table": table, "step": step, "action": a, "rows": n, "seconds": seconds}
                for a, n in counts.items()]


_PACKED = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
_RAW_PARTS = T.StructType([*RAW[SALES].fields, T.StructField("rejected", T.BooleanType())])


def _batch_dates(wh: Warehouse, load: int) -> tuple[list[int], int]:
    """The order months of a load's raw sales (as many as the calendar has, at most), and how many packed dates are there but no
    dates.  Three narrow columns are read for it: beside the parse of the lines these expressions make a method too long
    for the JVM to compile, and observed metrics would interpret them."""
    bad = [(F.col(c).isNotNull() & (F.col(c) != 0) & parse_packed_date(c).isNull()).cast("long") for c in _PACKED]
    month = F.when(~F.col("rejected"), month_of(parse_packed_date("sls_order_dt")))
    found = (wh.read_parts(RAW_LAYER, SALES, _RAW_PARTS, [load]).groupBy(month.alias("month"))
             .agg(F.sum(bad[0] + bad[1] + bad[2]).alias("bad")).collect())
    return [r["month"] for r in found if r["month"] is not None], sum(r["bad"] for r in found)


def load_stg0(wh: Warehouse, batch_root: str, batch: str, load: int,
              records: list | None = None, parallel: int = 6, allow_rejects: bool = False) -> dict[str, list[int]]:
    """Full reload of the six raw tables from one batch folder: one parse and one write each, in which
    lines that do not fit their schema go to a partition of their own; unless
    ``allow_rejects``, their presence fails the load.  The six loads are
    independent Spark jobs submitted from a small thread pool.  Returns the order months of the
    batch's sales."""
    records = records if records is not None else []
    months: list[int] = []

    def one(table):
        t0 = time.perf_counter()
        path = batch_path(batch_root, batch, table)
        metrics = {"read": rows_where(~F.col("rejected")), "rejected": rows_where(F.col("rejected"))}
        lines, seen = observed(split_delimited(wh.spark, path, RAW[table]), metrics)
        where = wh.write_parts(lines, RAW_LAYER, table, load, "rejected")
        counts = counted(seen)
        if counts["rejected"] and not allow_rejects:
            raise RejectedRows(f"{counts['rejected']} lines of {path} do not fit {table}; see {where}/rejected=true")
        seconds = time.perf_counter() - t0
        _record(records, table, "raw", seconds, {a: counts[a] for a in ("read", "rejected")})
        if table == SALES:      # staging turns them into NULLs
            seen_months, invalid = _batch_dates(wh, load)
            _record(records, table, "stage", time.perf_counter() - t0 - seconds, {"invalid_dates": invalid})
            months.extend(seen_months)

    in_threads(one, RAW, parallel)
    return months


def read_raw(wh: Warehouse, table: str, load: int | None) -> DataFrame:
    return wh.read_snapshot(RAW_LAYER, table, RAW[table], load, "rejected=false")


def read_rejected(wh: Warehouse, table: str, load: int | None) -> DataFrame:
    """``reason, line`` of the lines that a load rejected."""
    schema = T.StructType([T.StructField("reason", T.StringType()), T.StructField("line", T.StringType())])
    return wh.read_snapshot(RAW_LAYER, table, schema, load, "rejected=true")


def _stage_sources(wh: Warehouse, load: int, load_ts, safe: bool) -> dict[str, DataFrame]:
    raw = {t: read_raw(wh, t, load) for t in RAW}
    return {
        "crm_cust_info": cleaning.clean_customers(raw["crm_cust_info"], safe),
        "crm_prod_info": cleaning.clean_products(raw["crm_prod_info"], safe),
        "erp_cust_az12": cleaning.clean_az12(raw["erp_cust_az12"], load_ts, safe),
        "erp_loc_a101": cleaning.clean_locations(raw["erp_loc_a101"], safe),
        "erp_px_cat_g1v2": cleaning.clean_categories(raw["erp_px_cat_g1v2"], safe),
        SALES: raw[SALES],
    }


def read_sales(wh: Warehouse, load: int | None, only: bool = False, months=None) -> DataFrame:
    df = wh.read_append(STAGE_LAYER, SALES, _SALES_PARTS, load, only)
    if months is not None:
        df = df.filter(F.col("order_month").isin(months))
    return conform(df, STAGE[SALES])


def load_stage(wh: Warehouse, load: int, prev: int | None, load_ts, months: list[int], safe: bool = True,
               records: list | None = None, parallel: int = 6) -> tuple[list[int], int]:
    """Merge every cleaned source into its stage history table; append new
    sales rows.  Each merge reads only the active slice of the previous
    state, and sales only ``months``, those of the batch.  Returns the order months of the sales that are new, and how many these are."""
    records = records if records is not None else []
    new_months: list[int] = []
    new_sales: list[int] = []
    sources = _stage_sources(wh, load, load_ts, safe)

    def one(table):
        t0 = time.perf_counter()
        keys, schema = STAGE_KEYS[table], STAGE[table]
        if keys is None:
            tasks = int(wh.spark.conf.get("spark.sql.shuffle.partitions"))      # two slices of a month for each
            new = load_sales_stage(sources[table], read_sales(wh, prev, months=months), load_ts,
                                   null_safe=safe, slices=-(-2 * tasks // max(1, len(months))))
            new = enforced(new, schema, table).withColumn("order_month", month_of("sls_order_dt"))
            new = by_month(new) if prev is not None else new      # of a first load all rows are new, and in place
            new, seen = observed(new, {"inserted": rows_where(F.lit(True)), "months": (F.collect_set, F.col("order_month"))})
            # in order of day and number they take less space, here and on the way to the next load's comparison
            wh.write_append(STAGE_LAYER, table, new.sortWithinPartitions("order_month", "sls_order_dt", "sls_ord_num"),
                            load, "order_month")
            counts = counted(seen)
            new_months.extend(counts.pop("months"))
            new_sales.append(counts["inserted"])
        else:
            active = wh.read_history(STAGE_LAYER, table, schema, prev, active_only=True)
            merged = scd2_merge(active, sources[table], keys, load_ts, with_action=True,
                                null_keys=not safe, check_source=False)      # cleaning leaves one row per key
            merged = enforced(merged.filter(F.col(ACTION) != F.lit(HISTORY)), schema, table, keys if safe else ())
            merged, seen = observed(merged, action_counts())
            wh.write_history(STAGE_LAYER, table, merged.drop(ACTION), load, keys)
            counts = counted(seen)
        _record(records, table, "stage", time.perf_counter() - t0, counts)

    # the six tables are independent: submit their jobs concurrently
    in_threads(one, STAGE_KEYS, parallel)
    return new_months, sum(new_sales)


def _customer_source(wh: Warehouse, load: int, safe: bool) -> DataFrame:
    st = {t: wh.read_history(STAGE_LAYER, t, STAGE[t], load, active_only=safe)
          for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")}
    c = conform_customers(st["crm_cust_info"], st["erp_cust_az12"], st["erp_loc_a101"],
                          current_only=safe)
    return c.select(F.col("cst_id").alias("customer_id"),
                    F.col("cst_key").alias("customer_number"),
                    F.col("cst_firstname").alias("first_name"),
                    F.col("cst_lastname").alias("last_name"),
                    F.col("cntry").alias("country"),
                    F.col("cst_marital_status").alias("marital_status"),
                    "gender", F.col("bdate").alias("birthdate"),
                    F.col("cst_create_date").cast("timestamp_ntz").alias("create_date"))


def _product_source(wh: Warehouse, load: int, safe: bool) -> DataFrame:
    p, c = (wh.read_history(STAGE_LAYER, t, STAGE[t], load, active_only=safe) for t in ("crm_prod_info", "erp_px_cat_g1v2"))
    e = enrich_products(p, c, current_only=safe)
    return e.select(F.col("prd_id").alias("product_id"), F.col("prd_key").alias("product_number"),
                    F.col("prd_nm").alias("product_name"), F.col("cat_id").alias("category_id"),
                    F.col("cat").alias("category"), F.col("subcat").alias("subcategory"),
                    "maintenance", F.col("prd_cost").alias("cost"),
                    F.col("prd_line").alias("product_line"),
                    F.col("prd_start_dt").alias("start_date"))


def by_month(rows: DataFrame) -> DataFrame:
    """Rows of a month together, so that a load writes few files a month and not one per task; a month with
    many rows is split by their size (adaptive rebalancing)."""
    return rows.hint("rebalance", "order_month")


def fact_parts(rows: DataFrame, placed: bool = False) -> DataFrame:
    """Rows with their partition: state and order month.  ``final`` rows are appended, ``pending``
    ones (still without a dimension row) replace the last load's.  ``placed``: the rows of a month are together."""
    rows = rows.withColumn("order_month", month_of("order_date"))
    rows = rows if placed else by_month(rows)
    return rows.withColumn("state", F.when(is_pending(), F.lit("pending")).otherwise(F.lit("final")))


def read_fact(wh: Warehouse, load: int | None, state: str, months=None) -> DataFrame:
    """The fact's ``final`` or ``pending`` rows as of a load, with business ids."""
    loads = wh.visible(load)
    df = wh.read_parts(REPORT_LAYER, FACT, _FACT_PARTS, loads if state == "final" else loads[-1:],
                       f"state={state}")
    if months is not None:
        df = df.filter(F.col("order_month").isin(months))
    return conform(df, FACT_STORED)


#: Up to so many rows, counted while they were written, a dimension's keys (two narrow columns) and a load's new
#: sales are broadcast; more are shuffled.  The driver holds what is broadcast, at up to some 150 bytes a row of a dimension
#: and 250 of sales, and both dimensions at once.
MOST_BROADCAST = {"dimension": 1_000_000, "sales": 200_000}
#: Up to so many rows for each partition a shuffled dimension is met by hash tables; else it is sorted, as the other side is.
MOST_HASHED = 1_000_000


def _joined(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of a dimension, told how they meet the fact."""
    if n <= MOST_BROADCAST["dimension"]:
        return F.broadcast(rows)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.hint("shuffle_hash") if n <= MOST_HASHED * tasks else rows


#: Report dimension: (business key, surrogate key, compared columns, source).
DIMENSIONS = {"dim_customers": ("customer_id", "customer_key", CUSTOMER_COMPARE, _customer_source),
              "dim_products": ("product_id", "product_key", PRODUCT_COMPARE, _product_source)}
_FACT_ROW_CHECKS = {"sales_amount": lambda: F.col("sales_amount") != F.col("quantity") * F.abs("price"),
                    "unresolved_product_key": lambda: F.col("product_key").isNull(),
                    "unresolved_customer_key": lambda: F.col("customer_key").isNull()}


def _limits(table: str) -> dict[str, int]:
    return {c: n for c, n in lengths(REPORT[table]).items() if c != "is_current"}


def _open_and_closed(checks: dict, is_open) -> dict:
    """Metrics ``open_<check>`` and ``closed_<check>``: violations among rows that a later
    load replaces, and among those that stay as they are for good."""
    return {f"{side}_{n}": rows_where(c & (is_open if side == "open" else ~is_open))
            for n, c in checks.items() for side in ("open", "closed")}


def load_report(wh: Warehouse, load: int, prev: int | None, load_ts, months: list[int], safe: bool = True,
                records: list | None = None, new_sales: int | None = None) -> dict[str, dict]:
    """Type-2 load of both dimensions (surrogate keys continue after the
    current maximum), then the fact against the dimensions just written, of which only ``months``, those
    of the new sales (``new_sales`` in number, if known), are compared.  Returns per table the counters that ``check_load`` builds on."""
    records = records if records is not None else []
    counters: dict[str, dict] = {}
    before = stored_counters(wh, prev)

    def dimension(table):
        t0 = time.perf_counter()
        key, surrogate, compare, source = DIMENSIONS[table]
        dim = wh.read_history(REPORT_LAYER, table, REPORT[table], prev, active_only=True)
        expired = wh.read_expired(REPORT_LAYER, table, REPORT[table], prev)
        merged = scd2_dim_load(dim, source(wh, load, safe), key, surrogate, load_ts, compare,
                               with_action=True, unique_source=safe, last_key=before[table].get("key_max"),
                               expired=expired)
        merged = enforced(merged.filter(F.col(ACTION) != F.lit(HISTORY)), REPORT[table], table)
        is_open, new = F.col("is_current").eqNullSafe(F.lit(ACTIVE)), F.col(ACTION).isin("inserted", "new_version")
        actions = action_counts()
        merged, seen = observed(merged, actions | _open_and_closed({"rows": F.lit(True)} | row_checks(key, _limits(table)), is_open) | {
            "key_min": (F.min, F.col(surrogate)), "key_max": (F.max, F.col(surrogate)), "new_min": (F.min, F.when(new, F.col(surrogate)))})
        # a bucket's rows in one task, so that a load writes one file a bucket and not one per task and bucket
        buckets = int(wh.spark.conf.get("spark.sql.shuffle.partitions"))
        wh.write_history(REPORT_LAYER, table, merged.drop(ACTION).repartition(buckets, key), load, [key])
        counters[table] = counted(seen)
        _record(records, table, "report", time.perf_counter() - t0, {a: counters[table][a] for a in actions})

    # both dimensions must be written before the fact reads their keys
    in_threads(dimension, DIMENSIONS, 2)
    t0 = time.perf_counter()
    current = {t: counters[t]["open_rows"] for t in DIMENSIONS}
    # not as buckets: keys that very many fact rows have (or NULLs) are split only where both sides are shuffled
    dp, dc = (_joined(conform(_written(wh, t, load), REPORT[t]), current[t]) for t in ("dim_products", "dim_customers"))
    # a first load's sales come from files of a month each and, if they meet nothing but broadcast dimensions, stay so
    placed = safe and prev is None and max(current.values()) <= MOST_BROADCAST["dimension"]
    if safe:
        sales = read_sales(wh, load, only=True)
        settled = read_fact(wh, prev, "final", months)
        rows = load_fact_incremental(sales, read_fact(wh, prev, "pending"), settled, dp, dc, load_ts, with_action=True,
                                     unique_sales=True, few_sales=new_sales is not None and new_sales <= MOST_BROADCAST["sales"])
    else:
        rows = load_fact(read_sales(wh, load), dp, dc, read_fact(wh, prev, "final"), load_ts)
        rows = rows.withColumns({"product_number": F.lit(None).cast("string"),
                                 "customer_id": F.lit(None).cast("int"), ACTION: F.lit("inserted")})
    pending = F.col("state") == "pending"
    actions = {"inserted": rows_where(~pending & (F.col(ACTION) == "inserted")),
               "resolved": rows_where(~pending & (F.col(ACTION) == "pending")), "pending": rows_where(pending)}
    rows, seen = observed(fact_parts(enforced(rows, FACT_STORED, FACT), placed),
                          actions | _open_and_closed({n: c() for n, c in _FACT_ROW_CHECKS.items()}, pending))
    rows = rows.drop(ACTION).sortWithinPartitions("state", "order_month", "order_date", "order_number")
    wh.write_append(REPORT_LAYER, FACT, rows, load, "state", "order_month")
    counters[FACT] = counted(seen)
    _record(records, FACT, "report", time.perf_counter() - t0, {a: counters[FACT][a] for a in actions})
    return counters


# --- checks -------------------------------------------------------------------------

_COUNTER = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("counter", T.StringType()),
                         T.StructField("value", T.LongType())])
#: Checks that are reported only: what waits for a dimension row, and what the rules as written let happen.
ADVISORY = {"sales_amount", "unresolved_product_key", "unresolved_customer_key", "product_fan_out"}


class FailedChecks(RuntimeError):
    """A load violates invariants of the star schema."""


def stored_counters(wh: Warehouse, load: int | None) -> dict[str, dict[str, int]]:
    """The counters that a load left for the next one (some dozens of rows), per table."""
    out: dict[str, dict[str, int]] = {t: {} for t in (*DIMENSIONS, FACT)}
    for r in (wh.read_snapshot(CHECK_LAYER, "counters", _COUNTER, load).collect() if load is not None else []):
        out[r.table_name][r.counter] = r.value
    return out


def _repeated(rows: DataFrame, column: str) -> int:
    """Values (NULL among them) that more than one row has."""
    return rows.groupBy(column).count().filter("count > 1").count()


def _copies(rows: DataFrame, column: str) -> int:
    return rows.agg((F.count(column) - F.count_distinct(column)).alias("n")).first()["n"]


def _written(wh: Warehouse, table: str, load: int) -> DataFrame:
    """The active slice that this load wrote."""
    return wh.read_parts(REPORT_LAYER, table, REPORT[table], [load], f"is_current={ACTIVE}")


def _missing_keys(wh: Warehouse, load: int, key: str, table: str, current_rows: int) -> dict[str, int]:
    """Fact rows of this load, by state, whose key its dimension lacks.  Nearly all keys are those of
    the active slice just written; only what that lacks is looked for among older versions."""
    fact = wh.read_parts(REPORT_LAYER, FACT, _FACT_PARTS, [load])
    keys = fact.filter(F.col(key).isNotNull()).select("state", F.col(key).alias("__k"))
    current = _joined(_written(wh, table, load).select(F.col(key).alias("__k")), current_rows)
    counts = [F.count(F.when(F.col("state") == s, F.lit(True))).alias(s) for s in ("final", "pending")]
    if current_rows <= MOST_BROADCAST["dimension"]:      # what is left to count is next to nothing
        keys = keys.join(current, "__k", "left_anti").groupBy("__k").agg(*counts)
    else:      # grouped by the key alone, so that the join needs no shuffle of its own
        keys = keys.groupBy("__k").agg(*counts).join(current, "__k", "left_anti")
    left = frozen(keys, "keys")
    if left.isEmpty():
        return {}
    old = wh.read_expired(REPORT_LAYER, table, REPORT[table], load).select(F.col(key).alias("__k"))
    return left.join(old, "__k", "left_anti").agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in ("final", "pending")]).first().asDict()


def check_all(wh: Warehouse, load: int) -> dict[str, dict[str, int]]:
    """The invariants of the whole star schema as of a load, from all of its rows: table -> check -> failures."""
    dims = {t: read_table(wh.spark, wh.root, REPORT_LAYER, t, load, wh) for t in DIMENSIONS}
    fact = read_table(wh.spark, wh.root, REPORT_LAYER, FACT, load, wh)
    checks = [(t, dq_checks(dims[t], DIMENSIONS[t][0], DIMENSIONS[t][1], varchar=_limits(t))) for t in DIMENSIONS]
    checks.append((FACT, dq_star(fact, dims["dim_products"], dims["dim_customers"])))
    return dict(in_threads(lambda c: (c[0], {r["check_name"]: r["failed"] for r in c[1].collect()}), checks, 3))


def _check_dimension(wh, table, load, before, seen) -> tuple[dict, dict]:
    key, surrogate, *_ = DIMENSIONS[table]
    names = [n.removeprefix("closed_") for n in seen if n.startswith("closed_")]
    keep = {f"closed_{n}": before.get(f"closed_{n}", 0) + seen[f"closed_{n}"] for n in names}
    found = {n: keep[f"closed_{n}"] + seen[f"open_{n}"] for n in names if n != "rows"}
    own, top = _written(wh, table, load), before.get("key_max")
    found["one_active_per_key"] = _repeated(own, key)
    if top is None or (seen["new_min"] is not None and seen["new_min"] <= top):      # first load, or keys were given again
        every = wh.read_history(REPORT_LAYER, table, REPORT[table], load)
        found["surrogate_unique"] = _copies(every, surrogate)
    else:      # older keys are as unique as they were
        found["surrogate_unique"] = before["copies"] + _copies(own.filter(F.col(surrogate) > top), surrogate)
    ends = [x for x in (before.get("key_min"), seen["key_min"], before.get("key_max"), seen["key_max"]) if x is not None]
    rows = keep["closed_rows"] + seen["open_rows"]
    found["surrogate_dense"] = max(ends) - min(ends) + 1 - rows if ends else 0
    return found, keep | {"copies": found["surrogate_unique"]} | ({"key_min": min(ends), "key_max": max(ends)} if ends else {})


def _check_fact(wh, load, before, seen, current) -> tuple[dict, dict]:
    keep = {f"closed_{n}": before.get(f"closed_{n}", 0) + seen[f"closed_{n}"] for n in _FACT_ROW_CHECKS}
    found = {n: keep[f"closed_{n}"] + seen[f"open_{n}"] for n in _FACT_ROW_CHECKS}
    found["product_fan_out"] = _repeated(_written(wh, "dim_products", load), "product_number")
    names = {t: f"fact_{DIMENSIONS[t][1]}_in_dim" for t in DIMENSIONS}
    if any(before.get(f"closed_{n}") for n in names.values()):      # keys that were missing may have been given since
        every = check_all(wh, load)[FACT]
        missing = {t: {"final": every[n]} for t, n in names.items()}
    else:
        missing = dict(zip(names, in_threads(lambda t: _missing_keys(wh, load, DIMENSIONS[t][1], t, current[t]), names, 2)))
    for table, name in names.items():
        keep[f"closed_{name}"] = missing[table].get("final", 0)
        found[name] = keep[f"closed_{name}"] + missing[table].get("pending", 0)
    return found, keep


def check_load(wh: Warehouse, load: int, prev: int | None, counters: dict[str, dict], records: list) -> dict[str, dict[str, int]]:
    """The star schema's invariants after a load, equal to ``check_all``, as one record per check: from the
    counters of the previous load, those of this load's writes, and the rows that it wrote itself.
    Stores the counters for the next load."""
    before = stored_counters(wh, prev)

    def one(table):
        t0 = time.perf_counter()
        found, keep = (_check_fact(wh, load, before[table], counters[table], {t: counters[t]["open_rows"] for t in DIMENSIONS}) if table == FACT
                       else _check_dimension(wh, table, load, before[table], counters[table]))
        _record(records, table, "check", time.perf_counter() - t0, found)
        return table, found, keep

    done = in_threads(one, (*DIMENSIONS, FACT), 3)
    rows = [(t, n, int(v)) for t, _, keep in done for n, v in keep.items()]
    wh.write_snapshot(CHECK_LAYER, "counters", wh.spark.createDataFrame(rows, _COUNTER).coalesce(1), load)
    return {t: found for t, found, _ in done}


def run_batch(spark: SparkSession, root: str, batch_root: str, batch: str, load: int,
              load_ts, safe: bool = True, allow_rejects: bool = False, commit: bool = True,
              on_failure: str | None = None) -> DataFrame:
    """One complete load of one batch folder; returns the load audit
    (``table_name, step, action, rows, seconds``): rows read and rejected, inserted,
    unchanged and expired per table, invalid dates, fact rows that wait for a
    dimension row, and the failures of each check.  ``commit=False`` leaves the load invisible.

    A check that fails (but for those in ``ADVISORY``) raises ``FailedChecks`` before the commit;
    ``on_failure="report"`` only counts it, as does a load by the rules as written (``safe=False``).
    Of several attempts at one load number one commits; the others raise ``AlreadyCommitted``."""
    on_failure = on_failure or ("raise" if safe else "report")
    if on_failure not in ("raise", "report"):
        raise ValueError(f"unknown handling of failed checks: {on_failure!r}")
    wh = Warehouse(spark, root, own=load).init()
    prev = wh.latest()
    if prev is not None and prev >= load:
        raise ValueError(f"load {load} is not after the last committed load {prev}")
    records: list = []
    with scratch_owner(spark, "load"):
        months = load_stg0(wh, batch_root, batch, load, records, allow_rejects=allow_rejects)
        months, new_sales = load_stage(wh, load, prev, load_ts, months, safe, records)
        counters = load_report(wh, load, prev, load_ts, months, safe, records, new_sales)
        found = check_load(wh, load, prev, counters, records)
    failed = {f"{t}.{c}": n for t, checks in found.items() for c, n in checks.items() if n and c not in ADVISORY}
    if failed and on_failure == "raise":
        raise FailedChecks(f"load {load} is not committed: {failed}")
    if commit:
        wh.commit(load, load_ts)
    return audit_rows(spark, records)


def read_table(spark: SparkSession, root: str, layer: str, table: str,
               load: int | None = None, wh: Warehouse | None = None) -> DataFrame:
    """The state of one warehouse table as of a committed load."""
    wh = wh or Warehouse(spark, root)
    load = wh.latest() if load is None else load
    if layer == RAW_LAYER:
        return read_raw(wh, table, load)
    if table == SALES:
        return read_sales(wh, load)
    if table == FACT:
        return conform(read_fact(wh, load, "final").unionByName(read_fact(wh, load, "pending")), REPORT[FACT])
    return wh.read_history(layer, table, STAGE[table] if layer == STAGE_LAYER else REPORT[table], load)
