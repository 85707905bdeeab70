"""Registered queries: one per operator, each run over the benchmark tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Inputs are the
benchmark tables or data Spark derives from them (:mod:`histdim.plans.derived`),
so the work grows with the tables.  Timestamps are returned as dates.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.functions import clean
from histdim.operators import audit, dedupe, history, joins, keys, star
from histdim.plans import derived
from histdim.plans.derived import SQL
from histdim.session import frozen, scratch_path
from histdim.sources import files
from histdim.sources.schemas import FACT_STORED, RAW

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LOAD_TS = dt.datetime(2024, 1, 1)
LOAD_TS_2 = dt.datetime(2024, 1, 2)


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def d(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_tables(spark, sf_dir)
    return spark.sql(SQL[name])


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dates(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in cols})


# --- sources -----------------------------------------------------------------

def q_read_delimited(spark, sf):
    register_tables(spark, sf)
    src = spark.sql("""
        SELECT c_custkey, c_name,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE ' ' || c_mktsegment END AS seg,
               c_nationkey AS nk, DATE '2020-01-01' + CAST(c_custkey % 300 AS INT) AS d
        FROM customer""")
    csv_dir, pq_dir = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    files.write_delimited(src, csv_dir)
    back = files.read_delimited(spark, csv_dir, src.schema)
    files.full_reload(back, pq_dir)
    return spark.read.parquet(pq_dir)


def _messy_customers(spark, sf):
    """A raw file in which some lines have too few or too many fields, a word for
    a number or an impossible date, and some dates have a time part."""
    register_tables(spark, sf)
    path = scratch_path(spark, "messy")
    lines = spark.sql(derived.SQL["customer_lines"]).select(F.col("line").alias("id,name,day,at"))
    lines.write.options(header="true", sep="\u0001", quote="", escape="").csv(path)
    return path, T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                               T.StructField("day", T.DateType()), T.StructField("at", T.TimestampNTZType())])


def q_read_delimited_rejects(spark, sf):
    path, schema = _messy_customers(spark, sf)
    good = files.read_delimited(spark, path, schema, rejects="drop").select(
        F.lit("row").alias("kind"), F.concat_ws(
            "|", F.col("id").cast("string"), "name", F.col("day").cast("string"),
            F.date_format("at", "yyyy-MM-dd HH:mm:ss")).alias("content"))
    bad = files.read_rejects(spark, path, schema).select(
        F.col("reason").alias("kind"), F.col("line").alias("content"))
    return good.unionByName(bad)


def q_append_rows(spark, sf):
    path = scratch_path(spark, "append")
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name")
    files.append_rows(s, path)
    files.append_rows(s.filter(F.col("s_suppkey") % 2 == 0), path)
    return spark.read.schema(s.schema).parquet(path)


def q_read_batch(spark, sf):
    root = scratch_path(spark, "batches")
    register_tables(spark, sf)
    for b in ("batch1", "batch2"):
        base = """SELECT CAST(c_custkey AS INT) AS cst_id, 'AW' || CAST(c_custkey AS STRING) AS cst_key,
                  ' ' || c_name AS cst_firstname, {last} AS cst_lastname,
                  CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN ' m ' ELSE NULL END AS cst_marital_status,
                  CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'm' ELSE NULL END AS cst_gndr,
                  {date} AS cst_create_date FROM customer"""
        day = "DATE '2020-01-01' + CAST(c_custkey % 365 AS INT)"
        sql = base.format(
            last="c_mktsegment" if b == "batch1" else
            "CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '_X' ELSE c_mktsegment END",
            date=day if b == "batch1" else derived.us_text(day))
        files.write_delimited(spark.sql(sql), files.batch_path(root, b, "crm_cust_info"))
    return files.read_batch(spark, root, "batch2", "crm_cust_info", with_batch=True)


def q_parse_mixed_date(spark, sf):
    df = d(spark, sf, "orders_mixed_dates")
    return df.select("o_orderkey", "raw_date", clean.parse_mixed_date("raw_date").alias("order_date"))


def q_load_defaults(spark, sf):
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return _dates(history.with_load_defaults(s, LOAD_TS), "dwh_create_date")


# --- filters / windows / dedupe ----------------------------------------------

def q_require_key(spark, sf):
    return dedupe.require_key(d(spark, sf, "orders_null_keys"), "o_orderkey")


def q_latest_per_key(spark, sf):
    ev = t(spark, sf, "events")
    top = dedupe.latest_per_key(ev, "user_id", [F.col("ts").desc(), "event_id"])
    return top.select("user_id", "event_id", "event_type", F.col("ts").cast("date").alias("event_date"))


def q_flag_latest(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                      F.col("o_orderdate").cast("date").alias("order_date"))
    return dedupe.flag_latest(o, "o_custkey", [F.col("order_date").desc(),
                                               F.col("o_orderkey").desc()])


def _order_versions(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                         F.col("o_orderdate").cast("date").alias("start_date"))


def q_derive_end_date(spark, sf):
    return dedupe.derive_end_date(_order_versions(spark, sf), "o_custkey", "start_date",
                                  end_col="end_date", order_extra=["o_orderkey"])


def q_flag_open(spark, sf):
    return dedupe.flag_open(_order_versions(spark, sf), "o_custkey", "start_date",
                            order_extra=["o_orderkey"])


#: Rows a key may have before it is laid out over all partitions, low enough for these tables to have such keys.
HOT_ROWS = 50


def q_flag_latest_hot_key(spark, sf):
    return dedupe.flag_latest(d(spark, sf, "orders_hot_key"), "custkey", [F.col("start_date").desc()], hot_rows=HOT_ROWS)


def q_derive_end_date_hot_key(spark, sf):
    return dedupe.derive_end_date(d(spark, sf, "orders_hot_key"), "custkey", "start_date", flag_col="is_current",
                                  hot_rows=HOT_ROWS)


def q_exact_dedupe(spark, sf):
    return dedupe.exact_dedupe(d(spark, sf, "lineitem_flags"))


# --- cleaning expressions ------------------------------------------------------

def q_decode_codes(spark, sf):
    df = d(spark, sf, "orders_line_codes")
    return df.select("o_orderkey", "prd_line",
                     clean.decode_codes("prd_line", clean.PRODUCT_LINE).alias("product_line"))


def q_decode_aliases(spark, sf):
    df = d(spark, sf, "lineitem_genders")
    return df.select("l_orderkey", "l_linenumber", "gen",
                     clean.decode_aliases("gen", clean.GENDER_ALIASES).alias("gender"))


def q_normalize_country(spark, sf):
    df = d(spark, sf, "customer_countries")
    return df.select("c_custkey", "cntry", clean.normalize_country("cntry").alias("country"))


def q_trim_columns(spark, sf):
    return clean.trim_columns(d(spark, sf, "part_padded"), ["p_name", "p_brand"])


def q_split_compound_key(spark, sf):
    df = d(spark, sf, "customer_compound_keys")
    cat, key = clean.split_compound_key("prd_key")
    return df.select("c_custkey", cat.alias("cat_id"), key.alias("prd_key"))


def q_strip_prefix(spark, sf):
    df = d(spark, sf, "customer_prefixed_ids")
    return df.select("c_custkey", clean.strip_prefix("cid").alias("cid"))


def q_remove_chars(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", clean.remove_chars("o_orderpriority").alias("priority"))


def q_parse_packed_date(spark, sf):
    df = d(spark, sf, "orders_packed_dates")
    return df.select("o_orderkey", "sls_order_dt",
                     clean.parse_packed_date("sls_order_dt").alias("order_date"))


def q_null_future_dates(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     clean.null_future_dates("l_shipdate", dt.datetime(1999, 1, 1))
                     .cast("date").alias("ship_date"))


def q_repair_amounts(spark, sf):
    df = d(spark, sf, "lineitem_amounts")
    sales, price = clean.repair_amounts("sls_sales", "sls_quantity", "sls_price")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "sls_quantity",
                     "sls_sales", "sls_price",
                     sales.cast("int").alias("sales"), price.cast("int").alias("price"))


def q_null_default(spark, sf):
    df = d(spark, sf, "part_null_sizes")
    return df.select("p_partkey", clean.null_default("p_size", 0).alias("p_size"))


def q_reconcile(spark, sf):
    df = d(spark, sf, "customer_genders")
    return df.select("c_custkey", clean.reconcile("cst_gndr", "gen").alias("gender"))


# --- conformed sources ----------------------------------------------------------

def _conform(spark, sf, current_only):
    out = star.conform_customers(d(spark, sf, "stage_customers"), d(spark, sf, "stage_az12"),
                                 d(spark, sf, "stage_locations"), current_only=current_only)
    return out


def q_conform_customers(spark, sf):
    return _conform(spark, sf, True)


def q_conform_customers_all_versions(spark, sf):
    return _conform(spark, sf, False)


def q_enrich_products(spark, sf):
    return star.enrich_products(d(spark, sf, "stage_products"), d(spark, sf, "stage_categories"))


def q_enrich_products_all_versions(spark, sf):
    return star.enrich_products(d(spark, sf, "stage_products"), d(spark, sf, "stage_categories"),
                                current_only=False)


# --- change detection and history -------------------------------------------------

PEOPLE_COMPARE = [("first_name", "first_name"), ("last_name", "last_name"),
                  ("nation", "nation"), ("birthdate", "birthdate")]


def q_changed_rows(spark, sf):
    return history.detect_changes(d(spark, sf, "src_people"), d(spark, sf, "dim_people"),
                                  "customer_id", "customer_id", PEOPLE_COMPARE)


def q_changed_rows_null_safe(spark, sf):
    return history.detect_changes(d(spark, sf, "src_people"), d(spark, sf, "dim_people"),
                                  "customer_id", "customer_id", PEOPLE_COMPARE, mode="null_safe")


def _merge_inputs(spark, sf):
    return d(spark, sf, "merge_target"), d(spark, sf, "merge_source")


def q_scd2_merge(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _dates(history.scd2_merge(tgt, src, "cst_id", LOAD_TS), "dwh_create_date")


def q_scd2_merge_dirty_target(spark, sf):
    out = history.scd2_merge(d(spark, sf, "merge_target_dirty"), d(spark, sf, "merge_source"),
                             "cst_id", LOAD_TS)
    return _dates(out, "dwh_create_date")


def q_scd2_merge_null_flag(spark, sf):
    out = history.scd2_merge(d(spark, sf, "merge_target_null_flag"), d(spark, sf, "merge_source"),
                             "cst_id", LOAD_TS)
    return _dates(out, "dwh_create_date")


def q_expire_changed(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _dates(history.expire_changed(tgt, src, "cst_id", LOAD_TS), "dwh_create_date")


def q_insert_unmatched(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _dates(history.insert_unmatched(tgt, src, "cst_id", LOAD_TS), "dwh_create_date")


def q_insert_new_version(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _dates(history.insert_new_version(tgt, src, "cst_id", LOAD_TS), "dwh_create_date")


def q_load_audit(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    tagged = history.scd2_merge(tgt, src, "cst_id", LOAD_TS, with_action=True)
    return audit.load_audit(tagged, "customers")


def q_dq_checks(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    merged = history.scd2_merge(tgt, src, "cst_id", LOAD_TS)
    return audit.dq_checks(merged, "cst_id", varchar={"cst_name": 17})


def q_scd2_dim_load(spark, sf):
    out = history.scd2_dim_load(d(spark, sf, "dim_parts"), d(spark, sf, "src_parts"),
                                "product_id", "product_key", LOAD_TS,
                                ["product_name", "brand", "size"])
    return _dates(out, "dwh_create_date")


def q_scd2_dim_load_dirty(spark, sf):
    out = history.scd2_dim_load(d(spark, sf, "dim_parts_dirty"), d(spark, sf, "src_parts"),
                                "product_id", "product_key", LOAD_TS,
                                ["product_name", "brand", "size"])
    return _dates(out, "dwh_create_date")


def q_scd2_dim_load_null_flag(spark, sf):
    out = history.scd2_dim_load(d(spark, sf, "dim_parts_null_flag"), d(spark, sf, "src_parts"),
                                "product_id", "product_key", LOAD_TS,
                                ["product_name", "brand", "size"])
    return _dates(out, "dwh_create_date")


def q_assign_surrogate_keys(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                      F.col("o_orderdate").cast("date").alias("order_date"))
    return keys.assign_surrogate_keys(o, "sk", ["order_date", "o_orderkey"], start=1000)


# --- set differences ----------------------------------------------------------------

def q_append_new_exact(spark, sf):
    return joins.append_new_exact(d(spark, sf, "lineitem_rows"), d(spark, sf, "lineitem_rows_loaded"))


def q_append_new_exact_null_safe(spark, sf):
    return joins.append_new_exact(d(spark, sf, "lineitem_rows"),
                                  d(spark, sf, "lineitem_rows_loaded"), null_safe=True)


def q_new_keys_only(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.new_keys_only(c, c.filter(F.col("c_custkey") % 3 == 0), "c_custkey")


def q_append_new_keyed(spark, sf):
    return joins.append_new_keyed(d(spark, sf, "orders_keyed"), d(spark, sf, "orders_keyed_loaded"),
                                  defaulted={"o_custkey": 0}, exact=["o_orderkey", "order_date"])


# --- sales stage and fact ------------------------------------------------------------

def q_load_sales_stage(spark, sf):
    raw = d(spark, sf, "sales_raw_dup")
    target = frozen(star.clean_sales(d(spark, sf, "sales_raw")).filter(F.col("sls_cust_id") % 5 == 0),
                    "sales-stage")
    return _dates(star.load_sales_stage(raw, target, LOAD_TS), "dwh_create_date")


def _fact_inputs(spark, sf):
    fact = d(spark, sf, "fact_existing")
    return (d(spark, sf, "sales_stage"), d(spark, sf, "fact_dim_products"),
            d(spark, sf, "fact_dim_customers"), fact)


def q_load_fact(spark, sf):
    s, p, c, f = _fact_inputs(spark, sf)
    return _dates(star.load_fact(s, p, c, f, LOAD_TS), "dwh_create_date")


def q_load_fact_business(spark, sf):
    s, p, c, f = _fact_inputs(spark, sf)
    return _dates(star.load_fact(s, p, c, f, LOAD_TS, match="business"), "dwh_create_date")


def q_load_fact_late_dimension(spark, sf):
    """Two loads; a part of the products and customers arrives with the second."""
    sales, dp, dc = (d(spark, sf, n) for n in ("sales_stage", "fact_dim_products", "fact_dim_customers"))
    late_p = F.expr("substring(product_number, 2) % 7 = 3")
    late_c = F.col("customer_id") % 5 == 2
    none = spark.createDataFrame([], FACT_STORED)
    first = frozen(star.load_fact_incremental(
        sales.filter("sls_quantity % 3 <> 0"), none, none, dp.filter(~late_p), dc.filter(~late_c), LOAD_TS), "fact")
    second = star.load_fact_incremental(sales, first.filter(star.is_pending()), first.filter(~star.is_pending()),
                                        dp, dc, LOAD_TS_2)
    return _dates(first.filter(~star.is_pending()).unionByName(second), "dwh_create_date")


def q_dq_star(spark, sf):
    s, p, c, _ = _fact_inputs(spark, sf)
    fact = star.stage_fact_rows(s, p, c)
    return audit.dq_star(fact, p.filter(F.col("product_key") % 10 != 0), c)


# --- end to end ---------------------------------------------------------------------

def write_batches(spark, sf) -> str:
    """The raw files of both batches."""
    register_tables(spark, sf)
    batches = scratch_path(spark, "raw-batches")
    files_each = spark.sparkContext.defaultParallelism      # the narrow tables are few splits, and a compressed file is read by one task

    def write(table):
        at = [files.batch_path(batches, f"batch{b}", table) for b in (1, 2)]
        one, two = (derived.batch_sql(table, b) for b in (1, 2))
        spread = (lambda rows: rows) if table == "crm_sales_details" else (lambda rows: rows.repartition(files_each))
        files.write_delimited(spread(spark.sql(one)), at[0], compression="gzip")
        if two != one and two.startswith(one):      # the first batch's lines and more: they are taken from its files
            view = f"{table}_batch1"
            files.read_delimited(spark, at[0], RAW[table]).createOrReplaceTempView(view)
            two = f"SELECT * FROM {view}" + two.removeprefix(one)
        files.write_delimited(spread(spark.sql(two)), at[1], compression="gzip")

    with ThreadPoolExecutor(max_workers=6) as ex:   # independent small writes
        list(ex.map(write, RAW))
    return batches


def _two_batches(spark, sf, safe=True, abort=False):
    """(warehouse, audit of the second batch) after both batches.  ``abort``: the
    second one is first run as load 2 and given up before its commit, then as load 3."""
    from histdim.plans.pipeline import run_batch
    batches, root = write_batches(spark, sf), scratch_path(spark, "warehouse")
    run_batch(spark, root, batches, "batch1", 1, LOAD_TS, safe=safe)
    if abort:
        run_batch(spark, root, batches, "batch2", 2, LOAD_TS_2 - dt.timedelta(hours=12), safe=safe, commit=False)
    audit_of = run_batch(spark, root, batches, "batch2", 3 if abort else 2, LOAD_TS_2, safe=safe)
    return root, audit_of


def _after_two_batches(spark, sf, layer, table, **options):
    from histdim.plans.pipeline import read_table
    return _dates(read_table(spark, _two_batches(spark, sf, **options)[0], layer, table), "dwh_create_date")


def q_pipeline_two_batches(spark, sf):
    return _dates(_after_two_batches(spark, sf, "report", "dim_customers"), "create_date")


def q_pipeline_stage_products(spark, sf):
    return _after_two_batches(spark, sf, "stage", "crm_prod_info")


def q_pipeline_dim_products(spark, sf):
    return _after_two_batches(spark, sf, "report", "dim_products")


def q_pipeline_fact_sales(spark, sf):
    return _after_two_batches(spark, sf, "report", "fact_sales")


def q_pipeline_after_abort(spark, sf):
    return _after_two_batches(spark, sf, "report", "fact_sales", abort=True)


def q_pipeline_as_written(spark, sf):
    return _after_two_batches(spark, sf, "stage", "crm_sales_details", safe=False)


def q_pipeline_audit(spark, sf):
    """What the second load did to the sales and product tables."""
    return (_two_batches(spark, sf)[1].filter("step <> 'check'")
            .filter(F.col("table_name").isin("crm_sales_details", "crm_prod_info", "dim_products", "fact_sales"))
            .select("table_name", "step", "action", "rows"))


def q_pipeline_checks(spark, sf):
    """The incremental checks of three loads, of which the third repeats the second's batch."""
    from histdim.plans.pipeline import run_batch
    batches, root = write_batches(spark, sf), scratch_path(spark, "warehouse")
    audits = [run_batch(spark, root, batches, f"batch{b}", n, LOAD_TS + dt.timedelta(days=n - 1)).withColumn("load", F.lit(n))
              for n, b in ((1, 1), (2, 2), (3, 2))]
    every = audits[0].unionByName(audits[1]).unionByName(audits[2])
    return every.filter("step = 'check'").select("load", "table_name", F.col("action").alias("check_name"), F.col("rows").alias("failed"))


def q_pipeline_compacted_history(spark, sf):
    """Expired products at each of three loads, read after their directories were merged into one."""
    from histdim.plans.pipeline import run_batch
    from histdim.sources.schemas import REPORT
    from histdim.sources.store import Warehouse
    batches, root = write_batches(spark, sf), scratch_path(spark, "warehouse")
    for n, b in ((1, 1), (2, 2), (3, 1)):
        run_batch(spark, root, batches, f"batch{b}", n, LOAD_TS + dt.timedelta(days=n - 1))
    wh = Warehouse(spark, root)
    wh.compact("report", "dim_products", REPORT["dim_products"])
    at = [wh.read_history("report", "dim_products", REPORT["dim_products"], n).filter("is_current = 'I'").withColumn("load", F.lit(n))
          for n in (1, 2, 3)]
    return _dates(at[0].unionByName(at[1]).unionByName(at[2]), "dwh_create_date").drop("is_current")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items())
           if name.startswith("q_") and callable(fn)}
