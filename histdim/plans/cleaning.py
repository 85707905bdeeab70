"""Per-table cleaning blocks that turn raw rows into stage-ready sources.

Each returns a DataFrame with at most one row per business key (the input the
Type-2 merge expects), except ``clean_sales`` which feeds an insert-only
table.  ``safe=True`` (pipeline default) also drops NULL business keys for
every table; ``safe=False`` follows the as-written rules (only customers drop
them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.functions.clean import (GENDER, GENDER_ALIASES, MARITAL_STATUS, PRODUCT_LINE,
                                     decode_aliases, decode_codes, normalize_country,
                                     null_default, null_future_dates, remove_chars,
                                     split_compound_key, strip_prefix)
from histdim.operators.dedupe import (current_rows, derive_end_date, latest_per_key,
                                      require_key)
from histdim.operators.star import clean_sales  # noqa: F401  (re-exported)


def clean_customers(raw: DataFrame, safe: bool = True) -> DataFrame:
    df = require_key(raw, "cst_id").select(
        "cst_id", "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        decode_codes("cst_marital_status", MARITAL_STATUS).alias("cst_marital_status"),
        decode_codes("cst_gndr", GENDER).alias("cst_gndr"),
        "cst_create_date")
    # newest record per customer; with a total order the kept row is the one
    # a separate 'A'/'I' flag would mark active
    return latest_per_key(df, "cst_id", [F.col("cst_create_date").desc()])


def clean_products(raw: DataFrame, safe: bool = True) -> DataFrame:
    src = require_key(raw, "prd_id") if safe else raw
    # the end date is derived per *raw* product key, before it is shortened
    versions = derive_end_date(
        src.select("prd_id", F.col("prd_key").alias("__raw_key"), "prd_nm", "prd_cost",
                   "prd_line", F.col("prd_start_dt").cast("date").alias("prd_start_dt")),
        "__raw_key", "prd_start_dt", end_col="prd_end_dt", flag_col="is_current",
        order_extra=["prd_id"])
    cat_id, prd_key = split_compound_key("__raw_key")
    df = current_rows(versions).select(
        "prd_id", cat_id.alias("cat_id"), prd_key.alias("prd_key"), "prd_nm",
        null_default("prd_cost", 0).alias("prd_cost"),
        decode_codes("prd_line", PRODUCT_LINE).alias("prd_line"),
        "prd_start_dt", "prd_end_dt")
    return latest_per_key(df, "prd_id", [F.col("prd_start_dt").desc()])


def clean_az12(raw: DataFrame, load_ts, safe: bool = True) -> DataFrame:
    df = raw.select(strip_prefix("cid").alias("cid"),
                    null_future_dates("bdate", load_ts).cast("date").alias("bdate"),
                    decode_aliases("gen", GENDER_ALIASES).alias("gen"))
    if safe:
        df = require_key(df, "cid")
    return latest_per_key(df, "cid", [F.col("bdate").desc()])


def clean_locations(raw: DataFrame, safe: bool = True) -> DataFrame:
    df = raw.select(remove_chars("cid").alias("cid"), normalize_country("cntry").alias("cntry"))
    if safe:
        df = require_key(df, "cid")
    return latest_per_key(df, "cid", ["cntry"])


def clean_categories(raw: DataFrame, safe: bool = True) -> DataFrame:
    df = raw.select("id", "cat", "subcat", "maintenance")
    if safe:
        df = require_key(df, "id")
    return latest_per_key(df, "id", ["cat"])
