"""Declared table schemas of the three warehouse layers (raw, stage, report).

Raw (layer 0) schemas are positional: CSV header names are ignored and fields
are mapped by position.  History tables carry three bookkeeping columns:
``dwh_create_date`` (load time), ``is_current`` ('A' active / 'I' inactive)
and ``modified_dt`` (day the row was expired).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    """Fields are ``(name, type)`` or ``(name, type, nullable)``."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True)
                         for f in fields])


HISTORY_FIELDS = (("dwh_create_date", TS), ("is_current", S, False), ("modified_dt", D))
ACTIVE, INACTIVE = "A", "I"

# --- layer 0: raw files ---------------------------------------------------
RAW = {
    "crm_cust_info": _schema(("cst_id", I), ("cst_key", S), ("cst_firstname", S),
                             ("cst_lastname", S), ("cst_marital_status", S),
                             ("cst_gndr", S), ("cst_create_date", D)),
    # the two product dates arrive in more than one text format; they are
    # read as strings and parsed by ``parse_mixed_date``
    "crm_prod_info": _schema(("prd_id", I), ("prd_key", S), ("prd_nm", S), ("prd_cost", I),
                             ("prd_line", S), ("prd_start_dt", TS), ("prd_end_dt", TS)),
    "crm_sales_details": _schema(("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", I),
                                 ("sls_order_dt", I), ("sls_ship_dt", I), ("sls_due_dt", I),
                                 ("sls_sales", I), ("sls_quantity", I), ("sls_price", I)),
    "erp_loc_a101": _schema(("cid", S), ("cntry", S)),
    "erp_cust_az12": _schema(("cid", S), ("bdate", D), ("gen", S)),
    "erp_px_cat_g1v2": _schema(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

# file name of each raw source inside a batch folder: (system folder, file)
RAW_FILES = {
    "crm_cust_info": ("source_crm", "cust_info.csv"),
    "crm_prod_info": ("source_crm", "prd_info.csv"),
    "crm_sales_details": ("source_crm", "sales_details.csv"),
    "erp_loc_a101": ("source_erp", "LOC_A101.csv"),
    "erp_cust_az12": ("source_erp", "CUST_AZ12.csv"),
    "erp_px_cat_g1v2": ("source_erp", "PX_CAT_G1V2.csv"),
}

# --- stage: cleaned history ----------------------------------------------
STAGE = {
    "crm_cust_info": _schema(("cst_id", I), ("cst_key", S), ("cst_firstname", S),
                             ("cst_lastname", S), ("cst_marital_status", S), ("cst_gndr", S),
                             ("cst_create_date", D), *HISTORY_FIELDS),
    "crm_prod_info": _schema(("prd_id", I), ("cat_id", S), ("prd_key", S), ("prd_nm", S),
                             ("prd_cost", I), ("prd_line", S), ("prd_start_dt", D),
                             ("prd_end_dt", D), *HISTORY_FIELDS),
    "crm_sales_details": _schema(("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", I),
                                 ("sls_order_dt", D), ("sls_ship_dt", D), ("sls_due_dt", D),
                                 ("sls_sales", I), ("sls_quantity", I), ("sls_price", I),
                                 ("dwh_create_date", TS)),
    "erp_loc_a101": _schema(("cid", S), ("cntry", S), *HISTORY_FIELDS),
    "erp_cust_az12": _schema(("cid", S), ("bdate", D), ("gen", S), *HISTORY_FIELDS),
    "erp_px_cat_g1v2": _schema(("id", S), ("cat", S), ("subcat", S), ("maintenance", S),
                               *HISTORY_FIELDS),
}

# business key of each stage table (None = insert-only)
STAGE_KEYS = {
    "crm_cust_info": ["cst_id"],
    "crm_prod_info": ["prd_id"],
    "crm_sales_details": None,
    "erp_loc_a101": ["cid"],
    "erp_cust_az12": ["cid"],
    "erp_px_cat_g1v2": ["id"],
}

# --- report: star schema --------------------------------------------------
REPORT = {
    "dim_customers": _schema(("customer_key", I, False), ("customer_id", I),
                             ("customer_number", S), ("first_name", S), ("last_name", S),
                             ("country", S), ("marital_status", S), ("gender", S),
                             ("birthdate", D), ("create_date", TS), *HISTORY_FIELDS),
    "dim_products": _schema(("product_key", I, False), ("product_id", I), ("product_number", S),
                            ("product_name", S), ("category_id", S), ("category", S),
                            ("subcategory", S), ("maintenance", S), ("cost", I),
                            ("product_line", S), ("start_date", D), *HISTORY_FIELDS),
    "fact_sales": _schema(("order_number", S), ("product_key", I), ("customer_key", I),
                          ("order_date", D), ("shipping_date", D), ("due_date", D),
                          ("sales_amount", I), ("quantity", I), ("price", I),
                          ("dwh_create_date", TS)),
}

# how the report's fact is stored: with the business ids it is matched on
FACT_STORED = _schema(("product_number", S), ("customer_id", I), *[
    (f.name, f.dataType) for f in REPORT["fact_sales"].fields])

# declared lengths of strings, which Spark does not bound: VARCHAR(50) everywhere but here
VARCHAR = 50
LENGTHS = {"is_current": 1, "category_id": 10}


def lengths(schema: T.StructType) -> dict[str, int]:
    """Declared length of each string column of a table."""
    return {f.name: LENGTHS.get(f.name, VARCHAR) for f in schema.fields if isinstance(f.dataType, T.StringType)}


def violation(schema: T.StructType, not_null=()):
    """Why a row may not be stored in a table of this schema, or NULL: its declared NOT NULLs
    (and the columns in ``not_null``) and the lengths of its strings, as one expression."""
    from pyspark.sql import functions as F
    found = F.lit(None).cast("string")
    for name, most in reversed(lengths(schema).items()):
        found = F.when(F.length(name) > most, F.lit(f"length of {name}")).otherwise(found)
    for f in reversed(schema.fields):
        if not f.nullable or f.name in not_null:
            found = F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is null")).otherwise(found)
    return found


def enforced(df, schema: T.StructType, table: str, not_null=()):
    """``df``, failing the query at a row that violates the table's declaration, as an
    insert into the declared table would."""
    from pyspark.sql import functions as F
    why = violation(schema, not_null)
    fails = F.raise_error(F.concat(F.lit(f"{table}: "), why)).cast("boolean")
    return df.filter(F.when(why.isNull(), F.lit(True)).otherwise(fails))


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to a declared schema (implicit casts on insert)."""
    from pyspark.sql import functions as F
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
