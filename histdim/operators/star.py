"""Star-schema building blocks: conformed sources, sales staging, fact load.

All lookups go through :func:`histdim.operators.joins.lookup` (AQE decides
broadcast from measured sizes and splits hot keys, NULL keys among them).  The
tables joined here (customers, products) grow with the data, so nothing is
broadcast by hint.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.functions.clean import load_time, parse_packed_date, reconcile, repair_amounts
from histdim.operators.dedupe import current_rows, exact_dedupe, open_rows
from histdim.operators.history import ACTION
from histdim.operators.joins import anti_by, append_new_hashed, lookup
from histdim.session import frozen


def conform_customers(ci: DataFrame, az12: DataFrame, loc: DataFrame,
                      current_only: bool = True) -> DataFrame:
    """One row per current CRM customer, enriched with ERP birth date / gender
    and location; gender comes from CRM unless unknown there.

    ``current_only=False`` joins every version of the ERP tables (the
    as-written behaviour, which fans out once they hold history)."""
    c = current_rows(ci)
    a = current_rows(az12) if current_only else az12
    l = current_rows(loc) if current_only else loc
    j = lookup(c, a.select(F.col("cid").alias("__a_cid"), F.col("gen").alias("__gen"),
                           F.col("bdate").alias("bdate")),
               "cst_key", "__a_cid")
    j = lookup(j, l.select(F.col("cid").alias("__l_cid"), "cntry"), "cst_key", "__l_cid")
    return j.select("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cntry",
                    "cst_marital_status",
                    reconcile("cst_gndr", "__gen").alias("gender"),
                    "bdate", "cst_create_date")


def enrich_products(prod: DataFrame, cat: DataFrame, current_only: bool = True) -> DataFrame:
    """Open product versions with their category attributes (NULL when the
    category id is unknown)."""
    p = open_rows(prod, "prd_end_dt")
    if current_only:
        p = current_rows(p)
    c = current_rows(cat) if current_only else cat
    j = lookup(p, c.select(F.col("id").alias("__cat_id"), "cat", "subcat", "maintenance"),
               "cat_id", "__cat_id")
    return j.select("prd_id", "prd_key", "prd_nm", "cat_id", "cat", "subcat", "maintenance",
                    "prd_cost", "prd_line", "prd_start_dt")


SALES_COLS = ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
              "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"]


def clean_sales(raw: DataFrame) -> DataFrame:
    """Packed dates to DATE, amounts repaired (see ``repair_amounts``)."""
    sales, price = repair_amounts("sls_sales", "sls_quantity", "sls_price")
    return raw.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id",
        parse_packed_date("sls_order_dt").alias("sls_order_dt"),
        parse_packed_date("sls_ship_dt").alias("sls_ship_dt"),
        parse_packed_date("sls_due_dt").alias("sls_due_dt"),
        sales.cast("int").alias("sls_sales"),
        F.col("sls_quantity").cast("int").alias("sls_quantity"),
        price.cast("int").alias("sls_price"))


def month_of(day: str):
    """The partition that a dated row belongs to: yyyymm, 0 without a date."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def load_sales_stage(raw: DataFrame, target: DataFrame, load_ts,
                     null_safe: bool = False, slices: int | None = None) -> DataFrame:
    """Rows to append to the insert-only sales stage table: cleaned, exact
    duplicates removed, rows already present (all nine columns equal) left
    out.  Plain ``=`` matching re-admits rows with any NULL on every load;
    ``null_safe=True`` makes the load idempotent.

    The cleaned, de-duplicated rows are frozen first, so the anti join stays
    above the de-duplication and compares columns, not cleaning expressions; rows meet on
    one hash and are then compared in full.

    With ``slices`` both sides are shuffled once instead, by order month and that many slices of order numbers (rows
    without one are spread by their other columns): duplicates are removed and rows compared in one aggregate
    over all nine columns, and a task holds rows of few months, which it may write by month as they are.
    """
    clean = clean_sales(raw)
    if slices is None:
        clean = frozen(exact_dedupe(clean), "sales")
        new = append_new_hashed(clean, target.select(*SALES_COLS), SALES_COLS, null_safe=null_safe)
    else:
        new = _compared_in_slices(clean, target, null_safe, slices)
    return new.withColumn("dwh_create_date", load_time(load_ts))


def _compared_in_slices(clean: DataFrame, target: DataFrame, null_safe: bool, slices: int) -> DataFrame:
    old = target.select(*[F.col(c).cast(clean.schema[c].dataType).alias(c) for c in SALES_COLS])
    rows = clean.withColumn("__old", F.lit(False)).unionByName(old.withColumn("__old", F.lit(True)))
    number = F.when(F.col("sls_ord_num").isNull(), F.hash(*SALES_COLS)).otherwise(F.hash("sls_ord_num"))
    # months follow one another, so that their slices are dealt to the partitions in turn
    month = F.coalesce(F.year("sls_order_dt") * 12 + F.month("sls_order_dt"), F.lit(0))
    tasks = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = F.pmod(month.cast("long") * slices + F.pmod(number, F.lit(slices)), F.lit(tasks)).cast("int")
    met = (rows.withColumn("__by", by).repartitionById(tasks, "__by").groupBy("__by", *SALES_COLS)
           .agg(F.min("__old").alias("__only_old"), F.max("__old").alias("__in_old")))
    new = ~F.col("__in_old")
    if not null_safe:      # a row with a NULL equals none
        new = new | functools.reduce(operator.or_, [F.col(c).isNull() for c in SALES_COLS])
    return met.filter(~F.col("__only_old") & new).select(*SALES_COLS)


FACT_COLS = ["order_number", "product_key", "customer_key", "order_date", "shipping_date",
             "due_date", "sales_amount", "quantity", "price"]


def stage_fact_rows(sales: DataFrame, dim_products: DataFrame,
                    dim_customers: DataFrame, keep_business: bool = False) -> DataFrame:
    """Sales with surrogate keys of the *current* dimension versions,
    de-duplicated (``SELECT DISTINCT``)."""
    p = current_rows(dim_products).select(F.col("product_number").alias("__pn"), "product_key")
    c = current_rows(dim_customers).select(F.col("customer_id").alias("__cid"), "customer_key")
    j = lookup(sales, p, "sls_prd_key", "__pn")
    j = lookup(j, c, "sls_cust_id", "__cid")
    cols = [F.col("sls_ord_num").alias("order_number"), "product_key", "customer_key",
            F.col("sls_order_dt").alias("order_date"), F.col("sls_ship_dt").alias("shipping_date"),
            F.col("sls_due_dt").alias("due_date"), F.col("sls_sales").alias("sales_amount"),
            F.col("sls_quantity").alias("quantity"), F.col("sls_price").alias("price")]
    if keep_business:
        # a sale whose key did not resolve is stored with a NULL key, so it
        # is compared as "unknown" rather than by its business id
        cols += [F.when(F.col("product_key").isNotNull(), F.col("sls_prd_key")).alias("sls_prd_key"),
                 F.when(F.col("customer_key").isNotNull(), F.col("sls_cust_id")).alias("sls_cust_id")]
    return j.select(*cols).distinct()


def load_fact(sales: DataFrame, dim_products: DataFrame, dim_customers: DataFrame,
              fact: DataFrame, load_ts, match: str = "surrogate",
              null_safe: bool = False) -> DataFrame:
    """Fact rows to append.

    ``match="surrogate"``: a staged row is new unless the fact has a row with
    the same order number, order date and (``coalesce(..., 0)``) product and
    customer keys -- a new dimension version therefore makes old sales look
    new.  ``match="business"``: existing fact keys are mapped back to
    product number / customer id over *all* dimension versions and compared
    on those, so loads stay idempotent across dimension changes.
    ``null_safe`` lets a NULL order date match a NULL order date (business
    matching is always NULL-safe).
    """
    if match == "surrogate":
        staged = stage_fact_rows(sales, dim_products, dim_customers)
        new = anti_by(staged, fact, ["order_number", "product_key", "customer_key", "order_date"],
                      null_safe=null_safe,
                      src_exprs=[F.col("order_number"), F.coalesce("product_key", F.lit(0)),
                                 F.coalesce("customer_key", F.lit(0)), F.col("order_date")],
                      tgt_exprs=[F.col("order_number"), F.coalesce("product_key", F.lit(0)),
                                 F.coalesce("customer_key", F.lit(0)), F.col("order_date")])
    elif match == "business":
        staged = stage_fact_rows(sales, dim_products, dim_customers, keep_business=True)
        pk = dim_products.select(F.col("product_key").alias("__pk"),
                                 F.col("product_number").alias("__pn"))
        ck = dim_customers.select(F.col("customer_key").alias("__ck"),
                                  F.col("customer_id").alias("__ci"))
        existing = lookup(lookup(fact, pk, "product_key", "__pk"), ck, "customer_key", "__ck")
        on = ["order_number", "sls_prd_key", "sls_cust_id", "order_date"]
        # business keys compare NULL-safely (a sale of an unknown product is
        # the same sale on every load)
        new = anti_by(staged, existing, on, null_safe=True,
                      tgt_exprs=[F.col("order_number"), F.col("__pn"), F.col("__ci"),
                                 F.col("order_date")])
        # rows that differed only in their business keys collapse, as in
        # the surrogate-key staging
        new = new.select(*FACT_COLS).distinct()
    else:
        raise ValueError(f"unknown match {match!r}")
    return new.select(*FACT_COLS).withColumn("dwh_create_date",
                                             load_time(load_ts))


FACT_STORED = ["product_number", "customer_id", *FACT_COLS, "dwh_create_date"]


def is_pending():
    """A fact row that waits for a dimension row: a business id without a key."""
    return ((F.col("product_key").isNull() & F.col("product_number").isNotNull())
            | (F.col("customer_key").isNull() & F.col("customer_id").isNotNull()))


def sales_as_fact(sales: DataFrame) -> DataFrame:
    """Staged sales under the fact's names, with business ids for keys."""
    names = dict(zip(SALES_COLS, ["order_number", "product_number", "customer_id", "order_date",
                                  "shipping_date", "due_date", "sales_amount", "quantity", "price"]))
    return sales.select(*[F.col(c).alias(n) for c, n in names.items()])


def load_fact_incremental(sales: DataFrame, pending: DataFrame, fact: DataFrame,
                          dim_products: DataFrame, dim_customers: DataFrame, load_ts,
                          with_action: bool = False, unique_sales: bool = False, few_sales: bool = False) -> DataFrame:
    """The fact rows that a load settles (columns ``FACT_STORED``; ``with_action``: and whether the
    row is one of ``pending`` or ``inserted``).

    ``sales``: the sales staged by this load.  ``pending``: the fact rows that were
    still without a key after the last load.  ``fact``: the settled rows that
    may hold the same sales (their business ids are stored with them, so no dimension
    is needed to compare; pass the batch's order months only).  A sale is
    new if neither has its order number, business ids and order date (NULL equals NULL).
    A key that is missing is looked up among the current dimension versions; a pending
    row keeps the key that it has and its ``dwh_create_date``.  What ``is_pending`` selects of
    the result replaces ``pending``; the rest is appended.

    ``unique_sales`` says that no two of ``sales`` are alike, which spares a shuffle; ``few_sales`` that
    they are few enough to be broadcast, so that only fact rows that may hold them are shuffled.
    """
    on = ["order_number", "product_number", "customer_id", "order_date"]
    new = sales_as_fact(sales)
    new = new if unique_sales else new.distinct()
    known = fact.select(*on).unionByName(pending.select(*on))
    if few_sales:
        named = F.broadcast(new.select(*[F.col(c).alias(f"__n_{c}") for c in on]).distinct())
        known = known.join(named, functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"__n_{c}")) for c in on]), "left_semi")
    new = anti_by(new, known, on, null_safe=True)
    p = current_rows(dim_products).select(F.col("product_number").alias("__pn"), F.col("product_key").alias("__pk"))
    c = current_rows(dim_customers).select(F.col("customer_id").alias("__cid"), F.col("customer_key").alias("__ck"))
    # apart, so that the shuffled rows of a large load hold nothing but what was staged
    new = lookup(lookup(new, p, "product_number", "__pn"), c, "customer_id", "__cid")
    new = new.withColumnsRenamed({"__pk": "product_key", "__ck": "customer_key"})
    new = new.withColumns({"dwh_create_date": load_time(load_ts), ACTION: F.lit("inserted")})
    no_p, no_c = F.col("product_key").isNull(), F.col("customer_key").isNull()      # only what is missing is looked up
    old = (pending.join(p, no_p & (F.col("product_number") == F.col("__pn")), "left")
           .join(c, no_c & (F.col("customer_id") == F.col("__cid")), "left")
           .withColumns({"product_key": F.coalesce("product_key", "__pk"), "customer_key": F.coalesce("customer_key", "__ck"),
                         ACTION: F.lit("pending")}))
    keyed = new.select(*FACT_STORED, ACTION).unionByName(old.select(*FACT_STORED, ACTION))
    return keyed.select(*FACT_STORED, *([ACTION] if with_action else []))
