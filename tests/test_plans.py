"""Physical-plan checks: the plans we want at scale, not just right answers."""

import datetime as dt

from pyspark.sql import functions as F

from histdim.operators import dedupe, history, joins, star


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_bad_joins(p):
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_top1_is_limited_before_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), "id")
    p = plan(dedupe.latest_per_key(df, "k", [F.col("id").desc()]))
    # partial limit sits below the exchange, final above it
    assert p.index("Exchange") < p.rindex("Partial")
    assert "Final" in p


def test_merge_is_one_full_outer_join_and_history_skips_it(spark):
    tgt = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v"),
                                  F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz")
                                  .alias("dwh_create_date"),
                                  F.when(F.col("id") % 5 == 0, "I").otherwise("A").alias("is_current"),
                                  F.lit(None).cast("date").alias("modified_dt"))
    src = spark.range(50, 150).select(F.col("id").cast("int").alias("id"), F.lit("y").alias("v"))
    p = plan(history.scd2_merge(tgt, src, "id", dt.datetime(2024, 1, 1)))
    assert p.count("FullOuter") == 1
    assert "Generate inline" in p
    no_bad_joins(p)


def test_anti_joins_and_lookups_are_equi_joins(spark):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    b = spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    for df in (joins.new_keys_only(a, b, "k"), joins.append_new_exact(a, b),
               joins.append_new_exact(a, b, null_safe=True),
               joins.append_new_keyed(a, b, {"v": 0}, ["k"])):
        p = plan(df)
        assert "LeftAnti" in p
        no_bad_joins(p)
    no_bad_joins(plan(joins.lookup(a, b.select(F.col("k").alias("rk"), "v"), "k", "rk")))


def test_fact_load_plan(spark):
    sales = spark.range(2000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("sls_ord_num"),
        F.concat(F.lit("P"), (F.col("id") % 50).cast("string")).alias("sls_prd_key"),
        (F.col("id") % 70).cast("int").alias("sls_cust_id"),
        F.lit(dt.date(2020, 1, 1)).alias("sls_order_dt"), F.lit(dt.date(2020, 1, 2)).alias("sls_ship_dt"),
        F.lit(dt.date(2020, 1, 3)).alias("sls_due_dt"), F.lit(10).alias("sls_sales"),
        F.lit(1).alias("sls_quantity"), F.lit(10).alias("sls_price"))
    dp = spark.range(50).select((F.col("id") + 1).cast("int").alias("product_key"),
                                F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_number"),
                                F.lit("A").alias("is_current"))
    dc = spark.range(70).select((F.col("id") + 1).cast("int").alias("customer_key"),
                                F.col("id").cast("int").alias("customer_id"), F.lit("A").alias("is_current"))
    fact = spark.createDataFrame([], "order_number string, product_key int, customer_key int, order_date date")
    for match in ("surrogate", "business"):
        p = plan(star.load_fact(sales, dp, dc, fact, dt.datetime(2024, 1, 1), match=match))
        assert "LeftAnti" in p
        no_bad_joins(p)


def test_no_python_udfs_in_cleaning(spark):
    from histdim.plans.cleaning import clean_az12, clean_customers, clean_locations
    from histdim.sources.schemas import RAW
    for fn, t in ((clean_customers, "crm_cust_info"), (clean_locations, "erp_loc_a101")):
        p = plan(fn(spark.createDataFrame([], RAW[t])))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    p = plan(clean_az12(spark.createDataFrame([], RAW["erp_cust_az12"]), dt.datetime(2024, 1, 1)))
    assert "Python" not in p
