import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from histdim.operators import dedupe, history, joins, keys, star
from histdim.operators.audit import dq_checks, dq_fact_keys, load_audit

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_latest_per_key_tie_break_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), "b"), (1, dt.date(2020, 1, 1), "a"), (1, None, "z"),
         (2, None, "x"), (None, dt.date(2021, 1, 1), "n")], "k int, d date, v string")
    got = rows(dedupe.latest_per_key(df, "k", [F.col("d").desc()]))
    # DESC puts NULL dates last; equal dates fall back to the other columns
    assert got == [(None, dt.date(2021, 1, 1), "n"), (1, dt.date(2020, 1, 1), "a"), (2, None, "x")]


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.latest_per_key(df, "k", [F.col("id").desc()])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.fixture
def skewed(spark):
    # one key holds a third of all rows; dates repeat to force tie-breaks
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).alias("k"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 50).cast("int")).alias("d"),
        F.col("id"))


def test_flag_latest_matches_window(spark, skewed):
    got = dedupe.flag_latest(skewed, "k", [F.col("d").desc(), F.col("id").desc()])
    w = Window.partitionBy("k").orderBy(F.col("d").desc(), F.col("id").desc())
    ref = skewed.withColumn("is_current", F.when(F.row_number().over(w) == 1, "A").otherwise("I"))
    assert rows(got, "k", "d", "id", "is_current") == rows(ref, "k", "d", "id", "is_current")


def test_derive_end_date_and_flag_open_match_lead(spark, skewed):
    got = dedupe.derive_end_date(skewed, "k", "d", end_col="e", flag_col="f", order_extra=["id"])
    w = Window.partitionBy("k").orderBy("d", "id")
    end = F.date_sub(F.lead("d").over(w), 1)
    ref = skewed.select("*", end.alias("e"), F.when(end.isNull(), "A").otherwise("I").alias("f"))
    assert rows(got, "k", "d", "id", "e", "f") == rows(ref, "k", "d", "id", "e", "f")
    fo = dedupe.flag_open(skewed, "k", "d", flag_col="f", order_extra=["id"])
    assert rows(fo, "k", "d", "id", "f") == rows(ref, "k", "d", "id", "f")


def test_exact_dedupe_and_filters(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "a")], "k int, v string")
    assert rows(dedupe.exact_dedupe(df)) == [(None, "a"), (1, None), (2, "a")]
    assert rows(dedupe.require_key(df, "k")) == [(1, None), (1, None), (2, "a")]


def test_anti_joins_plain_and_null_safe(spark):
    src = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert rows(joins.append_new_exact(src, tgt)) == [(2, None), (3, "c")]
    assert rows(joins.append_new_exact(src, tgt, null_safe=True)) == [(3, "c")]
    s2 = spark.createDataFrame([(None, "x"), (5, "y"), (6, "z")], "k int, v string")
    t2 = spark.createDataFrame([(5, "old")], "k int, v string")
    assert rows(joins.new_keys_only(s2, t2, "k")) == [(None, "x"), (6, "z")]
    s3 = spark.createDataFrame([(1, None, dt.date(2020, 1, 1)), (2, 7, None), (3, 0, dt.date(2020, 1, 1))],
                               "o int, c int, d date")
    t3 = spark.createDataFrame([(1, None, dt.date(2020, 1, 1)), (2, 7, None), (3, None, dt.date(2020, 1, 1))],
                               "o int, c int, d date")
    # NULL custkey defaults to 0 on both sides (and then equals a real 0);
    # a NULL date never matches under plain equality
    assert rows(joins.append_new_keyed(s3, t3, {"c": 0}, ["o", "d"])) == [(2, 7, None)]
    assert rows(joins.append_new_keyed(s3, t3, {"c": 0}, ["o", "d"], null_safe=True)) == []


def test_lookup_routes_null_keys(spark):
    left = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    right = spark.createDataFrame([(1, "one"), (None, "nul")], "rk int, name string")
    assert rows(joins.lookup(left, right, "k", "rk")) == [(None, None), (1, "one"), (2, None)]


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("x"), F.lit("same").alias("s"))
    out = keys.assign_surrogate_keys(df, "sk", ["x"], start=10, num_partitions=5)
    got = rows(out, "x", "sk")
    assert got == [(x, x + 10) for x in range(500)]
    dup = spark.range(300).select(F.lit(1).alias("a"))
    ks = sorted(r.sk for r in keys.assign_surrogate_keys(dup, "sk", ["a"], num_partitions=4).collect())
    assert ks == list(range(1, 301))


def _target(spark):
    return spark.createDataFrame(
        [(1, "a", dt.datetime(2023, 1, 1), "A", None),      # unchanged
         (2, "b", dt.datetime(2023, 1, 1), "A", None),      # changes
         (3, "c", dt.datetime(2023, 1, 1), "A", None),      # absent from source
         (4, "old", dt.datetime(2022, 1, 1), "I", dt.date(2023, 1, 1)),  # history only
         (None, "n", dt.datetime(2023, 1, 1), "A", None)],  # NULL key kept
        "id int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date")


def _source(spark):
    return spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (5, "e"), (None, "z")],
                                 "id int, v string")


def test_scd2_merge_cases(spark):
    out = history.scd2_merge(_target(spark), _source(spark), "id", D1, with_action=True)
    got = rows(out, "id", "v", "is_current", "modified_dt", "_action")
    assert got == [
        (None, "n", "A", None, "untouched"), (None, "z", "A", None, "inserted"),
        (1, "a", "A", None, "unchanged"),
        (2, "B", "A", None, "new_version"), (2, "b", "I", dt.date(2024, 1, 1), "expired"),
        (3, "c", "A", None, "untouched"),
        (4, "d", "A", None, "inserted"), (4, "old", "I", dt.date(2023, 1, 1), "history"),
        (5, "e", "A", None, "inserted")]
    audit = {r.action: r.rows for r in load_audit(out, "t").collect()}
    assert audit == {"untouched": 2, "inserted": 3, "unchanged": 1, "new_version": 1,
                     "expired": 1, "history": 1}
    # branch operators are the tagged slices
    assert rows(history.expire_changed(_target(spark), _source(spark), "id", D1), "id") == [(2,)]
    assert len(rows(history.insert_unmatched(_target(spark), _source(spark), "id", D1))) == 3


def test_scd2_merge_is_idempotent_per_day(spark):
    src = dedupe.require_key(_source(spark), "id")
    once = history.scd2_merge(_target(spark), src, "id", D1)
    twice = history.scd2_merge(once, src, "id", D1)
    assert rows(once) != [] and rows(twice) == rows(once)
    # a NULL key never matches, so such a source row is inserted on every load
    again = history.scd2_merge(once, _source(spark), "id", D1)
    assert len(rows(again)) == len(rows(once)) + 1


def test_scd2_merge_sentinel_vs_null_safe(spark):
    tgt = spark.createDataFrame([(1, None, dt.datetime(2023, 1, 1), "A", None)],
                                "id int, v string, dwh_create_date timestamp_ntz, "
                                "is_current string, modified_dt date")
    src = spark.createDataFrame([(1, "")], "id int, v string")
    assert len(rows(history.scd2_merge(tgt, src, "id", D1))) == 1
    assert len(rows(history.scd2_merge(tgt, src, "id", D1, mode="null_safe"))) == 2


def _dim(spark):
    return spark.createDataFrame(
        [(1, 10, "a", dt.datetime(2023, 1, 1), "A", None),
         (2, 20, "b", dt.datetime(2023, 1, 1), "A", None),
         (3, 30, "c", dt.datetime(2022, 1, 1), "I", dt.date(2023, 1, 1))],
        "sk int, bid int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date")


def test_scd2_dim_load(spark):
    src = spark.createDataFrame([(10, "a"), (20, "B"), (30, "c2"), (50, "e"), (40, "d")],
                                "bid int, v string")
    out = history.scd2_dim_load(_dim(spark), src, "bid", "sk", D1, ["v"])
    got = rows(out, "sk", "bid", "v", "is_current")
    # changed rows get keys first, then new keys in id order; key 30 only has
    # an expired row, so it is not inserted again
    assert got == [(1, 10, "a", "A"), (2, 20, "b", "I"), (3, 30, "c", "I"), (4, 20, "B", "A"),
                   (5, 40, "d", "A"), (6, 50, "e", "A")]
    checks = {r.check_name: r.failed for r in dq_checks(out, "bid", surrogate="sk").collect()}
    assert checks == {"one_active_per_key": 0, "active_iff_open": 0, "flag_domain": 0,
                      "null_key": 0, "surrogate_unique": 0, "surrogate_dense": 0}


def test_load_fact_modes(spark):
    sales = spark.createDataFrame(
        [("O1", "P1", 1, dt.date(2020, 1, 1), 10), ("O2", "PX", 1, None, 5)],
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date, sls_sales int"
    ).select("*", F.col("sls_order_dt").alias("sls_ship_dt"), F.col("sls_order_dt").alias("sls_due_dt"),
             F.lit(1).alias("sls_quantity"), F.col("sls_sales").alias("sls_price"))
    dp = spark.createDataFrame([(1, "P1", "I"), (2, "P1", "A")],
                               "product_key int, product_number string, is_current string")
    dc = spark.createDataFrame([(7, 1, "A")], "customer_key int, customer_id int, is_current string")
    fact = spark.createDataFrame([("O1", 1, 7, dt.date(2020, 1, 1)), ("O2", None, 7, None)],
                                 "order_number string, product_key int, customer_key int, order_date date")
    # surrogate matching: the new product version makes O1 look new; NULL
    # order date never matches
    sur = rows(star.load_fact(sales, dp, dc, fact, D1), "order_number", "product_key")
    assert sur == [("O1", 2), ("O2", None)]
    biz = rows(star.load_fact(sales, dp, dc, fact, D1, match="business"), "order_number")
    assert biz == []
    miss = {r.check_name: r.failed for r in dq_fact_keys(fact, dp, "product_key", "product_key").collect()}
    assert miss == {"fact_product_key_in_dim": 0}
