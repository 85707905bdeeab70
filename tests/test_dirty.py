"""Dirty inputs: several active rows per key, repeated source keys, hot keys, odd types."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from histdim.operators import dedupe, history, joins, star
from histdim.sources.files import read_delimited, read_rejects, write_delimited

DAY = dt.datetime(2024, 1, 1)
OLD = dt.datetime(2023, 1, 1)
HISTORY = "id int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date"


def test_merge_emits_one_version_per_key(spark):
    rnd = random.Random(1)
    target = [(k, rnd.choice("abc"), OLD, "A", None) for k in range(40) for _ in range(rnd.randrange(4))]
    source = [(k, rnd.choice("abc")) for k in range(45) if k % 7]
    out = history.scd2_merge(spark.createDataFrame(target, HISTORY), spark.createDataFrame(source, "id int, v string"),
                             "id", DAY)
    want = []
    new = dict(source)
    for k, v, *_ in target:
        gone = k in new and new[k] != v
        want.append((k, v, OLD, "I" if gone else "A", DAY.date() if gone else None))
    for k, v in source:
        if not any(a == k and b == v for a, b, *_ in target):
            want.append((k, v, DAY, "A", None))
    assert rows(out) == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_dimension_load_emits_one_version_per_key(spark):
    dim = spark.createDataFrame(
        [(1, 10, "a", OLD, "A", None), (2, 10, "b", OLD, "A", None), (3, 20, "x", OLD, "A", None),
         (4, 20, "y", OLD, "A", None)],
        "sk int, bid int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date")
    src = spark.createDataFrame([(10, "b"), (20, "z")], "bid int, v string")
    out = history.scd2_dim_load(dim, src, "bid", "sk", DAY, ["v"])
    assert rows(out, "sk", "bid", "v", "is_current") == [
        (1, 10, "a", "I"), (2, 10, "b", "A"), (3, 20, "x", "I"), (4, 20, "y", "I"), (5, 20, "z", "A")]
    assert rows(history.detect_changes(src, dim, "bid", "bid", [("v", "v")])) == [(20, "z")]


def test_repeated_source_keys_are_reported(spark):
    target = spark.createDataFrame([(1, "a", OLD, "A", None)], HISTORY)
    twice = spark.createDataFrame([(1, "b"), (1, "c"), (None, "x"), (None, "y")], "id int, v string")
    with pytest.raises(Exception, match="several source rows for one key"):
        history.scd2_merge(target, twice, "id", DAY).collect()
    assert history.scd2_merge(target, twice.filter("id is null"), "id", DAY).count() == 3


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ordered_windows_do_not_depend_on_exchange_reuse(spark, reuse):
    # many keys, one hot; a column that can't be ordered; ties that only the hidden columns break
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 9001).alias("k"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7 % 900).cast("int")).alias("d"),
        "id", F.create_map(F.lit("m"), "id").alias("m"), F.col("id").cast("string").alias("s"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = df.select("k").distinct().count()
        latest = dedupe.flag_latest(df, "k", [F.col("d").desc()], tie_break=False)
        assert latest.filter("is_current = 'A'").count() == n and latest.count() == 60000
        named = dedupe.flag_latest(df, "k", [F.col("s").desc(), F.col("d").desc_nulls_first()])
        w = Window.partitionBy("k").orderBy(F.col("s").desc())
        first = df.withColumn("r", F.row_number().over(w)).filter("r = 1").select("k", "id")
        assert rows(named.filter("is_current = 'A'").select("k", "id")) == rows(first)
        assert dedupe.flag_open(df, "k", "d").filter("is_current = 'A'").count() == n
        ends = dedupe.derive_end_date(df, "k", "d", order_extra=["id"]).select("id", "end_date")
        want = df.select("id", F.date_sub(F.lead("d").over(Window.partitionBy("k").orderBy("d", "id")), 1).alias("end_date"))
        assert ends.exceptAll(want).count() == 0 and want.exceptAll(ends).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_ordered_windows_shuffle_rows_once(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plan = dedupe.flag_latest(df, "k", [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(k" in plan


def test_layout_spreads_rows_alike_over_all_partitions(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    laid = dedupe.ordered_layout(df, [F.col("k").asc(), F.col("v").desc()], num_partitions=8)
    sizes = [r["count"] for r in laid.groupBy("__p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000
    latest = dedupe.flag_latest(df, "k", [F.col("v").desc()], hot_rows=1000)
    assert latest.filter("is_current = 'A'").count() == 1 and latest.count() == 20000


@pytest.mark.parametrize("hot_rows", [0, 40, 10**6])
def test_hot_keys_are_ordered_alike_by_layout_and_by_window(spark, hot_rows):
    rnd = random.Random(4)
    data = [(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice(["x", "y", None]), rnd.choice([None, dt.date(2020, 1, rnd.randrange(1, 20))]), i)
            for i in range(400)]
    df = spark.createDataFrame(data, "k int, g string, d date, id int").repartition(3)
    w = Window.partitionBy("k", "g")
    want = df.select("id", F.when(F.row_number().over(w.orderBy(F.col("d").desc(), F.col("id"))) == 1, "A").otherwise("I").alias("f"),
                     F.date_sub(F.lead("d").over(w.orderBy("d", "id")), 1).alias("e"))
    got = dedupe.flag_latest(df, ["k", "g"], [F.col("d").desc(), "id"], flag_col="f", hot_rows=hot_rows).select("id", "f")
    ends = dedupe.derive_end_date(df, ["k", "g"], "d", end_col="e", order_extra=["id"], hot_rows=hot_rows).select("id", "e")
    assert rows(got.join(ends, "id")) == rows(want)


def test_rows_without_a_flag_are_kept(spark):
    target = [(1, "a", OLD, "A", None), (2, "b", OLD, None, None), (3, "c", OLD, "I", OLD.date()), (2, "z", OLD, "A", None)]
    src = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    out = history.scd2_merge(spark.createDataFrame(target, HISTORY), src, "id", DAY)
    assert rows(out, "id", "v", "is_current") == [(1, "a", "I"), (1, "x", "A"), (2, "b", None), (2, "y", "A"), (2, "z", "I"), (3, "c", "I")]
    dim = spark.createDataFrame([(1, 10, "a", OLD, "A", None), (2, 20, "b", OLD, None, None)],
                                "sk int, bid int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date")
    out = history.scd2_dim_load(dim, spark.createDataFrame([(10, "n"), (20, "m"), (30, "o")], "bid int, v string"), "bid", "sk", DAY, ["v"])
    assert rows(out, "sk", "bid", "v", "is_current") == [(1, 10, "a", "I"), (2, 20, "b", None), (3, 10, "n", "A"), (4, 30, "o", "A")]


def test_sales_stage_compares_rows_above_the_deduplication(spark):
    raw = spark.createDataFrame([("O1", "P", 1, 20200101, 20200101, 20200101, 10, 2, 5)] * 3 + [("O2", "P", 1, 0, 0, 0, 10, 2, 5)],
                                "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, sls_ship_dt int, "
                                "sls_due_dt int, sls_sales int, sls_quantity int, sls_price int")
    target = star.clean_sales(raw).limit(0)
    out = star.load_sales_stage(raw, target, DAY)
    assert rows(out, "sls_ord_num") == [("O1",), ("O2",)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "year(" not in plan       # the frozen rows meet the target
    loaded = star.clean_sales(raw).distinct()
    assert rows(star.load_sales_stage(raw, loaded, DAY), "sls_ord_num") == [("O2",)]
    assert rows(star.load_sales_stage(raw, loaded, DAY, null_safe=True)) == []
    assert rows(joins.append_new_hashed(loaded, loaded.limit(0), loaded.columns)) == rows(loaded)


def test_source_of_a_dimension_is_computed_once(spark):
    dim = spark.createDataFrame([(1, 10, "a", OLD, "A", None)],
                                "sk int, bid int, v string, dwh_create_date timestamp_ntz, is_current string, modified_dt date")
    src = spark.range(50).select(F.col("id").cast("int").alias("bid"), F.lit("b").alias("v"))
    plan = history.scd2_dim_load(dim, src, "bid", "sk", DAY, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 50" not in plan


TEXT = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("d", T.DateType()),
                     T.StructField("ts", T.TimestampNTZType())])


def test_delimited_rejects_and_times(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"id,d,ts\r\n1,2020-01-02 10:00:00,1/2/2020 10:11:12\r\nX2,2020-01-02,\r\n3,2020-01-02\r\n"
                                     b"4,2020-01-02,,9\r\n5,2020-99-02,\r\n,,\r\n")
    path = str(tmp_path / "f.csv")
    good = read_delimited(spark, path, TEXT, rejects="drop")
    assert rows(good) == [(None, None, None), (1, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 10, 11, 12))]
    assert rows(read_rejects(spark, path, TEXT)) == [
        ("number of fields", "3,2020-01-02"), ("number of fields", "4,2020-01-02,,9"),
        ("value of d", "5,2020-99-02,"), ("value of id", "X2,2020-01-02,")]
    with pytest.raises(Exception, match="rejected"):
        read_delimited(spark, path, TEXT).collect()
    write_delimited(good, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), TEXT)) == rows(good)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from histdim import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("S", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())
