"""The warehouse shows committed loads only, and never loses one silently."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from histdim.plans.pipeline import read_rejected, read_table, run_batch
from histdim.sources.files import RejectedRows
from histdim.sources.store import MissingData, Warehouse
from test_pipeline import B1, _batch2, _write, counts

DAY = [dt.datetime(2024, 1, d) for d in range(1, 6)]
SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("is_current", T.StringType())])


@pytest.fixture(scope="module")
def batches(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    _write(root, "batch1", B1)
    _write(root, "batch2", _batch2())
    bad = {k: list(v) for k, v in B1.items()}
    bad["crm_cust_info"] += ["X9,AW8,A,B,S,F,2020-01-01", "7,AW7"]
    _write(root, "bad", bad)
    return str(root)


def test_aborted_load_run_again_leaves_nothing(spark, batches, tmp_path):
    wh = str(tmp_path / "wh")
    run_batch(spark, wh, batches, "batch1", 1, DAY[0])
    run_batch(spark, wh, batches, "batch2", 2, DAY[1], commit=False)
    run_batch(spark, wh, batches, "batch1", 2, DAY[1])          # corrected source: nothing changed
    assert counts(read_table(spark, wh, "stage", "crm_prod_info")) == {"A": 5}
    assert read_table(spark, wh, "report", "fact_sales").count() == 3


def test_aborted_load_stays_invisible_to_later_loads(spark, batches, tmp_path):
    wh = str(tmp_path / "wh")
    run_batch(spark, wh, batches, "batch1", 1, DAY[0])
    run_batch(spark, wh, batches, "batch2", 2, DAY[1], commit=False)
    assert read_table(spark, wh, "report", "fact_sales").count() == 3
    run_batch(spark, wh, batches, "batch2", 3, DAY[2])
    assert counts(read_table(spark, wh, "stage", "crm_prod_info")) == {"A": 5, "I": 2}
    assert read_table(spark, wh, "stage", "crm_sales_details").count() == 4
    assert read_table(spark, wh, "report", "fact_sales").count() == 4


def test_rejected_lines_fail_the_load_or_are_counted(spark, batches, tmp_path):
    wh = str(tmp_path / "wh")
    with pytest.raises(RejectedRows, match="2 lines"):
        run_batch(spark, wh, batches, "bad", 1, DAY[0])
    assert Warehouse(spark, wh).latest() is None
    audit = {(r.table_name, r.step, r.action): r.rows
             for r in run_batch(spark, wh, batches, "bad", 1, DAY[0], allow_rejects=True).collect()}
    assert audit["crm_cust_info", "raw", "rejected"] == 2 and audit["crm_cust_info", "raw", "read"] == 5
    assert audit["crm_sales_details", "stage", "invalid_dates"] == 1
    assert audit["fact_sales", "report", "inserted"] == 2 and audit["fact_sales", "report", "pending"] == 1
    lines = read_rejected(Warehouse(spark, wh), "crm_cust_info", 1).collect()
    assert sorted(r.reason for r in lines) == ["number of fields", "value of cst_id"]


def test_late_dimension_fills_the_fact_in_place(spark, tmp_path):
    root, wh = tmp_path / "raw", str(tmp_path / "wh")
    one = {k: list(v) for k, v in B1.items()}
    one["crm_sales_details"] += ["SO7,W9,1,20200101,20200105,20200110,10,2,5"]
    two = {k: list(v) for k, v in one.items()}
    two["crm_prod_info"] += ["109,AB-CD-W9,Widget Nine,13,T ,2013-07-01,"]
    _write(root, "b1", one)
    _write(root, "b2", two)
    run_batch(spark, wh, str(root), "b1", 1, DAY[0])
    run_batch(spark, wh, str(root), "b2", 2, DAY[1])
    rows = read_table(spark, wh, "report", "fact_sales").filter("order_number = 'SO7'").collect()
    assert [(r.product_key, r.dwh_create_date) for r in rows] == [(6, DAY[0])]


def test_missing_folder_is_an_error_not_an_empty_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh")).init()
    assert wh.latest() is None and wh.read_history("s", "t", SCHEMA, None).count() == 0
    rows = spark.createDataFrame([(1, "A"), (2, "I")], SCHEMA)
    wh.write_history("s", "t", rows, 1)
    assert Warehouse(spark, wh.root).read_history("s", "t", SCHEMA, 1).count() == 0      # not committed
    wh.commit(1, DAY[0])
    wh.commit(2, DAY[1])
    assert wh.read_history("s", "t", SCHEMA, 1).count() == 2
    with pytest.raises(MissingData):
        wh.read_history("s", "t", SCHEMA, 2)


def test_rerun_drops_partitions_that_it_does_not_write(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), own=1).init()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        wh.write_history("s", "t", spark.createDataFrame([(1, "A"), (2, "I")], SCHEMA), 1)
        wh.write_history("s", "t", spark.createDataFrame([(1, "A")], SCHEMA), 1)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert wh.read_history("s", "t", SCHEMA, 1).count() == 1
