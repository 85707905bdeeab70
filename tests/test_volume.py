"""What a load moves: shuffles that a plan must not have, and files that a write must not make."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from histdim.functions.clean import parse_packed_date
from histdim.operators import audit, star

from histdim.plans import derived, pipeline, queries
from histdim.plans.pipeline import load_stg0, read_table, run_batch
from histdim.sources import files
from histdim.sources.schemas import FACT_STORED, RAW, REPORT, STAGE
from histdim.sources.store import Warehouse
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)
SALES = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW["crm_sales_details"].fields)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


def _raw(spark, data):
    return spark.createDataFrame([(o, "K1", 7, 20240102, 20240103, 20240104, 10, 2, p) for o, p in data], SALES)


def test_sales_are_shuffled_once_and_compared_there(spark, tmp_path):
    raw = _raw(spark, [("A", 5), ("A", 5), ("B", 5), (None, 5), (None, 5), ("C", None)])
    target = star.load_sales_stage(_raw(spark, [("B", 5), (None, 5), ("D", 5)]), _raw_stage(spark), DAY, slices=1)
    for slices in (None, 1, 3):
        for null_safe, want in ((True, ["A", "C"]), (False, [None, "A", "C"])):
            got = star.load_sales_stage(raw, target, DAY, null_safe, slices)
            assert [r[0] for r in rows(got, "sls_ord_num")] == want
            if slices:
                assert "Join" not in _plan(got)[0]


def test_a_table_without_loads_is_known_to_be_empty(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path)).init()
    old = wh.read_history("stage", "erp_loc_a101", STAGE["erp_loc_a101"], None)
    some = spark.range(3).withColumn("cid", _text("id"))
    assert "Join" not in _plan(some.join(old, "cid", "left_anti"))[0]


def _text(name):
    from pyspark.sql import functions as F
    return F.col(name).cast("string")


def test_few_sales_filter_the_fact_before_it_is_shuffled(spark):
    none = spark.createDataFrame([], FACT_STORED).limit(0)
    p = spark.createDataFrame([("K1", 1, "A")], "product_number string, product_key int, is_current string")
    c = spark.createDataFrame([(7, 1, "A")], "customer_id int, customer_key int, is_current string")
    first = star.load_fact_incremental(star.load_sales_stage(_raw(spark, [("A", 5), (None, 6)]), _raw_stage(spark), DAY), none, none, p, c, DAY)
    both = star.load_sales_stage(_raw(spark, [("A", 5), (None, 6), ("B", 5)]), _raw_stage(spark), DAY)
    for few in (False, True):
        got = star.load_fact_incremental(both, none, first, p, c, DAY, unique_sales=True, few_sales=few)
        assert rows(got, "order_number", "product_key", "customer_key") == [("B", 1, 1)]


def _raw_stage(spark):
    return spark.createDataFrame([], STAGE["crm_sales_details"]).limit(0)





def test_second_batch_is_what_its_sql_says(spark):
    at = queries.write_batches(spark, SF)
    queries.register_tables(spark, SF)
    for b in (1, 2):
        got = files.read_batch(spark, at, f"batch{b}", "crm_sales_details")
        want = spark.sql(derived.batch_sql("crm_sales_details", b)).select(got.columns)
        assert rows(got.select([_text(x) for x in got.columns])) == rows(want.select([_text(x) for x in want.columns]))


def test_a_first_load_writes_a_file_a_bucket(spark):
    at, root = queries.write_batches(spark, SF), queries.scratch_path(spark, "volume")
    run_batch(spark, root, at, "batch1", 1, DAY)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for t in ("dim_customers", "dim_products"):
        found = [f for d, _, fs in os.walk(f"{root.removeprefix('file:')}/report/{t}") for f in fs if f.endswith(".parquet")]
        assert 0 < len(found) <= n
    assert read_table(spark, root, "report", "fact_sales").count() > 0


def test_observed_metrics_compute_nothing_row_by_row(spark):
    df = spark.range(10).withColumn("day", (F.col("id") + 20240100).cast("int"))
    rows_, seen = audit.observed(df, {"bad": audit.rows_where(parse_packed_date("day").isNull()), "most": (F.max, F.col("id") * 2)})
    rows_.write.format("noop").mode("overwrite").save()
    assert audit.counted(seen) == {"bad": 1, "most": 18}
    assert rows_.columns == ["id", "day"]
    node = [line for line in rows_._jdf.queryExecution().optimizedPlan().toString().splitlines() if "CollectMetrics" in line][0]
    assert "make_date" not in node and "* 2" not in node


def test_raw_lines_are_written_without_date_arithmetic(spark, tmp_path, monkeypatch):
    """Beside the parse it made a method too long to be compiled, or was interpreted."""
    plans, write = [], Warehouse.write_parts

    def spy(self, df, layer, table, load, *by):
        if (layer, table) == ("stg0", "crm_sales_details"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, layer, table, load, *by)

    monkeypatch.setattr(Warehouse, "write_parts", spy)
    for t in RAW:
        raw = _raw(spark, [("A", 5), ("B", 5)]).withColumn("sls_order_dt", F.when(F.col("sls_ord_num") == "B", 20241332).otherwise(20240102)) \
            if t == "crm_sales_details" else spark.createDataFrame([], RAW[t])
        files.write_delimited(raw, files.batch_path(str(tmp_path / "raw"), "batch1", t))
    records = []
    months = load_stg0(Warehouse(spark, str(tmp_path / "wh"), own=1).init(), str(tmp_path / "raw"), "batch1", 1, records)
    assert sorted(months) == [0, 202401]
    assert [r["rows"] for r in records if r["action"] == "invalid_dates"] == [1]
    assert len(plans) == 1 and "make_date" not in plans[0]


def test_slices_are_dealt_evenly(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = [(f"O{m}-{i}", "K1", 7, 20200101 + 10000 * (m // 12) + 100 * (m % 12), 20240103, 20240104, 10, 2, 5) for m in range(2 * n) for i in range(5)]
    got = star.load_sales_stage(spark.createDataFrame(days, SALES), _raw_stage(spark), DAY, slices=1)
    per_task = got.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in per_task) == [10] * n


def test_a_narrow_tables_raw_lines_are_several_files(spark):
    at = queries.write_batches(spark, SF)
    for t in ("crm_prod_info", "crm_cust_info"):
        for b in ("batch1", "batch2"):
            found = [f for f in os.listdir(files.batch_path(at, b, t).removeprefix("file:")) if f.startswith("part-")]
            assert len(found) == spark.sparkContext.defaultParallelism


def test_dimensions_of_millions_are_not_sent_through_the_driver(spark, monkeypatch):
    """Counted while they were written; the driver would hold some hundred bytes for each row.  Rows and checks stay the same."""
    at, root = queries.write_batches(spark, SF), queries.scratch_path(spark, "broadcast")
    plans, counted, write, frozen = [], pipeline.counted, Warehouse.write_parts, pipeline.frozen

    def many(seen):
        got = counted(seen)
        return got | {"open_rows": 3_600_000} if "open_rows" in got else got

    def spy(self, df, layer, table, load, *by):
        if table == "fact_sales":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return write(self, df, layer, table, load, *by)

    def spy_keys(df, name):
        if name == "keys":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return frozen(df, name)

    run_batch(spark, f"{root}/few", at, "batch1", 1, DAY)
    want = [r for r in run_batch(spark, f"{root}/few", at, "batch2", 2, DAY).collect() if r["table_name"] == "fact_sales"]
    monkeypatch.setattr(pipeline, "counted", many)
    monkeypatch.setattr(pipeline, "frozen", spy_keys)
    monkeypatch.setattr(Warehouse, "write_parts", spy)
    run_batch(spark, f"{root}/many", at, "batch1", 1, DAY, on_failure="report")
    got = [r for r in run_batch(spark, f"{root}/many", at, "batch2", 2, DAY, on_failure="report").collect() if r["table_name"] == "fact_sales"]
    assert sorted(r[1:4] for r in got) == sorted(r[1:4] for r in want)
    facts = [rows(read_table(spark, f"{root}/{x}", "report", "fact_sales").select(F.to_json(F.struct("*")).alias("row"))) for x in ("few", "many")]
    assert facts[0] == facts[1] and len(facts[0]) > 0
    assert len(plans) == 6
    assert not [p for p in plans if re.search(r"BroadcastHashJoin [^\n]*(LeftOuter|LeftAnti)", p)]


def test_missing_keys_are_counted_by_state_however_they_meet(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path), own=1).init()
    dim = spark.sql("SELECT id AS customer_id, id + 1 AS customer_key, CASE WHEN id = 2 THEN 'I' ELSE 'A' END AS is_current FROM range(3)")
    wh.write_parts(pipeline.conform(dim.select(*[F.col(f.name) if f.name in dim.columns else F.lit(None).alias(f.name)
                                                 for f in REPORT["dim_customers"].fields]), REPORT["dim_customers"]), "report", "dim_customers", 1, "is_current")
    # keys 1 and 2 are current, 3 is an older version's, 9 is nobody's
    fact = spark.createDataFrame([(1, "final"), (9, "final"), (9, "final"), (9, "pending"), (3, "final"), (None, "final")], "customer_key int, state string")
    fact = fact.select(*[F.col("customer_key") if f.name == "customer_key" else F.lit(None).cast(f.dataType).alias(f.name) for f in FACT_STORED.fields],
                       "state", F.lit(0).alias("order_month"))
    wh.write_parts(fact, "report", "fact_sales", 1, "state", "order_month")
    for most in (10, 0):
        monkeypatch.setitem(pipeline.MOST_BROADCAST, "dimension", most)
        assert pipeline._missing_keys(wh, 1, "customer_key", "dim_customers", 2) == {"final": 2, "pending": 1}
