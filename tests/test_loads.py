"""Loads: incremental checks and their gate, one commit per load number, compaction, counts of the writes themselves."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from histdim.operators.history import scd2_merge
from histdim.plans import pipeline
from histdim.plans.pipeline import (ADVISORY, DIMENSIONS, FACT, FailedChecks, check_all, check_load, read_table,
                                    run_batch)
from histdim.session import frozen, in_threads, scratch_owner, scratch_path
from histdim.sources.files import split_delimited
from histdim.sources.schemas import RAW, REPORT, STAGE, enforced, violation
from histdim.sources.store import AlreadyCommitted, MissingData, Warehouse
from test_pipeline import B1, _batch2, _write

DAY = [dt.datetime(2024, 1, d) for d in range(1, 9)]
SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("is_current", T.StringType())])


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """Three loads: batch 1, batch 2, batch 1 again, the last two with one load time."""
    raw, root = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("wh"))
    late = {k: list(v) for k, v in _batch2().items()}
    late["crm_sales_details"] += ["SO7,W9,1,20200101,20200105,20200110,10,2,6"]      # waits for a product; an odd amount
    _write(raw, "batch1", B1)
    _write(raw, "batch2", late)
    audits = [run_batch(spark, root, str(raw), b, n, DAY[min(n, 2) - 1]) for n, b in ((1, "batch1"), (2, "batch2"), (3, "batch1"))]
    return str(raw), root, audits


def failures(audit):
    out = {}
    for r in audit.filter("step = 'check'").collect():
        out.setdefault(r.table_name, {})[r.action] = r.rows
    return out


def test_incremental_checks_equal_the_full_ones(spark, loads):
    _, root, audits = loads
    wh = Warehouse(spark, root)
    for n, audit in enumerate(audits, start=1):
        assert failures(audit) == check_all(wh, n)
    assert failures(audits[1])[FACT]["unresolved_product_key"] > 0      # some check counts something


def test_a_load_is_checked_by_its_own_rows(spark, loads, monkeypatch):
    """What check_load reads of the star schema are directories of its own load."""
    raw, root, _ = loads
    seen = []
    read = Warehouse.read_parts

    def spy(self, layer, table, schema, which, part=None):
        seen.append((layer, table, tuple(which), part))
        return read(self, layer, table, schema, which, part)

    kept = {}
    monkeypatch.setattr(pipeline, "check_load", lambda wh, load, prev, counters, records: kept.update(
        args=(wh, load, prev, counters)) or {})
    run_batch(spark, root, raw, "batch2", 9, DAY[5], commit=False)
    wh, load, prev, counters = kept["args"]
    monkeypatch.setattr(Warehouse, "read_parts", spy)
    found = check_load(wh, load, prev, counters, [])
    monkeypatch.undo()
    assert {(t, w) for layer, t, w, _ in seen if layer == "report"} == {(t, (9,)) for t in (*DIMENSIONS, FACT)}
    assert {p for layer, t, _, p in seen if t in DIMENSIONS} == {"is_current=A"}
    assert found == check_all(wh, 9)


def test_a_failing_check_blocks_the_commit(spark, tmp_path, monkeypatch):
    _write(tmp_path / "raw", "b1", B1)
    root = str(tmp_path / "wh")
    real = pipeline.scd2_dim_load

    def twice(dim, source, key, surrogate, *a, **b):
        out = real(dim, source, key, surrogate, *a, **b)
        return out.unionAll(out.limit(1)) if surrogate == "customer_key" else out

    monkeypatch.setattr(pipeline, "scd2_dim_load", twice)
    with pytest.raises(FailedChecks, match="surrogate_unique"):
        run_batch(spark, root, str(tmp_path / "raw"), "b1", 1, DAY[0])
    assert Warehouse(spark, root).latest() is None
    audit = run_batch(spark, root, str(tmp_path / "raw"), "b1", 1, DAY[0], on_failure="report")
    found = failures(audit)["dim_customers"]
    assert found == check_all(Warehouse(spark, root), 1)["dim_customers"]
    assert (found["surrogate_unique"], found["one_active_per_key"], found["surrogate_dense"]) == (1, 1, -1)
    monkeypatch.undo()
    with pytest.raises(FailedChecks):      # the fault is still there in the next load
        run_batch(spark, root, str(tmp_path / "raw"), "b1", 2, DAY[1])
    with pytest.raises(ValueError, match="unknown handling"):
        run_batch(spark, root, str(tmp_path / "raw"), "b1", 2, DAY[1], on_failure="ignore")
    assert "sales_amount" in ADVISORY


def test_counts_come_from_the_write_and_not_from_load_times(spark, loads):
    """Loads 2 and 3 have one load time; each counts its own rows."""
    _, root, audits = loads
    stage = [{(r.table_name, r.action): r.rows for r in a.filter("step in ('stage', 'report')").collect()} for a in audits]
    assert stage[1]["crm_prod_info", "inserted"] == stage[1]["crm_prod_info", "expired"] == 2
    assert stage[2]["crm_prod_info", "inserted"] == stage[2]["crm_prod_info", "expired"] == 2
    assert stage[2]["crm_prod_info", "unchanged"] == 3 and stage[2]["crm_sales_details", "inserted"] == 0
    assert stage[1]["fact_sales", "inserted"] == 1 and stage[1]["fact_sales", "pending"] >= 1


def test_of_two_attempts_at_one_load_one_commits(spark, loads, tmp_path):
    raw, root = loads[0], str(tmp_path / "wh")
    out = {}
    together = threading.Barrier(2)
    commit = Warehouse.commit

    def at_once(self, *a):
        together.wait(timeout=300)      # both have done all their work
        return commit(self, *a)

    def attempt(n):
        try:
            run_batch(spark, root, raw, "batch1" if n else "batch2", 1, DAY[0])
            out[n] = "committed"
        except AlreadyCommitted:
            out[n] = "refused"

    Warehouse.commit = at_once
    try:
        both = [threading.Thread(target=attempt, args=(n,)) for n in (0, 1)]
        [t.start() for t in both]
        [t.join() for t in both]
    finally:
        Warehouse.commit = commit
    assert sorted(out.values()) == ["committed", "refused"]
    prices = {r.prd_cost for r in read_table(spark, root, "stage", "crm_prod_info").filter("prd_id = 106").collect()}
    assert prices == ({13} if out[1] == "committed" else {15})
    assert Warehouse(spark, root).committed() == [1]


def test_compaction_changes_no_state(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), own=None).init()
    for n in range(1, 8):
        w = Warehouse(spark, wh.root)
        w.write_history("s", "t", spark.createDataFrame([(100 + n, "A")] + [(n * 10 + i, "I") for i in range(n % 3)], SCHEMA), n)
        w.commit(n, DAY[0])
    at = lambda: [rows(Warehouse(spark, wh.root).read_history("s", "t", SCHEMA, n)) for n in range(1, 8)]
    before = at()
    Warehouse(spark, wh.root).compact("s", "t", SCHEMA, upto=4)
    assert at() == before
    Warehouse(spark, wh.root).compact("s", "t", SCHEMA)      # takes the first one in
    assert at() == before
    last = Warehouse(spark, wh.root)
    files = last.read_expired("s", "t", SCHEMA, 7).inputFiles()
    assert len(files) == 1 and "compact=1-7" in files[0]
    last.write_history("s", "t", spark.createDataFrame([(1, "A"), (2, "I")], SCHEMA), 8)
    last.commit(8, DAY[1])
    assert rows(Warehouse(spark, wh.root).read_history("s", "t", SCHEMA, 8)) == sorted(
        [(1, "A"), (2, "I")] + [r for r in before[-1] if r[1] == "I"])
    assert at() == before


def test_many_loads_are_read_without_asking_for_each_directory(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh")).init()
    wh.write_history("s", "t", spark.createDataFrame([(1, "A")], SCHEMA), 1)
    wh.commit(1, DAY[0])
    folder = f"{wh.root}/_commits"
    for n in range(2, 1001):      # loads that expired nothing
        with open(f"{folder}/load={n}.json", "w") as f:
            f.write(json.dumps({"kind": "load", "load": n, "run": "x", "tables": {"s/t": ["is_current=A"]}}))
    calls = []
    hadoop = Warehouse._hadoop
    monkeypatch.setattr(Warehouse, "_hadoop", lambda self, path: calls.append(path) or hadoop(self, path))
    fresh = Warehouse(spark, wh.root)
    assert len(fresh.committed()) == 1000 and fresh.read_expired("s", "t", SCHEMA, 1000).count() == 0
    assert calls == []


def test_data_that_is_gone_is_an_error(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh")).init()
    wh.write_history("s", "t", spark.createDataFrame([(1, "A")], SCHEMA), 1)
    wh.commit(1, DAY[0])
    os.rename(f"{wh.root}/s/t/load=1", f"{wh.root}/s/t/moved")
    with pytest.raises(MissingData):
        Warehouse(spark, wh.root).read_history("s", "t", SCHEMA, 1).count()


def test_declared_constraints(spark):
    schema = STAGE["crm_cust_info"]
    row = lambda **k: {f.name: None for f in schema.fields} | {"cst_id": 1, "is_current": "A"} | k
    df = spark.createDataFrame([row(), row(is_current=None), row(cst_key="x" * 51), row(cst_id=None), row(is_current="AA"), row(cst_key="x" * 50)],
                               T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
    why = [r.w for r in df.select(violation(schema, ["cst_id"]).alias("w")).collect()]
    assert why == [None, "is_current is null", "length of cst_key", "cst_id is null", "length of is_current", None]
    assert enforced(df.filter("is_current = 'A' AND length(coalesce(cst_key, '')) < 51"), schema, "t").count() == 3
    with pytest.raises(Exception, match="t: (is_current is null|length of)"):
        enforced(df, schema, "t").collect()
    for tables in (RAW, STAGE, REPORT):
        for s in tables.values():
            assert spark.createDataFrame([], s).select(violation(s)).count() == 0


def test_one_parse_of_good_and_rejected_lines(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"ID,CAT,SUBCAT,MAINTENANCE\r\nA,b,c,d\r\nB,b,c\r\n" + b"C," + b"x" * 51 + b",c,d\r\n")
    lines = split_delimited(spark, str(tmp_path / "f.csv"), RAW["erp_px_cat_g1v2"])
    assert rows(lines, "id", "rejected", "reason", "line") == [
        ("A", False, None, None), ("B", True, "number of fields", "B,b,c"),
        ("C", True, "length of cat", "C," + "x" * 51 + ",c,d")]
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_a_load_leaves_no_scratch_data(spark, loads):
    raw, root, _ = loads
    base = os.path.join(spark.conf.get("spark.checkpoint.dir"), "histdim-scratch")
    before = set(os.listdir(base))      # the folder may be shared with other sessions
    run_batch(spark, root, raw, "batch2", 8, DAY[5], commit=False)
    assert set(os.listdir(base)) == before


def test_scratch_owner(spark):
    outside = frozen(spark.range(3), "kept")
    with pytest.raises(KeyError), scratch_owner(spark, "mine") as path:
        inner = in_threads(lambda n: frozen(spark.range(n), "x").count(), [4, 5])
        assert inner == [4, 5] and len(os.listdir(path)) == 2 and scratch_path(spark, "y").startswith(path)
        raise KeyError
    assert not os.path.exists(path) and outside.count() == 3 and "mine" not in scratch_path(spark, "y")


def test_empty_sources_load(spark, tmp_path):
    _write(tmp_path / "raw", "b0", {k: v[:1] for k, v in B1.items()})
    _write(tmp_path / "raw", "b1", B1)
    root = str(tmp_path / "wh")
    assert set(failures(run_batch(spark, root, str(tmp_path / "raw"), "b0", 1, DAY[0]))[FACT].values()) == {0}
    run_batch(spark, root, str(tmp_path / "raw"), "b1", 2, DAY[1])
    assert read_table(spark, root, "report", "dim_customers").filter(F.col("is_current") == "A").count() == 3
    assert read_table(spark, root, "report", FACT, 1).count() == 0


def _exchanges_over(plan: str, scan: str) -> int:
    """Exchanges between a scan and the first join above it, by the plan's tree."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-*(0123456789)")), 0
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if d < depth:
            depth = d
            if "Join" in line:
                break
            found += "Exchange" in line
    return found


def test_a_merge_shuffles_its_source_alone(spark, tmp_path):
    schema = STAGE["erp_loc_a101"]
    first = spark.range(2000).select(F.concat(F.lit("K"), "id").alias("cid"), F.lit("DE").alias("cntry"),
                                     F.lit(DAY[0]).cast("timestamp_ntz").alias("dwh_create_date"), F.lit("A").alias("is_current"),
                                     F.lit(None).cast("date").alias("modified_dt"))
    source = spark.range(1000, 3000).select(F.concat(F.lit("K"), "id").alias("cid"), F.when(F.col("id") % 3 == 0, "US").otherwise("DE").alias("cntry"))
    tables = {t.name for t in spark.catalog.listTables()}
    results = []
    for keys in (None, ["cid"]):
        wh = Warehouse(spark, str(tmp_path / f"wh{len(results)}")).init()
        wh.write_history("s", "t", first, 1, keys)
        wh.commit(1, DAY[0])
        active = Warehouse(spark, wh.root).read_history("s", "t", schema, 1, active_only=True)
        merged = scd2_merge(active, source, "cid", DAY[1], null_keys=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert (_exchanges_over(plan, "FileScan parquet") == 0) == bool(keys) and ("Bucketed: true" in plan) == bool(keys)
        results.append(rows(merged))
    assert results[0] == results[1] and len(results[0]) == 3000 + 333
    assert {t.name for t in spark.catalog.listTables()} == tables
    whole = Warehouse(spark, wh.root).read_history("s", "t", schema, 1)
    assert rows(whole) == rows(first.select(*whole.columns)) and active.schema.names == schema.names


def test_buckets_that_are_gone_are_an_error(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh")).init()
    wh.write_history("s", "t", spark.createDataFrame([(1, "A")], SCHEMA), 1, ["k"])
    wh.commit(1, DAY[0])
    os.rename(f"{wh.root}/s/t/load=1", f"{wh.root}/s/t/moved")
    with pytest.raises(MissingData):
        Warehouse(spark, wh.root).read_history("s", "t", SCHEMA, 1).count()
