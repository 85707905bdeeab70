"""Golden two-batch run on small hand-made batch folders (CRLF, no quoting,
empty field = NULL; batch 1 dates ISO, batch 2 dates M/d/yyyy)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from histdim.operators.audit import dq_checks, dq_fact_keys
from histdim.plans.pipeline import read_table, run_batch
from histdim.sources.schemas import RAW_FILES

B1 = {
    "crm_cust_info": ["cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date",
                      "1,AW1, Ann , Lee ,S,F,2020-01-01", "1,AW1,Ann,Lee,M,F,2019-01-01",
                      "2,AW2,Bob,Kim, m ,m,2020-02-02", ",AW9,No,Key,S,F,2020-01-01",
                      "3,AW3,Cy,Park,X,,2020-03-03"],
    "erp_cust_az12": ["CID,BDATE,GEN", "NASAW1,1980-01-01,F", "AW2,2030-01-01,male ",
                      "AW3,1990-05-05,"],
    "erp_loc_a101": ["CID,CNTRY", "AW-1,DE", "AW-2,USA", "AW-3, Canada "],
    "crm_prod_info": ["prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt",
                      "101,AB-CD-W1,Widget One,,R ,2003-07-01,",
                      "102,AB-EF-W2,Widget Two,10,S ,2011-07-01,2011-12-31",
                      "103,AB-EF-W2,Widget Two,11,S ,2012-07-01,2012-12-31",
                      "104,AB-EF-W2,Widget Two,12,S ,2013-07-01,",
                      "105,XY-ZZ-W3,Widget Three,20,M ,2013-07-01,",
                      "106,AB-CD-W4,Widget Four,13,T ,2013-07-01,",
                      "107,AB-EF-W5,Widget Five,13,,2013-07-01,"],
    "erp_px_cat_g1v2": ["ID,CAT,SUBCAT,MAINTENANCE", "AB_CD,Alpha,Locks,Yes", "AB_EF,Alpha,Gloves,No",
                        "CD_XX,Gamma,Other,No"],
    "crm_sales_details": ["sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
                          "sls_sales,sls_quantity,sls_price",
                          "SO1,W1,1,20200101,20200105,20200110,10,2,5",
                          "SO2,W4,2,0,20200105,20200110,,1,13",
                          "SO2,W4,2,0,20200105,20200110,,1,13",
                          "SO3,ZZ,9,20101332,20200105,20200110,-5,1,"],
}


def _batch2():
    b = {k: list(v) for k, v in B1.items()}
    b["crm_cust_info"] = [b["crm_cust_info"][0], "1,AW1, Ann , Lee ,S,F,2020-01-01",
                          "2,AW2,Bob,Kimm, m ,m,2020-02-02", "4,AW4,Dee,Fox,M,F,2021-04-04"]
    b["crm_prod_info"] = [b["crm_prod_info"][0]] + [
        r.replace(",13,", ",15,") for r in B1["crm_prod_info"][1:]]
    for i, r in enumerate(b["crm_prod_info"][1:], start=1):   # dates become M/d/yyyy
        parts = r.split(",")
        for j in (5, 6):
            if parts[j]:
                d = dt.date.fromisoformat(parts[j])
                parts[j] = f"{d.month}/{d.day}/{d.year}"
        b["crm_prod_info"][i] = ",".join(parts)
    b["erp_px_cat_g1v2"] = [r.replace("Locks", "Pad Locks") for r in B1["erp_px_cat_g1v2"]]
    b["crm_sales_details"] = B1["crm_sales_details"] + ["SO4,W1,4,20210101,20210105,20210110,5,1,5"]
    return b


def _write(root, batch, data):
    for table, lines in data.items():
        system, name = RAW_FILES[table]
        d = root / batch / system
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_bytes(("\r\n".join(lines) + "\r\n").encode())


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batches")
    _write(root, "batch1", B1)
    _write(root, "batch2", _batch2())
    wh = str(tmp_path_factory.mktemp("warehouse"))
    run_batch(spark, wh, str(root), "batch1", 1, dt.datetime(2024, 1, 1))
    run_batch(spark, wh, str(root), "batch2", 2, dt.datetime(2024, 1, 2))
    run_batch(spark, wh, str(root), "batch2", 3, dt.datetime(2024, 1, 3))   # re-load
    return wh


def counts(df):
    return {r["is_current"]: r["count"] for r in df.groupBy("is_current").count().collect()}


def test_stage_history(spark, warehouse):
    assert counts(read_table(spark, warehouse, "stage", "crm_prod_info", 1)) == {"A": 5}
    assert counts(read_table(spark, warehouse, "stage", "crm_prod_info")) == {"A": 5, "I": 2}
    assert counts(read_table(spark, warehouse, "stage", "erp_px_cat_g1v2")) == {"A": 3, "I": 1}
    cust = read_table(spark, warehouse, "stage", "crm_cust_info")
    assert counts(cust) == {"A": 4, "I": 1}
    one = cust.filter("cst_id = 1").collect()[0]
    assert (one.cst_firstname, one.cst_lastname, one.cst_marital_status, one.cst_gndr) == \
        ("Ann", "Lee", "Single", "Female")
    az = {r.cid: (r.bdate, r.gen) for r in read_table(spark, warehouse, "stage", "erp_cust_az12").collect()}
    assert az == {"AW1": (dt.date(1980, 1, 1), "Female"), "AW2": (None, "Male"), "AW3": (dt.date(1990, 5, 5), "n/a")}
    loc = {r.cid: r.cntry for r in read_table(spark, warehouse, "stage", "erp_loc_a101").collect()}
    assert loc == {"AW1": "Germany", "AW2": "United States", "AW3": "Canada"}


def test_product_cleaning(spark, warehouse):
    p = {r.prd_id: r for r in read_table(spark, warehouse, "stage", "crm_prod_info", 1).collect()}
    assert sorted(p) == [101, 104, 105, 106, 107]          # only the open version per key
    assert (p[101].cat_id, p[101].prd_key, p[101].prd_cost, p[101].prd_line) == ("AB_CD", "W1", 0, "Road")
    assert p[107].prd_line == "n/a" and p[105].prd_line == "Mountain"


def test_report_dimensions(spark, warehouse):
    dp = read_table(spark, warehouse, "report", "dim_products")
    # 106/107 changed cost, 101 and 106 changed subcategory; re-load changes nothing
    assert counts(dp) == {"A": 5, "I": 3}
    assert counts(read_table(spark, warehouse, "report", "dim_products", 2)) == counts(dp)
    assert dp.filter("product_id = 105").select("category").first()[0] is None
    dc = read_table(spark, warehouse, "report", "dim_customers")
    assert counts(dc) == {"A": 4, "I": 1}
    keys = sorted(r.customer_key for r in dc.collect())
    assert keys == [1, 2, 3, 4, 5]
    for dim, key, sk in ((dp, "product_id", "product_key"), (dc, "customer_id", "customer_key")):
        bad = {r.check_name: r.failed for r in dq_checks(dim, key, surrogate=sk).collect()}
        assert set(bad.values()) == {0}, bad


def test_fact_is_incremental_and_idempotent(spark, warehouse):
    f1 = read_table(spark, warehouse, "report", "fact_sales", 1)
    f = read_table(spark, warehouse, "report", "fact_sales")
    assert f1.count() == 3 and f.count() == 4
    so3 = f.filter("order_number = 'SO3'").first()
    assert so3.product_key is None and so3.customer_key is None and so3.order_date is None
    so2 = f.filter("order_number = 'SO2'").first()
    assert (so2.sales_amount, so2.price, so2.order_date) == (13, 13, None)
    s = read_table(spark, warehouse, "stage", "crm_sales_details")
    assert s.count() == 4
    dp = read_table(spark, warehouse, "report", "dim_products")
    assert dq_fact_keys(f, dp, "product_key", "product_key").first().failed == 0
    assert f.filter(F.col("dwh_create_date") == F.lit(dt.datetime(2024, 1, 3))).count() == 0
