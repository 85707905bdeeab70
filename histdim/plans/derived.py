"""Inputs derived from the benchmark tables for the registered queries.

The benchmark tables (customer, part, orders, lineitem, ...) hold no NULLs
and no dirt, so each registered query first derives the messy input its
operator exists for -- NULLs, padding, alias spellings, packed dates, second
batches -- by deterministic arithmetic on the keys.  Every derivation is one
SQL text that Spark SQL and DuckDB both run unchanged, so the Spark query and
its SQL oracle see identical inputs, and every input grows with the tables.
"""

from __future__ import annotations

LOAD_DATE = "2024-01-01"
LOAD_DATE_2 = "2024-01-02"

# text date in ISO or US form, from a date/timestamp expression
def iso_text(e: str) -> str:
    return (f"CAST(year({e}) AS STRING) || '-' || lpad(CAST(month({e}) AS STRING), 2, '0')"
            f" || '-' || lpad(CAST(day({e}) AS STRING), 2, '0')")


def us_text(e: str) -> str:
    return (f"CAST(month({e}) AS STRING) || '/' || CAST(day({e}) AS STRING) || '/'"
            f" || CAST(year({e}) AS STRING)")


def packed(e: str) -> str:
    return f"CAST(year({e}) * 10000 + month({e}) * 100 + day({e}) AS INT)"


SQL: dict[str, str] = {}

SQL["orders_mixed_dates"] = f"""
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 3 THEN 'n/a'
            WHEN o_orderkey % 2 = 0 THEN {iso_text('o_orderdate')}
            ELSE {us_text('o_orderdate')} END AS raw_date
FROM orders"""

# lines of a delimited file: id, name, day, at
SQL["customer_lines"] = f"""
SELECT c_custkey,
       CASE WHEN c_custkey % 11 = 1 THEN 'X' ELSE '' END || CAST(c_custkey AS STRING) || ',' || c_name || ','
       || CASE WHEN c_custkey % 13 = 2 THEN '2020-13-45' WHEN c_custkey % 2 = 0 THEN {iso_text('DATE ' + chr(39) + '2020-03-04' + chr(39))}
               ELSE '3/4/2020 10:30:00' END
       || CASE WHEN c_custkey % 17 = 3 THEN '' WHEN c_custkey % 19 = 4 THEN ',,extra'
               WHEN c_custkey % 3 = 0 THEN ',2021-05-06 07:08:09' ELSE ',' END AS line
FROM customer"""

SQL["orders_null_keys"] = """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
       o_custkey, o_orderstatus
FROM orders"""

# a third of all rows under one key, the same date for all of them, each row three times
SQL["orders_hot_key"] = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN -1 ELSE o_custkey END AS custkey,
       CASE WHEN o_orderkey % 3 = 0 THEN DATE '2000-01-01'
            WHEN o_orderkey % 11 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date, o_orderstatus AS status
FROM orders, (SELECT 1 AS x UNION ALL SELECT 2 UNION ALL SELECT 3) three"""

SQL["lineitem_flags"] = """
SELECT l_partkey,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
       l_linestatus
FROM lineitem"""

SQL["orders_line_codes"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL
            WHEN o_orderkey % 4 = 1
                 THEN ' ' || lower(substr('MRSTX', CAST(o_orderkey % 6 AS INT), 1)) || ' '
            ELSE substr('MRSTX', CAST(o_orderkey % 6 AS INT), 1) END AS prd_line
FROM orders"""

SQL["lineitem_genders"] = """
SELECT l_orderkey, l_linenumber,
       CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'female '
            WHEN 2 THEN ' M' WHEN 3 THEN 'Male' WHEN 4 THEN '' WHEN 5 THEN NULL
            ELSE l_returnflag END AS gen
FROM lineitem"""

SQL["customer_countries"] = """
SELECT c_custkey,
       CASE c_custkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN ' US' WHEN 2 THEN 'USA '
            WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN ' de ' WHEN 6 THEN '   '
            ELSE ' NATION_' || CAST(c_nationkey AS STRING) END AS cntry
FROM customer"""

SQL["part_padded"] = """
SELECT p_partkey, ' ' || p_name || '  ' AS p_name, '  ' || p_brand AS p_brand
FROM part"""

SQL["customer_compound_keys"] = """
SELECT c_custkey,
       upper(substr(c_mktsegment, 1, 2)) || '-' || upper(substr(c_mktsegment, 3, 2))
       || '-' || c_name AS prd_key
FROM customer"""

SQL["customer_prefixed_ids"] = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NAS' || c_name ELSE c_name END AS cid
FROM customer"""

SQL["orders_packed_dates"] = f"""
SELECT o_orderkey,
       CASE o_orderkey % 10
            WHEN 0 THEN 0
            WHEN 1 THEN CAST(year(o_orderdate) * 1000 + month(o_orderdate) * 10
                             + day(o_orderdate) % 10 AS INT)
            WHEN 2 THEN NULL
            WHEN 3 THEN CAST(year(o_orderdate) * 10000 + 1332 AS INT)
            WHEN 4 THEN -1234567
            WHEN 5 THEN CAST(year(o_orderdate) * 10000 + 230 AS INT)
            ELSE {packed('o_orderdate')} END AS sls_order_dt
FROM orders"""

SQL["lineitem_amounts"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(l_linenumber % 4 AS INT) AS sls_quantity,
       CAST(CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0
                 WHEN 2 THEN -(l_partkey % 50 + 1) ELSE l_partkey % 50 + 1 END AS INT)
           AS sls_price,
       CAST(CASE l_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 0
                 WHEN 2 THEN -(l_suppkey % 97 + 1)
                 WHEN 3 THEN (l_linenumber % 4) * (l_partkey % 50 + 1) + 1
                 ELSE (l_linenumber % 4) * (l_partkey % 50 + 1) END AS INT) AS sls_sales
FROM lineitem"""

SQL["part_null_sizes"] = """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size END AS p_size
FROM part"""

SQL["customer_genders"] = """
SELECT c_custkey,
       CASE c_custkey % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN 'Male' WHEN 2 THEN NULL
            ELSE 'Female' END AS cst_gndr,
       CASE c_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN NULL ELSE 'n/a' END AS gen
FROM customer"""

# --- stage-shaped customer sources (for conform_customers) ---------------
SQL["stage_customers"] = """
SELECT CAST(c_custkey AS INT) AS cst_id, 'AW' || CAST(c_custkey AS STRING) AS cst_key,
       'F' || CAST(c_nationkey AS STRING) AS cst_firstname, c_mktsegment AS cst_lastname,
       CASE c_custkey % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'n/a' END
           AS cst_marital_status,
       CASE c_custkey % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female'
            ELSE 'n/a' END AS cst_gndr,
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INT) AS cst_create_date,
       CASE WHEN c_custkey % 13 = 0 THEN 'I' ELSE 'A' END AS is_current
FROM customer"""

SQL["stage_az12"] = """
SELECT 'AW' || CAST(c_custkey AS STRING) AS cid,
       DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) AS bdate,
       CASE c_custkey % 5 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'n/a'
            ELSE NULL END AS gen,
       'A' AS is_current
FROM customer WHERE c_custkey % 3 <> 0
UNION ALL
SELECT 'AW' || CAST(c_custkey AS STRING), DATE '1940-06-01', 'Male', 'I'
FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 3 <> 0"""

SQL["stage_locations"] = """
SELECT 'AW' || CAST(c_custkey AS STRING) AS cid,
       'NATION_' || CAST(c_nationkey AS STRING) AS cntry, 'A' AS is_current
FROM customer WHERE c_custkey % 4 <> 1
UNION ALL
SELECT 'AW' || CAST(c_custkey AS STRING), 'OLDLAND', 'I'
FROM customer WHERE c_custkey % 5 = 0"""

SQL["stage_products"] = """
SELECT CAST(p_partkey AS INT) AS prd_id, p_brand AS cat_id, p_name AS prd_key,
       p_type AS prd_nm, p_size AS prd_cost, 'Road' AS prd_line,
       DATE '2020-01-01' + CAST(p_partkey % 400 AS INT) AS prd_start_dt,
       CASE WHEN p_partkey % 9 = 0 THEN DATE '2021-01-01' ELSE NULL END AS prd_end_dt,
       CASE WHEN p_partkey % 9 = 0 OR p_partkey % 11 = 0 THEN 'I' ELSE 'A' END AS is_current
FROM part"""

SQL["stage_categories"] = """
SELECT p_brand AS id, upper(p_brand) AS cat, 'SUB_' || p_brand AS subcat,
       CASE WHEN length(p_brand) % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance,
       'A' AS is_current
FROM (SELECT DISTINCT p_brand FROM part) b
WHERE p_brand NOT IN ('Brand#3', 'Brand#7')
UNION ALL
SELECT 'Brand#5', 'OLD', 'OLD', 'No', 'I'"""

# --- change detection -------------------------------------------------------
SQL["dim_people"] = """
SELECT CAST(c_custkey AS INT) AS customer_id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS first_name,
       c_mktsegment AS last_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS nation,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE DATE '1970-01-01' + CAST(c_custkey % 9000 AS INT) END AS birthdate,
       'A' AS is_current
FROM customer
UNION ALL
SELECT CAST(c_custkey AS INT), c_name, 'OLD', c_nationkey, DATE '1960-01-01', 'I'
FROM customer WHERE c_custkey % 6 = 0"""

SQL["src_people"] = """
SELECT CAST(c_custkey AS INT) AS customer_id,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS first_name,
       CASE WHEN c_custkey % 5 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS last_name,
       CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE c_nationkey END AS nation,
       CASE WHEN c_custkey % 17 = 0 THEN DATE '1900-01-01'
            WHEN c_custkey % 19 = 0 THEN NULL
            ELSE DATE '1970-01-01' + CAST(c_custkey % 9000 AS INT) END AS birthdate
FROM customer WHERE c_custkey % 23 <> 0
UNION ALL
SELECT CAST(c_custkey + 1000000 AS INT), c_name, c_mktsegment, c_nationkey, NULL
FROM customer WHERE c_custkey % 50 = 0"""

# --- Type-2 merge: customers, second batch ---------------------------------
SQL["merge_target"] = """
SELECT CAST(c_custkey AS INT) AS cst_id, 'AW' || CAST(c_custkey AS STRING) AS cst_key,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS cst_name,
       c_mktsegment AS cst_segment, c_nationkey AS cst_nation,
       CAST('2023-06-01' AS TIMESTAMP) AS dwh_create_date, 'A' AS is_current,
       CAST(NULL AS DATE) AS modified_dt
FROM customer WHERE c_custkey % 10 <> 0
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || CAST(c_custkey AS STRING), c_name, 'OLD', c_nationkey,
       CAST('2023-01-01' AS TIMESTAMP), 'I',
       CASE WHEN c_custkey % 49 = 0 THEN NULL ELSE DATE '2023-06-01' END
FROM customer WHERE c_custkey % 7 = 0"""

SQL["merge_source"] = """
SELECT CAST(c_custkey AS INT) AS cst_id, 'AW' || CAST(c_custkey AS STRING) AS cst_key,
       CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS cst_name,
       CASE WHEN c_custkey % 5 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS cst_segment,
       c_nationkey AS cst_nation
FROM customer WHERE c_custkey % 11 <> 0
UNION ALL
SELECT CAST(c_custkey + 1000000 AS INT), 'AW' || CAST(c_custkey + 1000000 AS STRING), c_name,
       c_mktsegment, c_nationkey
FROM customer WHERE c_custkey % 50 = 0"""

# a dirty target: some keys have two active rows, one of them as the source has it
SQL["merge_target_dirty"] = SQL["merge_target"] + """
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || CAST(c_custkey AS STRING), c_name,
       CASE WHEN c_custkey % 2 = 0 THEN 'SECOND' WHEN c_custkey % 5 = 0 THEN 'MACHINERY'
            ELSE c_mktsegment END, c_nationkey, CAST('2023-03-01' AS TIMESTAMP), 'A',
       CAST(NULL AS DATE)
FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 10 <> 0"""

# some rows without a flag: neither active nor known history
SQL["merge_target_null_flag"] = f"""
SELECT cst_id, cst_key, cst_name, cst_segment, cst_nation, dwh_create_date,
       CASE WHEN cst_id % 4 = 2 THEN NULL ELSE is_current END AS is_current, modified_dt
FROM ({SQL['merge_target']}) t"""

# --- report dimension load: products ---------------------------------------
SQL["dim_parts"] = """
SELECT CAST(2 * p_partkey + 1 AS INT) AS product_key, CAST(p_partkey AS INT) AS product_id,
       p_name AS product_name, p_brand AS brand, p_size AS size,
       CAST('2023-06-01' AS TIMESTAMP) AS dwh_create_date, 'A' AS is_current,
       CAST(NULL AS DATE) AS modified_dt
FROM part WHERE p_partkey % 10 <> 0
UNION ALL
SELECT CAST(2 * p_partkey + 2 AS INT), CAST(p_partkey AS INT), p_name, 'OLD', p_size,
       CAST('2023-01-01' AS TIMESTAMP), 'I', DATE '2023-06-01'
FROM part WHERE p_partkey % 4 = 0"""

# some products have two active versions, one of them as the source has it
SQL["dim_parts_dirty"] = SQL["dim_parts"] + """
UNION ALL
SELECT CAST(10000000 + p_partkey AS INT), CAST(p_partkey AS INT), p_name,
       CASE WHEN p_partkey % 2 = 0 THEN 'Brand#X' ELSE 'SECOND' END, p_size,
       CAST('2023-03-01' AS TIMESTAMP), 'A', CAST(NULL AS DATE)
FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 10 <> 0"""

SQL["dim_parts_null_flag"] = f"""
SELECT product_key, product_id, product_name, brand, size, dwh_create_date,
       CASE WHEN product_id % 4 = 2 THEN NULL ELSE is_current END AS is_current, modified_dt
FROM ({SQL['dim_parts']}) t"""

SQL["src_parts"] = """
SELECT CAST(p_partkey AS INT) AS product_id, p_name AS product_name,
       CASE WHEN p_partkey % 6 = 0 THEN 'Brand#X' ELSE p_brand END AS brand, p_size AS size
FROM part WHERE p_partkey % 9 <> 5"""

# --- anti joins -------------------------------------------------------------
SQL["lineitem_rows"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
       l_linestatus, CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem"""

SQL["lineitem_rows_loaded"] = f"""
SELECT * FROM ({SQL['lineitem_rows']}) r WHERE l_orderkey % 3 = 0"""

SQL["orders_keyed"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
       o_orderstatus
FROM orders"""

SQL["orders_keyed_loaded"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
       o_orderstatus
FROM orders WHERE o_orderkey % 4 = 0"""

# --- sales staging and fact -------------------------------------------------
SQL["sales_raw"] = f"""
SELECT 'SO' || CAST(l_orderkey AS STRING) AS sls_ord_num,
       'P' || CAST(l_partkey AS STRING) AS sls_prd_key,
       CAST(l_suppkey AS INT) AS sls_cust_id,
       CASE l_linenumber % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL
            ELSE {packed('l_shipdate')} END AS sls_order_dt,
       {packed('l_shipdate')} AS sls_ship_dt,
       CASE WHEN l_partkey % 11 = 0 THEN CAST(year(l_shipdate) * 10000 + 1332 AS INT)
            ELSE {packed('l_shipdate')} END AS sls_due_dt,
       CAST(CASE l_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 0
                 WHEN 2 THEN -(l_suppkey % 97 + 1)
                 WHEN 3 THEN (l_linenumber % 4) * (l_partkey % 50 + 1) + 1
                 ELSE (l_linenumber % 4) * (l_partkey % 50 + 1) END AS INT) AS sls_sales,
       CAST(l_linenumber % 4 AS INT) AS sls_quantity,
       CAST(CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0
                 WHEN 2 THEN -(l_partkey % 50 + 1) ELSE l_partkey % 50 + 1 END AS INT)
           AS sls_price
FROM lineitem"""

SQL["sales_raw_dup"] = f"""
SELECT * FROM ({SQL['sales_raw']}) a
UNION ALL
SELECT * FROM ({SQL['sales_raw']}) b WHERE sls_cust_id % 9 = 0"""

SQL["sales_stage"] = """
SELECT 'SO' || CAST(l.l_orderkey AS STRING) AS sls_ord_num,
       'P' || CAST(l.l_partkey AS STRING) AS sls_prd_key,
       CAST(o.o_custkey AS INT) AS sls_cust_id,
       CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END
           AS sls_order_dt,
       CAST(l.l_shipdate AS DATE) AS sls_ship_dt,
       CAST(l.l_shipdate AS DATE) + 10 AS sls_due_dt,
       CAST(l.l_quantity AS INT) * CAST(l.l_partkey % 50 + 1 AS INT) AS sls_sales,
       CAST(l.l_quantity AS INT) AS sls_quantity,
       CAST(l.l_partkey % 50 + 1 AS INT) AS sls_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

SQL["fact_dim_products"] = """
SELECT CAST(p_partkey + 1 AS INT) AS product_key, 'P' || CAST(p_partkey AS STRING) AS product_number,
       CASE WHEN p_partkey % 8 = 0 THEN 'I' ELSE 'A' END AS is_current
FROM part
UNION ALL
SELECT CAST(p_partkey + 50000001 AS INT), 'P' || CAST(p_partkey AS STRING), 'A'
FROM part WHERE p_partkey % 16 = 0"""

SQL["fact_dim_customers"] = """
SELECT CAST(c_custkey + 1 AS INT) AS customer_key, CAST(c_custkey AS INT) AS customer_id,
       CASE WHEN c_custkey % 9 = 0 THEN 'I' ELSE 'A' END AS is_current
FROM customer
UNION ALL
SELECT CAST(c_custkey + 50000001 AS INT), CAST(c_custkey AS INT), 'A'
FROM customer WHERE c_custkey % 18 = 0"""

SQL["fact_existing"] = """
SELECT 'SO' || CAST(l.l_orderkey AS STRING) AS order_number,
       CAST(l.l_partkey + 1 AS INT) AS product_key,
       CAST(o.o_custkey + 1 AS INT) AS customer_key,
       CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END
           AS order_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_orderkey % 4 = 0"""


# --- two raw batches for the end-to-end pipeline ----------------------------
def batch_sql(table: str, b: int) -> str:
    """Raw source ``table`` of batch ``b`` (1 or 2), in raw-file column order."""
    two = b == 2
    if table == "crm_cust_info":
        last = ("CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '_X' ELSE c_mktsegment END"
                if two else "c_mktsegment")
        keep = "WHERE c_custkey % 11 <> 0" if two else ""
        keep_and = "AND c_custkey % 11 <> 0" if two else ""
        sql = f"""
SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE CAST(c_custkey AS INT) END AS cst_id,
       'AW' || CAST(c_custkey AS STRING) AS cst_key,
       ' F' || CAST(c_nationkey AS STRING) || ' ' AS cst_firstname,
       {last} AS cst_lastname,
       CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN ' m ' ELSE 'X' END AS cst_marital_status,
       CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'm' WHEN 2 THEN ' ' ELSE NULL END
           AS cst_gndr,
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INT) AS cst_create_date
FROM customer {keep}
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || CAST(c_custkey AS STRING), 'OLD', 'OLD', 'S', 'F',
       DATE '2019-01-01'
FROM customer WHERE c_custkey % 10 = 0 {keep_and}
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || CAST(c_custkey AS STRING), 'TIE', {last}, 'M', 'M',
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INT)
FROM customer WHERE c_custkey % 20 = 0 {keep_and}"""
        if two:
            sql += """
UNION ALL
SELECT CAST(c_custkey + 1000000 AS INT), 'AW' || CAST(c_custkey + 1000000 AS STRING), 'N',
       c_mktsegment, 'M', 'F', DATE '2021-01-01'
FROM customer WHERE c_custkey % 50 = 0"""
        return sql
    if table == "erp_cust_az12":
        fix = "WHEN c_custkey % 13 = 0 THEN DATE '1961-01-01'" if two else ""
        return f"""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NASAW' ELSE 'AW' END || CAST(c_custkey AS STRING) AS cid,
       CASE WHEN c_custkey % 37 = 0 THEN DATE '2030-01-01' {fix}
            ELSE DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) END AS bdate,
       CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'female ' WHEN 2 THEN 'M'
            WHEN 3 THEN 'Male' WHEN 4 THEN ' ' ELSE NULL END AS gen
FROM customer WHERE c_custkey % 3 <> 2"""
    if table == "erp_loc_a101":
        moved = "WHEN c_custkey % 9 = 0 THEN 'France'" if two else ""
        return f"""
SELECT 'AW-' || CAST(c_custkey AS STRING) AS cid,
       CASE {moved} WHEN c_custkey % 8 = 0 THEN 'DE' WHEN c_custkey % 8 = 1 THEN 'US'
            WHEN c_custkey % 8 = 2 THEN 'USA' WHEN c_custkey % 8 = 3 THEN ' Canada '
            WHEN c_custkey % 8 = 4 THEN NULL WHEN c_custkey % 8 = 5 THEN 'de'
            ELSE 'NATION_' || CAST(c_nationkey AS STRING) END AS cntry
FROM customer WHERE c_custkey % 4 <> 3"""
    # products: parts 2k and 2k+1 are two versions of raw product key k (the
    # later start wins); the category prefix is a function of k, so every
    # product number has exactly one open version
    k = "CAST(floor(p_partkey / 2) AS BIGINT)"
    if table == "crm_prod_info":
        start = "DATE '2010-01-01' + CAST(p_partkey % 3000 AS INT)"
        text = us_text(start) if two else iso_text(start)
        bump = " + CASE WHEN p_partkey % 40 = 1 THEN 2 ELSE 0 END" if two else ""
        return f"""
SELECT CAST(p_partkey AS INT) AS prd_id,
       'C' || CAST({k} % 5 AS STRING) || '-' || lpad(CAST({k} % 30 AS STRING), 2, '0') || '-K'
       || CAST({k} AS STRING) AS prd_key,
       p_name AS prd_nm,
       CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE p_size{bump} END AS prd_cost,
       CASE p_partkey % 5 WHEN 0 THEN 'M ' WHEN 1 THEN 'R ' WHEN 2 THEN 'S ' WHEN 3 THEN 'T '
            ELSE NULL END AS prd_line,
       {text} AS prd_start_dt,
       CAST(NULL AS STRING) AS prd_end_dt
FROM part"""
    if table == "erp_px_cat_g1v2":
        cat = ("CASE WHEN m30 = 3 THEN 'Renamed' ELSE 'CAT' || CAST(m5 AS STRING) END"
               if two else "'CAT' || CAST(m5 AS STRING)")
        return f"""
SELECT 'C' || CAST(m5 AS STRING) || '_' || lpad(CAST(m30 AS STRING), 2, '0') AS id,
       {cat} AS cat, 'SUB' || CAST(m30 AS STRING) AS subcat,
       CASE WHEN m30 % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance
FROM (SELECT DISTINCT {k} % 5 AS m5, {k} % 30 AS m30 FROM part) c"""
    if table == "crm_sales_details":
        sql = f"""
SELECT 'SO' || CAST(l.l_orderkey AS STRING) AS sls_ord_num,
       'K' || CAST(CAST(floor(l.l_partkey / 2) AS BIGINT) AS STRING) AS sls_prd_key,
       CAST(o.o_custkey AS INT) AS sls_cust_id,
       CASE WHEN l.l_orderkey % 29 = 0 THEN 0 ELSE {packed('o.o_orderdate')} END AS sls_order_dt,
       {packed('l.l_shipdate')} AS sls_ship_dt,
       {packed('l.l_shipdate')} AS sls_due_dt,
       CAST(CASE WHEN l.l_orderkey % 7 = 0 THEN NULL
                 ELSE CAST(l.l_quantity AS INT) * (l.l_partkey % 50 + 1) END AS INT) AS sls_sales,
       CAST(l.l_quantity AS INT) AS sls_quantity,
       CAST(CASE WHEN l.l_orderkey % 5 = 0 THEN NULL ELSE l.l_partkey % 50 + 1 END AS INT)
           AS sls_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
        if two:
            sql += f"""
UNION ALL
SELECT 'SO-N' || CAST(o_orderkey AS STRING), 'K1', CAST(o_custkey AS INT),
       {packed('o_orderdate')}, {packed('o_orderdate')}, {packed('o_orderdate')}, 10, 1, 10
FROM orders WHERE o_orderkey % 500 = 1"""
        return sql
    raise KeyError(table)
