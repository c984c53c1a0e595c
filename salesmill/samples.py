"""Sales-shaped tables derived from the TPC-H-like test tables.

Each table is one portable SELECT, so the same text serves Spark and the
oracle engine. ``{name}`` stands for a source table. Both sides of the fact join
grow with the data, so it is a sort-merge join at every size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from .session import tune

# Declared, so that opening a table needs no look at its files.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
SOURCES = tuple(SOURCE_SCHEMAS)

SHAPES: dict[str, str] = {
    "fact_invoice_secondary": """
        SELECT /*+ MERGE(o) */
            CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END AS SMALLINT) AS active_flag,
            CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS invoice_date,
            CAST(o_custkey AS STRING) AS customer_code,
            CAST(o_orderkey AS STRING) AS invoice_no,
            CAST(l_partkey AS STRING) AS item_code,
            CAST(l_suppkey AS STRING) AS dealer_code,
            CAST(l_suppkey % 25 AS SMALLINT) AS sales_group_code,
            concat(CAST(l_suppkey AS STRING), '_', CAST(l_suppkey % 25 AS STRING)) AS dealer_sg_key,
            l_extendedprice * (1 - l_discount) AS reporting_value,
            l_quantity AS reporting_unit,
            l_quantity * 12 AS reporting_unit_in_each,
            l_extendedprice AS revised_net_value_mvg,
            l_tax AS rate,
            l_linenumber AS line_no,
            'SEC' AS record_type
        FROM {lineitem} JOIN {orders} AS o ON l_orderkey = o_orderkey
    """,
    "fact_invoice_details": """
        SELECT /*+ MERGE(o) */
            CASE WHEN l_linenumber = 7 THEN '0' ELSE '1' END AS active_flag,
            CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS posting_date,
            CAST(o_custkey AS STRING) AS customer_code,
            CAST(CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END AS INT) AS customer_code_org,
            CAST(l_partkey AS STRING) AS material_code,
            CAST(l_partkey % 9 AS SMALLINT) AS material_division,
            CASE WHEN o_orderkey % 53 <> 0 THEN CAST(o_orderkey AS STRING) END AS invoice_no,
            CASE WHEN l_linestatus = 'F' THEN 'ZF2' ELSE 'ZRE' END AS invoice_type,
            CAST(l_linenumber AS DECIMAL(8, 2)) AS item_number,
            CASE l_returnflag WHEN 'R' THEN 'CN' WHEN 'A' THEN 'INV' ELSE 'FCN' END AS mis_type,
            CASE WHEN l_linenumber % 2 = 0 THEN 'RTDIF' ELSE 'OTHER' END AS reason_code,
            CASE WHEN l_orderkey % 97 <> 0 THEN CAST(
                CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))
                AS DECIMAL(10, 2)) END AS net_value,
            CAST(l_tax AS DECIMAL(10, 2)) AS rate,
            CAST(l_quantity AS DECIMAL(10, 2)) AS reporting_unit,
            CAST(l_extendedprice AS DECIMAL(15, 3)) AS revised_net_value_mvg,
            CASE WHEN l_linestatus = 'F' OR l_linenumber > 1
                THEN CAST(l_quantity AS DECIMAL(12, 2)) END AS billing_quantity_in_stock_keeping_unit,
            CAST(l_quantity * 2 AS DECIMAL(15, 2)) AS net_weight_in_kg,
            CAST(l_quantity * 3 AS DECIMAL(10, 2)) AS volume_in_kg,
            CAST(l_quantity * 4 AS DECIMAL(10, 2)) AS volume_in_ltr,
            concat('PO', CAST(o_orderkey AS STRING)) AS order_no,
            CAST(l_suppkey % 100 AS SMALLINT) AS business_area_code,
            CAST(CASE WHEN l_linenumber > 2 THEN l_partkey % 9 END AS SMALLINT) AS division_code,
            CAST(l_suppkey % 25 AS SMALLINT) AS sales_group_code
        FROM {lineitem} JOIN {orders} AS o ON l_orderkey = o_orderkey
    """,
    "dim_customer_master": """
        SELECT
            CAST(c_custkey AS STRING) AS customer_code,
            c_name AS customer_name,
            concat('g', CAST(c_custkey % 4 AS STRING)) AS customer_group,
            CAST(c_custkey % 10 AS SMALLINT) AS customer_group_1,
            CAST(c_custkey % 7 AS SMALLINT) AS customer_group_3,
            CASE WHEN c_acctbal < 0 THEN 'closed' ELSE 'active' END AS customer_group_3_status,
            CASE WHEN c_acctbal < 0 THEN 'blocked' ELSE 'open' END AS customer_block,
            concat('district ', CAST(c_custkey % 50 AS STRING)) AS district,
            c_mktsegment AS town,
            lower(n_name) AS state,
            concat('strata ', CAST(c_nationkey % 5 AS STRING)) AS pop_strata,
            CAST(c_custkey % 1000 * 1000 AS INT) AS population,
            c_acctbal AS credit_limit,
            CAST(19950101 + c_nationkey AS INT) AS customer_creation_date,
            CASE WHEN c_acctbal < 1000 THEN 'Cheque' ELSE 'Transfer' END AS payment_method_name,
            concat('NET', CAST(c_nationkey % 4 * 30 AS STRING)) AS term_of_payment,
            CAST(c_custkey - c_custkey % 10 AS INT) AS parent_customer_code,
            CAST(c_custkey - c_custkey % 100 AS INT) AS grand_parent_customer_code,
            n_name AS sale_group_name,
            concat('C', CAST(n_nationkey AS STRING)) AS cluster_code,
            lower(n_name) AS cluster,
            concat('B', CAST(n_nationkey % 10 AS STRING)) AS branch_code,
            concat('Branch ', CAST(n_nationkey % 10 AS STRING)) AS branch,
            concat('R', CAST(r_regionkey AS STRING)) AS region_code,
            concat('CM', CAST(r_regionkey AS STRING)) AS cm_region_code,
            lower(r_name) AS region,
            concat('Z', CAST(r_regionkey AS STRING)) AS zone_code,
            lower(r_name) AS zone,
            concat('T', CAST(n_nationkey AS STRING)) AS tsi_territory_code,
            concat('  tsi  area ', CAST(c_custkey % 40 AS STRING), ' ') AS tsi_territory_name,
            concat('grp', CAST(c_custkey % 3 AS STRING)) AS tsi_grouping,
            concat('T', CAST(n_nationkey AS STRING)) AS wss_territory_code,
            concat('territory ', lower(n_name)) AS wss_territory_name,
            CASE WHEN c_custkey % 6 = 0 THEN 'Y' ELSE 'N' END AS winomkar_wss_flag
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "dim_dealer_master": """
        SELECT
            CAST(s_suppkey AS STRING) AS dealer_code,
            s_name AS dealer_name,
            CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 10 AS STRING) END AS dealer_group_code,
            CAST(s_suppkey AS STRING) AS customer_code,
            concat(CAST(s_suppkey AS STRING), '_', CAST(s_suppkey % 25 AS STRING)) AS dealer_sg_key,
            CASE WHEN s_suppkey % 5 = 0 THEN 'False' ELSE 'True' END AS active_flag,
            concat('city ', CAST(s_nationkey AS STRING)) AS dealer_city,
            CASE WHEN s_acctbal > 5000 THEN 'A' ELSE 'B' END AS dealer_class,
            concat('district ', CAST(s_suppkey % 30 AS STRING)) AS dealer_district,
            concat('state ', CAST(s_nationkey AS STRING)) AS dealer_state,
            concat('route ', CAST(s_suppkey % 12 AS STRING)) AS dealer_route_name,
            concat('type1 ', CAST(s_suppkey % 2 AS STRING)) AS dealer_type_1,
            concat('type2 ', CAST(s_suppkey % 3 AS STRING)) AS dealer_type_2,
            concat('type3 ', CAST(s_suppkey % 4 AS STRING)) AS dealer_type_3,
            concat('type4 ', CAST(s_suppkey % 5 AS STRING)) AS dealer_type_4,
            concat('type5 ', CAST(s_suppkey % 6 AS STRING)) AS dealer_type_5,
            concat('type6 ', CAST(s_suppkey % 7 AS STRING)) AS dealer_type_6,
            concat('type7 ', CAST(s_suppkey % 8 AS STRING)) AS dealer_type_7,
            concat('type12 ', CAST(s_suppkey % 9 AS STRING)) AS dealer_type_12,
            CASE WHEN s_acctbal > 0 THEN 'TSI' ELSE 'TSR' END AS tsi_type,
            concat('S', CAST(s_suppkey % 40 AS STRING)) AS tsi_code,
            concat('tsr ', CAST(s_suppkey % 40 AS STRING)) AS tsi_name,
            concat('T', CAST(s_nationkey AS STRING)) AS tsi_territory_code
        FROM {supplier}
    """,
    "dim_material": """
        SELECT
            CAST(p_partkey AS STRING) AS material_code,
            p_name AS material_description,
            CASE WHEN p_type = 'PROMO' THEN 'ZPAK' ELSE 'ZFGD' END AS material_type,
            CASE WHEN p_size > 45 THEN 'False' ELSE 'True' END AS active_flag,
            CAST(p_partkey % 25 AS SMALLINT) AS sales_group_code,
            lower(p_type) AS product_group_1_description,
            lower(p_brand) AS product_group_2_description,
            p_name AS product_group_3_description,
            concat(CAST(p_size AS STRING), ' kg') AS product_group_5_description
        FROM {part}
    """,
    "dim_material_mapping": """
        SELECT
            lower(p_brand) AS brand,
            CASE WHEN p_retailprice > 1000 THEN 'Premium' ELSE 'Core' END AS final_classification,
            CAST(p_partkey AS STRING) AS material_code,
            concat('PD', CAST(p_partkey % 6 AS STRING)) AS parent_division_code,
            concat('Parent division ', CAST(p_partkey % 6 AS STRING)) AS parent_division_name,
            lower(p_type) AS product_group_1_description,
            lower(p_brand) AS product_group_2_description,
            p_name AS product_group_3_description,
            lower(p_type) AS vertical,
            concat(CAST(p_partkey AS STRING), CAST(p_partkey % 25 AS STRING)) AS material_code_sg_key
        FROM {part}
    """,
    "dim_sales_group": """
        SELECT
            lower(r_name) AS division,
            CAST(n_nationkey AS SMALLINT) AS sales_group,
            lower(n_name) AS vertical
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    """,
    "dim_hierarchy": """
        SELECT
            concat(CAST(n_nationkey AS STRING), '-', CAST(k AS STRING)) AS primary_key,
            CASE WHEN k = 1 OR n_nationkey % 5 < 4 THEN 'Primary Sales Hierarchy' ELSE 'Other' END AS txn_type,
            concat('T', CAST(n_nationkey AS STRING)) AS wss_territory_code,
            concat('C', CAST(n_nationkey AS STRING)) AS cluster_code,
            CAST(n_regionkey AS SMALLINT) AS division_code,
            CAST(n_nationkey AS SMALLINT) AS sales_group,
            concat('T', CAST(n_nationkey AS STRING)) AS sh_2_code,
            concat(' ', lower(n_name), ' v', CAST(k AS STRING)) AS sh_2_name,
            CASE WHEN n_nationkey % 11 <> 3 THEN
                concat(' Tsr-', CAST(n_nationkey AS STRING), '@Example.com') END AS sh_2_email,
            concat('asm ', CAST(n_nationkey % 10 AS STRING), '@example.com') AS sh_3_email,
            CASE WHEN n_nationkey % 4 = 0 THEN concat('ASM ', CAST(n_nationkey % 10 AS STRING), '@example.com')
                ELSE concat('rsm.', CAST(n_nationkey % 5 AS STRING), '@example.com') END AS sh_4_email,
            concat('zsm-', CAST(n_regionkey AS STRING), '@example.com') AS sh_5_email,
            CASE WHEN n_nationkey % 7 = 0 THEN NULL
                WHEN n_nationkey % 3 = 0 THEN concat('zsm-', CAST(n_regionkey AS STRING), '@example.com')
                ELSE 'nsm@example.com' END AS sh_6_email,
            CASE WHEN n_nationkey % 6 = 0 THEN ' ' ELSE 'Head@Example.com' END AS sh_7_email
        FROM (
            SELECT n_nationkey, n_name, n_regionkey, 0 AS k FROM {nation}
            UNION ALL
            SELECT n_nationkey, n_name, n_regionkey, 1 AS k FROM {nation}
        ) versions
    """,
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return tune(spark).read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sales-shaped table as a lazy plan over the given tables."""
    text = SHAPES[name]
    used = {t: source(spark, sf_dir, t) for t in SOURCES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def shapes(spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(SHAPES)) -> dict[str, DataFrame]:
    return {n: shape(spark, sf_dir, n) for n in names}


def shape_cte(*names: str) -> str:
    """``WITH`` list that gives the oracle engine the same tables."""
    own_names = {t: t for t in SOURCES}
    return "WITH " + ",\n".join(f"{n} AS ({SHAPES[n].format(**own_names)})" for n in names)
