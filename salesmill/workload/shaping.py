"""Renaming, aligning, converting and deriving columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, names
from ..functions.numbers import flag, standard_decimal
from ..operators import align, computed, convert, filters, records
from ..samples import shape, shape_cte, source
from ..tables import SPECS
from . import Workload

WORK = Workload()

CUTOFF = 19980401
SECONDARY = "fact_invoice_secondary"
FACT_CTE = shape_cte(SECONDARY)


def _raw(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    return spark.sql(text, **{t: source(spark, sf_dir, t) for t in tables})


def _own(text: str, *tables: str) -> str:
    return text.format(**{t: t for t in tables})


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, SECONDARY)


# --- names and columns ------------------------------------------------------


@WORK.add("mapping_rename", f"{FACT_CTE} SELECT invoice_no, invoice_date, item_code, dealer_sg_key, reporting_value FROM {SECONDARY}")
def mapping_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squashed feed names back to declared names by the table's mapping."""
    feed = align.rename_squashed(fact(spark, sf_dir))
    named, _ = align.rename_mapped(feed, SPECS[SECONDARY].mapping)
    return named.select("invoice_no", "invoice_date", "item_code", "dealer_sg_key", "reporting_value")


@WORK.add(
    "matched_rename",
    "SELECT CAST(o_orderkey AS STRING) AS invoice_no, CAST(o_custkey AS STRING) AS customer_code, "
    "o_totalprice AS reporting_value, o_orderpriority AS unknown_thing FROM orders",
)
def matched_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differently spelled names found by the matcher; an unknown name stays."""
    orders = source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Invoice No"),
        F.col("o_custkey").cast("string").alias("CUSTOMER-CODE"),
        F.col("o_totalprice").alias("reporting%value"),
        F.col("o_orderpriority").alias("unknown_thing"),
    )
    return align.rename_matched(orders, SPECS[SECONDARY].types)


@WORK.add(
    "reserved_rename",
    "SELECT l_orderkey AS order_raw, l_linenumber AS key_raw, l_partkey AS part, l_quantity AS range_raw FROM lineitem",
)
def reserved_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        F.col("l_linenumber").alias("key"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("range"),
    )
    return align.rename_reserved(lines)[0]


@WORK.add(
    "align_schema",
    f"""{shape_cte("dim_material")}
    SELECT material_code, material_description, CAST(NULL AS STRING) AS material_type,
        CAST(NULL AS STRING) AS active_flag, sales_group_code, product_group_1_description,
        product_group_2_description, CAST(NULL AS STRING) AS product_group_3_description,
        CAST(NULL AS STRING) AS product_group_5_description
    FROM dim_material""",
)
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another case and order, one too many, some missing."""
    raw = shape(spark, sf_dir, "dim_material").select(
        F.lit("x").alias("junk"),
        F.col("product_group_2_description").alias("PRODUCT_GROUP_2_DESCRIPTION"),
        F.col("sales_group_code").alias("Sales_Group_Code"),
        F.col("material_code").alias("MATERIAL_CODE"),
        "material_description",
        "product_group_1_description",
    )
    return align.align(raw, SPECS["dim_material"].schema).frame


@WORK.add(
    "column_order",
    f"{FACT_CTE} SELECT active_flag, invoice_date, customer_code, invoice_no, item_code FROM {SECONDARY}",
)
def column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = fact(spark, sf_dir).select("item_code", "line_no", "invoice_no", "customer_code", "invoice_date", "active_flag")
    return align.reorder(shuffled, SPECS[SECONDARY].schema.names)


# --- conversion -------------------------------------------------------------

_TEXT_ORDERS = """
    SELECT o_orderkey,
        CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
             WHEN o_orderkey % 29 = 0 THEN ''
             WHEN o_orderkey % 7 = 0 THEN concat('  ', CAST(o_custkey AS STRING), chr(9))
             ELSE CAST(o_custkey AS STRING) END AS customer_text,
        CASE WHEN o_orderkey % 50 = 1 THEN '?'
             ELSE concat(' ', CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING)) END AS price_text,
        CASE WHEN o_orderkey % 50 = 2 THEN 'unknown'
             WHEN o_orderkey % 50 = 3 THEN NULL
             WHEN o_orderkey % 50 = 4 THEN concat(CAST(year(o_orderdate) AS STRING), '-',
                CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING))
             ELSE concat(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/',
                CAST(year(o_orderdate) AS STRING)) END AS day_text,
        CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN '0' ELSE 'maybe' END AS flag_text
    FROM {orders}
"""
_TEXT_CTE = f"WITH text_orders AS ({_own(_TEXT_ORDERS, 'orders')})"


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, _TEXT_ORDERS, "orders")


@WORK.add(
    "clean_numeric",
    f"""{_TEXT_CTE}
    SELECT o_orderkey,
        CAST(TRY_CAST(nullif(regexp_replace(customer_text, '^\\s+|\\s+$', '', 'g'), '') AS BIGINT) AS DOUBLE) AS customer_no,
        TRY_CAST(nullif(regexp_replace(price_text, '^\\s+|\\s+$', '', 'g'), '') AS DOUBLE) AS price
    FROM text_orders""",
)
def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns to numbers while at most a tenth of the values is unreadable."""
    raw = text_orders(spark, sf_dir).select("o_orderkey", "customer_text", "price_text")
    done = convert.convert(raw, {"customer_text": T.LongType(), "price_text": T.DoubleType()}).frame
    return done.select(
        "o_orderkey", F.col("customer_text").cast("double").alias("customer_no"), F.col("price_text").alias("price")
    )


@WORK.add(
    "keep_unconvertible",
    f"""{_TEXT_CTE}
    SELECT o_orderkey, customer_text, TRY_CAST(CAST(o_orderkey AS STRING) AS BIGINT) AS key_text FROM text_orders""",
)
def keep_unconvertible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All or nothing: a column with one unreadable value stays text."""
    raw = text_orders(spark, sf_dir).select(
        "o_orderkey", "customer_text", F.col("o_orderkey").cast("string").alias("key_text")
    )
    targets = {"customer_text": T.LongType(), "key_text": T.LongType()}
    return convert.convert(raw, targets, max_failures=0.0, date_failures=0.1, on_failure="keep").frame


@WORK.add(
    "parse_dates",
    f"""{_TEXT_CTE},
    parsed AS (SELECT o_orderkey, try_strptime(day_text, '%d/%m/%Y') AS d FROM text_orders)
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS order_day FROM parsed""",
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout for the whole column: the first that reads nine tenths of it."""
    raw = text_orders(spark, sf_dir).select("o_orderkey", "day_text")
    done = convert.convert(raw, {"day_text": T.DateType()}).frame
    return done.select("o_orderkey", F.col("day_text").cast("string").alias("order_day"))


@WORK.add(
    "lenient_cast",
    f"""{_TEXT_CTE}
    SELECT CAST(o_orderkey AS STRING) AS order_no, TRY_CAST(trim(price_text) AS DOUBLE) AS price, flag_text
    FROM text_orders""",
)
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = text_orders(spark, sf_dir).select("o_orderkey", "price_text", "flag_text")
    kinds = {"o_orderkey": "str", "price_text": "float", "flag_text": "str"}
    return convert.lenient_types(raw, kinds, {"o_orderkey": "order_no", "price_text": "price"})


@WORK.add(
    "mapped_conversion",
    f"""{FACT_CTE} SELECT invoice_no, invoice_date, reporting_unit, CAST(sales_group_code AS INT) AS sales_group_code
    FROM {SECONDARY}""",
)
def mapped_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from the table declaration; every value must convert."""
    text = fact(spark, sf_dir).select(
        "invoice_no", *[F.col(c).cast("string").alias(c) for c in ("invoice_date", "reporting_unit", "sales_group_code")]
    )
    return convert.convert_mapped(text, SPECS[SECONDARY].schema).frame


@WORK.add(
    "standard_types",
    f"""{_TEXT_CTE}
    SELECT o_orderkey,
        CASE WHEN flag_text IN ('Y', 'Yes', '1', 'True', 'true') THEN 'true'
             WHEN flag_text IN ('N', 'No', '0', 'False', 'false') THEN 'false' END AS flag,
        CAST(CAST(o_totalprice AS DECIMAL(18, 4)) AS DOUBLE) AS amount
    FROM text_orders JOIN orders USING (o_orderkey)""",
)
def standard_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True / false words to flags, amounts to the standard decimal."""
    prices = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    joined = text_orders(spark, sf_dir).join(prices, "o_orderkey")
    return joined.select(
        "o_orderkey",
        flag("flag_text").cast("string").alias("flag"),
        standard_decimal("o_totalprice").cast("double").alias("amount"),
    )


# --- filters ----------------------------------------------------------------


@WORK.add(
    "date_cutoff",
    f"{FACT_CTE} SELECT invoice_no, invoice_date, reporting_value FROM {SECONDARY} WHERE invoice_date >= {CUTOFF}",
)
def date_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.from_day(fact(spark, sf_dir), "invoice_date", CUTOFF).select(
        "invoice_no", "invoice_date", "reporting_value"
    )


@WORK.add(
    "detail_cutoff",
    f"""{shape_cte("fact_invoice_details")}
    SELECT order_no, posting_date, mis_type FROM fact_invoice_details
    WHERE posting_date > {CUTOFF - 1} AND reason_code LIKE 'RT%' AND trim(invoice_no) <> ''""",
)
def detail_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = filters.after_day(shape(spark, sf_dir, "fact_invoice_details"), "posting_date", CUTOFF - 1)
    kept = details.filter(F.col("reason_code").like("RT%") & filters.not_blank("invoice_no"))
    return kept.select("order_no", "posting_date", "mis_type")


@WORK.add(
    "allowed_members",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def allowed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = source(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return filters.members(orders, "o_custkey", allowed, "c_custkey")


# --- computed columns -------------------------------------------------------


@WORK.add(
    "concat_key",
    f"""{shape_cte("fact_invoice_details")}
    SELECT order_no, CAST(posting_date AS STRING) || '_' || customer_code || '_' || coalesce(invoice_no, 'NULL')
        || '_' || mis_type || '_' || CAST(item_number AS STRING) AS fid_pd_cc_in_mt_in
    FROM fact_invoice_details""",
)
def concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key with missing parts spelled out."""
    details = shape(spark, sf_dir, "fact_invoice_details")
    out, _ = computed.add_computed(details, SPECS["fact_invoice_details"].computed)
    return out.select("order_no", "fid_pd_cc_in_mt_in")


@WORK.add(
    "concat_policies",
    f"""{shape_cte("fact_invoice_details")}
    SELECT order_no,
        concat_ws('|', customer_code, invoice_no, CAST(division_code AS STRING)) AS skipped,
        concat_ws('|', customer_code, coalesce(invoice_no, ''), coalesce(CAST(division_code AS STRING), '')) AS emptied,
        customer_code || '|' || invoice_no || '|' || CAST(division_code AS STRING) AS nulled
    FROM fact_invoice_details""",
)
def concat_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"type": "concatenation", "columns": ["customer_code", "invoice_no", "division_code"], "separator": "|"}
    definitions = {
        "skipped": parts | {"nulls": "skip"},
        "emptied": parts | {"nulls": "empty_string"},
        "nulled": parts | {"nulls": "null"},
    }
    out, _ = computed.add_computed(shape(spark, sf_dir, "fact_invoice_details"), definitions)
    return out.select("order_no", *definitions)


@WORK.add(
    "hierarchy_key",
    f"""{shape_cte("dim_material_mapping", "dim_customer_master")}
    SELECT 'material' AS kind, material_code AS code, brand || '|' || product_group_1_description || '|' ||
        parent_division_code AS label FROM dim_material_mapping
    UNION ALL
    SELECT 'customer', customer_code, zone || ' > ' || region || ' > ' || wss_territory_name FROM dim_customer_master
    UNION ALL
    SELECT 'name', customer_code, customer_code || ' - ' || customer_name FROM dim_customer_master""",
)
def hierarchy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with ``|``, paths with ``>``, code - name labels."""
    materials = shape(spark, sf_dir, "dim_material_mapping")
    customers = shape(spark, sf_dir, "dim_customer_master")

    def labelled(df: DataFrame, kind: str, code: str, columns: list[str], separator: str) -> DataFrame:
        definition = {"label": {"type": "concatenation", "columns": columns, "separator": separator}}
        out, _ = computed.add_computed(df, definition)
        return out.select(F.lit(kind).alias("kind"), F.col(code).alias("code"), "label")

    return align.union_all(
        [
            labelled(materials, "material", "material_code", ["brand", "product_group_1_description", "parent_division_code"], "|"),
            labelled(customers, "customer", "customer_code", ["zone", "region", "wss_territory_name"], " > "),
            labelled(customers, "name", "customer_code", ["customer_code", "customer_name"], " - "),
        ]
    )


@WORK.add(
    "calculated_metrics",
    """SELECT l_orderkey, l_linenumber, l_quantity * l_tax AS total_sales_amount,
        l_extendedprice * l_discount AS discount_amount,
        l_extendedprice - l_extendedprice * l_discount + l_tax AS net_amount,
        CASE WHEN l_extendedprice > 0 THEN l_extendedprice * l_discount / l_extendedprice * CAST(100 AS DOUBLE) ELSE 0 END
            AS discount_percentage,
        CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity ELSE 0 END AS unit_price
    FROM lineitem""",
)
def calculated_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas that build on each other, in whatever order they are declared."""
    lines = source(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_extendedprice": "gross_amount", "l_quantity": "quantity", "l_tax": "rate"}
    )
    definitions = {
        "discount_percentage": {
            "type": "calculation",
            "formula": "CASE WHEN gross_amount > 0 THEN discount_amount / gross_amount * CAST(100 AS DOUBLE) ELSE 0 END",
            "columns": ["discount_amount", "gross_amount"],
        },
        "net_amount": {"type": "calculation", "formula": "gross_amount - discount_amount + rate"},
        "discount_amount": {"type": "calculation", "formula": "gross_amount * l_discount"},
        "total_sales_amount": {"type": "calculation", "formula": "quantity * rate"},
        "unit_price": {
            "type": "calculation",
            "formula": "CASE WHEN quantity > 0 THEN gross_amount / quantity ELSE 0 END",
            "columns": ["gross_amount", "quantity"],
        },
    }
    out, _ = computed.add_computed(lines, definitions)
    return out.select("l_orderkey", "l_linenumber", *definitions)


@WORK.add(
    "classify",
    f"""{shape_cte("dim_material")}
    SELECT m.material_code,
        CASE m.material_type WHEN 'ZFGD' THEN 'Finished Goods' WHEN 'ZRAW' THEN 'Raw Materials'
            WHEN 'ZPAK' THEN 'Packaging' ELSE 'Other' END AS material_category,
        CASE WHEN p.p_retailprice > 1000 THEN 'Premium' WHEN p.p_retailprice > 950 THEN 'Standard' ELSE 'Budget' END
            AS price_category
    FROM dim_material m JOIN part p ON CAST(p.p_partkey AS STRING) = m.material_code""",
)
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = source(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("material_code"), F.col("p_retailprice").alias("unit_price")
    )
    materials = shape(spark, sf_dir, "dim_material").join(prices, "material_code")
    out, _ = computed.add_computed(
        materials,
        {
            "material_category": {
                "type": "classification",
                "column": "material_type",
                "labels": {"ZFGD": "Finished Goods", "ZRAW": "Raw Materials", "ZPAK": "Packaging"},
                "default": "Other",
            },
            "price_category": {
                "type": "bands",
                "column": "unit_price",
                "steps": [(1000, "Premium"), (950, "Standard")],
                "default": "Budget",
            },
        },
    )
    return out.select("material_code", "material_category", "price_category")


@WORK.add(
    "fiscal_calendar",
    f"""{FACT_CTE},
    dated AS (
        SELECT *, invoice_date // 10000 AS y, (invoice_date // 100) % 100 AS m FROM {SECONDARY})
    SELECT CAST(CASE WHEN m >= 4 THEN y ELSE y - 1 END AS INT) AS fiscal_year,
        CASE WHEN m IN (4, 5, 6) THEN 'Q1' WHEN m IN (7, 8, 9) THEN 'Q2' WHEN m IN (10, 11, 12) THEN 'Q3' ELSE 'Q4' END
            AS fiscal_quarter,
        count(*) AS line_count, CAST(sum(CAST(reporting_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales
    FROM dated GROUP BY 1, 2""",
)
def fiscal_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = computed.add_computed(
        fact(spark, sf_dir),
        {
            "fiscal_year": {"type": "fiscal_year", "column": "invoice_date"},
            "fiscal_quarter": {"type": "fiscal_quarter", "column": "invoice_date"},
        },
    )
    return out.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("sales"),
    )


@WORK.add(
    "days_since_invoice",
    "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-31') AS days FROM orders",
)
def days_since_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey", dates.int_date("o_orderdate").alias("invoice_date"))
    definition = {"days": {"type": "days_since", "column": "invoice_date", "as_of": dt.date(2024, 1, 31)}}
    return computed.add_computed(orders, definition)[0].select("o_orderkey", F.col("days").cast("bigint").alias("days"))


@WORK.add(
    "lookup_column",
    "SELECT o_orderkey, o_custkey, c_name AS customer_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 1",
)
def lookup_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value from a reference table; the last key has none."""
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") + 1).alias("next_key"))
    definition = {
        "customer_name": {"type": "lookup", "table": "customers", "on": "next_key", "key": "c_custkey", "value": "c_name"}
    }
    out, _ = computed.add_computed(orders, definition, {"customers": source(spark, sf_dir, "customer")})
    return out.drop("next_key")


# --- records ----------------------------------------------------------------


@WORK.add(
    "ytd_sales",
    f"""{FACT_CTE},
    dated AS (
        SELECT *, CAST(invoice_date // 10000 - CASE WHEN (invoice_date // 100) % 100 < 4 THEN 1 ELSE 0 END AS INT)
            AS fiscal_year FROM {SECONDARY})
    SELECT invoice_no, line_no, invoice_date, fiscal_year,
        CAST(sum(CAST(reporting_value AS DECIMAL(18, 4))) OVER (PARTITION BY fiscal_year ORDER BY invoice_date)
            AS DOUBLE) AS ytd_sales
    FROM dated""",
)
def ytd_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir).select(
        "invoice_no",
        "line_no",
        "invoice_date",
        dates.fiscal_year("invoice_date").alias("fiscal_year"),
        F.col("reporting_value").cast("decimal(18,4)").alias("_sales"),
    )
    out = records.running_total(rows, "fiscal_year", "invoice_date", "_sales", "ytd_sales")
    return out.drop("_sales").withColumn("ytd_sales", F.col("ytd_sales").cast("double"))


_TIES = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"


@WORK.add(
    "dedup_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_TIES}) AS rn FROM lineitem) r
    WHERE rn = 1""",
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in _TIES.split(", ")]
    kept = records.first_per_key(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@WORK.add(
    "dedup_keep_last",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY {_TIES.replace(",", " DESC,")} DESC) AS rn FROM lineitem) r
    WHERE rn = 1""",
)
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c).desc() for c in _TIES.split(", ")]
    kept = records.first_per_key(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@WORK.add(
    "union_distinct",
    """SELECT c_nationkey AS nation_key, c_mktsegment AS label FROM customer
    UNION SELECT n_nationkey, n_name FROM nation UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier""",
)
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pair(table: str, key: str, label: Column) -> DataFrame:
        return source(spark, sf_dir, table).select(F.col(key).alias("nation_key"), label.alias("label"))

    return records.distinct_union(
        [
            pair("customer", "c_nationkey", F.col("c_mktsegment")),
            pair("nation", "n_nationkey", F.col("n_name")),
            pair("supplier", "s_nationkey", F.lit("SUPPLIER")),
        ]
    )


_TYPED_TARGETS = {"invoice_no": "BIGINT", "customer_group": "BIGINT", "cm_customer_group": "VARCHAR(20)", "reporting_value": "DOUBLE", "town": "VARCHAR(9)"}


@WORK.add(
    "typed_match",
    """SELECT o_orderkey AS invoice_no, o_orderkey + 1 AS "Invoice No", o_custkey AS customer_group, o_orderpriority AS cm_customer_group,
        o_totalprice AS reporting_value, o_orderstatus AS town FROM orders""",
)
def typed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One target per column: exact before squashed, a misspelled one, one by its prefix and type, one by its beginning."""
    orders = source(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("Invoice No"),
        F.col("o_orderkey").alias("invoice_no"),
        F.col("o_orderpriority").alias("customer group"),
        F.col("o_custkey").alias("Customer-Group"),
        F.col("o_totalprice").alias("reportng_value"),
        F.col("o_orderstatus").alias("tow"),
    )
    return align.rename_matched(orders, _TYPED_TARGETS, prefixes=["cm"])


_HEADER_TARGETS = {"invoice_no": "BIGINT", "customer_group": "BIGINT", "customergroup": "VARCHAR(20)", "order_raw": "VARCHAR(15)", "reporting_value": "DOUBLE"}


@WORK.add(
    "header_findings",
    """SELECT 0 AS place, 'Invoice No' AS column_name, 'invoiceno' AS match_key, 'invoiceno' AS lookup_key, 'invoice_no' AS target,
        'invoice_no' AS same_key, 'not snake_case' AS problems, count(o_orderkey) AS filled FROM orders
    UNION ALL SELECT 1, 'Customer-Group', 'customergroup', 'customergroup', 'customer_group', 'customer_group,customergroup',
        'not snake_case', count(*) FILTER (WHERE o_custkey % 3 <> 0) FROM orders
    UNION ALL SELECT 2, 'ORDER', 'order', 'order_raw', NULL, '', 'not snake_case, reserved word',
        count(*) FILTER (WHERE o_orderstatus <> 'P') FROM orders
    UNION ALL SELECT 3, 'rank', 'rank', 'rank_raw', NULL, '', 'reserved word', count(*) FILTER (WHERE o_orderpriority LIKE '1%') FROM orders
    UNION ALL SELECT 4, 'reportng_value', 'reportngvalue', 'reportngvalue', 'reporting_value', '', '', count(o_totalprice) FROM orders
    UNION ALL SELECT 5, repeat('remark_', 10), repeat('remark', 10), repeat('remark', 10), NULL, '', 'too long', count(*) FILTER (WHERE o_orderdate >= DATE '1995-06-01') FROM orders""",
)
def header_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a feed's header is understood, which names break the rules, and how many values each column carries."""
    feed = source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Invoice No"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("Customer-Group"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("ORDER"),
        F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("rank"),
        F.col("o_totalprice").alias("reportng_value"),
        F.when(F.col("o_orderdate") >= dt.date(1995, 6, 1), "late").alias("remark_" * 10),
    )
    return names.explain_header(feed, _HEADER_TARGETS).withColumn("same_key", F.array_join("same_key", ","))


_CHECKED = {
    "margin_share": {"type": "calculation", "formula": "margin / nullif(price, 0)"},
    "margin": {"type": "calculation", "formula": "price - cost"},
    "freight_share": {"type": "calculation", "formula": "freight / nullif(price, 0)"},
    "label": {"type": "concatenation", "columns": ["part", "supplier"], "separator": "_"},
}


@WORK.add(
    "definition_checks",
    """SELECT 'margin_share' AS name, '' AS missing, count(*) FILTER (WHERE l_extendedprice <> 0 AND l_discount > 0) AS filled FROM lineitem
    UNION ALL SELECT 'margin', '', count(*) FILTER (WHERE l_discount > 0) FROM lineitem
    UNION ALL SELECT 'freight_share', 'freight', 0
    UNION ALL SELECT 'label', '', count(*) FROM lineitem""",
)
def definition_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions in any order: what they lack, and how many rows get a value from those that can be computed."""
    lines = source(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("price"),
        F.expr("if(l_discount > 0, l_extendedprice * (1 - l_discount), null)").alias("cost"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
    )
    return computed.definition_report(lines, _CHECKED)
