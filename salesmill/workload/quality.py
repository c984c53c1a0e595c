"""Data-quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ddl import struct_from_ddl
from ..operators import convert, quality, records
from ..samples import shape, shape_cte, source
from . import Workload
from .shaping import _own, _raw

WORK = Workload()

# Orders as a feed with the faults the rules look for.
_FEED = """
    SELECT o_orderkey AS row_id,
        CASE WHEN o_orderkey % 41 <> 0 THEN
            CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) END AS invoice_date,
        CASE WHEN o_orderkey % 43 = 0 THEN concat('inv ', CAST(o_orderkey AS STRING))
             ELSE concat('INV', lpad(CAST(o_orderkey AS STRING), 8, '0')) END AS invoice_no,
        CASE WHEN o_orderkey % 47 <> 0 THEN lpad(CAST(o_custkey AS STRING), 6, '0') END AS customer_code,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS dealer_name,
        CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS amount,
        CAST(o_custkey % 100 - 5 AS BIGINT) AS quantity
    FROM {orders}
"""
_FEED_CTE = f"WITH feed AS ({_own(_FEED, 'orders')})"
AS_OF = dt.date(2001, 1, 1)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, _FEED, "orders")


def feed_rules() -> list[quality.Rule]:
    return [
        quality.required("invoice_date", "skip_row"),
        quality.required("customer_code", "skip_row"),
        quality.required("dealer_name", "warn"),
        quality.matches("invoice_no"),
        quality.in_range("amount", "amount", "convert_to_null"),
        quality.in_range("quantity", "quantity", "use_default"),
        quality.plausible_day("invoice_date", AS_OF),
    ]


_BROKEN = {
    "invoice_date_missing": "invoice_date IS NULL",
    "customer_code_missing": "customer_code IS NULL",
    "dealer_name_missing": "dealer_name IS NULL",
    "invoice_no_pattern": "NOT regexp_matches(invoice_no, '^[A-Z0-9]{8,20}$')",
    "amount_range": "NOT (amount BETWEEN 0 AND 9999999999.99)",
    "quantity_range": "NOT (quantity BETWEEN 0 AND 999999999)",
    "invoice_date_day": "NOT (invoice_date BETWEEN 19000101 AND 20010101)",
}


@WORK.add(
    "column_profile",
    _FEED_CTE
    + " UNION ALL ".join(
        f"""SELECT count(*) AS row_count, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
            {f"CAST(min({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"} AS min_value,
            {f"CAST(max({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"} AS max_value,
            {"CAST(NULL AS DOUBLE)" if numeric else f"CAST(max(octet_length(encode({c}))) AS DOUBLE)"} AS max_bytes
        FROM feed """
        for c, numeric in (
            ("row_id", True),
            ("invoice_date", True),
            ("invoice_no", False),
            ("customer_code", False),
            ("dealer_name", False),
            ("amount", True),
            ("quantity", True),
        )
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = convert.profile(feed(spark, sf_dir))
    return profile.withColumn("max_bytes", F.col("max_bytes").cast("double"))




@WORK.add(
    "varchar_overflow",
    """WITH sized AS (
        SELECT 'text' AS column_name, 5000 AS declared_bytes, max(octet_length(encode(text))) AS max_bytes FROM documents
        UNION ALL SELECT 'lang', 2, max(octet_length(encode(lang))) FROM documents
        UNION ALL SELECT 'source', 3, max(octet_length(encode(source))) FROM documents)
    SELECT column_name, CAST(declared_bytes AS BIGINT) AS declared_bytes, CAST(max_bytes AS BIGINT) AS max_bytes,
        CAST(floor(max_bytes * CAST(1.2 AS DOUBLE)) AS BIGINT) AS proposed_bytes
    FROM sized WHERE max_bytes > declared_bytes""",
)
def varchar_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts measured in bytes against declared limits."""
    declared = struct_from_ddl("text VARCHAR(5000), lang VARCHAR(2), source VARCHAR(3)")
    return quality.text_overflows(source(spark, sf_dir, "documents"), declared)


@WORK.add(
    "int_overflow",
    """WITH sized AS (
        SELECT 'l_orderkey' AS column_name, 'TINYINT' AS declared, min(l_orderkey) AS min_value,
            max(l_orderkey) AS max_value, -128 AS low, 127 AS high FROM lineitem
        UNION ALL SELECT 'l_linenumber', 'TINYINT', min(l_linenumber), max(l_linenumber), -128, 127 FROM lineitem
        UNION ALL SELECT 'l_partkey', 'SMALLINT', min(l_partkey) * 40, max(l_partkey) * 40, -32768, 32767 FROM lineitem)
    SELECT column_name, declared, CAST(min_value AS BIGINT) AS min_value, CAST(max_value AS BIGINT) AS max_value
    FROM sized WHERE min_value < low OR max_value > high""",
)
def int_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 40).alias("l_partkey")
    )
    declared = struct_from_ddl("l_orderkey TINYINT, l_linenumber TINYINT, l_partkey SMALLINT")
    return quality.int_overflows(lines, declared)


@WORK.add(
    "rule_counts",
    _FEED_CTE
    + " UNION ALL ".join(
        f"SELECT count(*) AS row_count, '{r}' AS rule, CAST(count(*) FILTER ({c}) AS BIGINT) AS violations FROM feed "
        for r, c in _BROKEN.items()
    ),
)
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, pattern, range and date rules counted in one pass."""
    rules = feed_rules()
    flagged = quality.flag(feed(spark, sf_dir), rules)
    return quality.rule_counts(flagged, rules).select("row_count", "rule", "violations")


@WORK.add(
    "null_rules",
    _FEED_CTE
    + " UNION ALL ".join(
        f"SELECT '{c}_missing' AS rule, '{a}' AS action, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS violations FROM feed "
        for c, a in (("invoice_date", "fail"), ("invoice_no", "fail"), ("customer_code", "fail"), ("dealer_name", "warn"))
    ),
)
def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feed(spark, sf_dir)
    rules = [quality.required(c) for c in quality.NEVER_NULL if c in df.columns]
    rules += [quality.required(c, "warn") for c in quality.SELDOM_NULL if c in df.columns]
    return quality.rule_counts(quality.flag(df, rules), rules).select("rule", "action", "violations")


@WORK.add(
    "pattern_rules",
    f"""{_FEED_CTE}
    SELECT row_id, invoice_no, customer_code,
        concat_ws(',', CASE WHEN NOT regexp_matches(invoice_no, '^[A-Z0-9]{{8,20}}$') THEN 'invoice_no_pattern' END,
            CASE WHEN NOT regexp_matches(customer_code, '^[A-Z0-9]{{4,12}}$') THEN 'customer_code_pattern' END,
            CASE WHEN NOT regexp_matches(dealer_name, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')
                THEN 'dealer_name_pattern' END) AS broken
    FROM feed""",
)
def pattern_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        quality.matches("invoice_no"),
        quality.matches("customer_code"),
        quality.matches("dealer_name", quality.PATTERNS["email"]),
    ]
    flagged = quality.flag(feed(spark, sf_dir), rules)
    return flagged.select("row_id", "invoice_no", "customer_code", F.array_join(quality.VIOLATIONS, ",").alias("broken"))


@WORK.add(
    "range_rules",
    f"""{_FEED_CTE}
    SELECT row_id, CASE WHEN amount < 0 OR amount > 9999999999.99 THEN NULL ELSE amount END AS amount,
        CASE WHEN quantity < 0 OR quantity > 999999999 THEN 0 ELSE quantity END AS quantity
    FROM feed""",
)
def range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside their range become the default or NULL, as the rule says."""
    rules = [
        quality.in_range("amount", "amount", "convert_to_null"),
        quality.in_range("quantity", "quantity", "use_default"),
    ]
    return quality.flag(feed(spark, sf_dir), rules).select("row_id", "amount", "quantity")


_ALL_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in _BROKEN.items()) + ")"
_STOPS = " OR ".join(f"coalesce({_BROKEN[r]}, false)" for r in ("invoice_date_missing", "customer_code_missing", "invoice_date_day"))


@WORK.add(
    "error_gate_split",
    f"""{_FEED_CTE}
    SELECT row_id, CASE WHEN {_STOPS} THEN 'rejected' ELSE 'accepted' END AS status,
        CASE WHEN {_STOPS} THEN {_ALL_REASONS} ELSE '' END AS reasons
    FROM feed""",
)
def error_gate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows; the latter with every rule they break. One scan."""
    rules = feed_rules()
    flagged = quality.flag(feed(spark, sf_dir), rules)
    stop = quality.rejected(rules)
    return flagged.select(
        "row_id",
        F.when(stop, "rejected").otherwise("accepted").alias("status"),
        F.when(stop, F.array_join(quality.VIOLATIONS, ",")).otherwise("").alias("reasons"),
    )


@WORK.add(
    "orphan_keys",
    f"""{shape_cte("fact_invoice_secondary", "dim_dealer_master")}
    SELECT dealer_sg_key, count(*) AS fact_rows FROM fact_invoice_secondary f
    WHERE NOT EXISTS (
        SELECT 1 FROM dim_dealer_master d WHERE d.active_flag = 'True' AND d.dealer_sg_key = f.dealer_sg_key)
    GROUP BY dealer_sg_key""",
)
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose dealer is not among the active ones."""
    active = shape(spark, sf_dir, "dim_dealer_master").filter(F.col("active_flag") == "True")
    return quality.orphans(shape(spark, sf_dir, "fact_invoice_secondary"), active, "dealer_sg_key", "dealer_sg_key")


@WORK.add(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.repeated_keys(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@WORK.add(
    "fan_out_keys",
    f"{shape_cte('dim_hierarchy')} SELECT sh_2_code, count(*) AS copies FROM dim_hierarchy GROUP BY 1 HAVING count(*) > 1",
)
def fan_out_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension keys that would multiply fact rows in a join."""
    return records.repeated_keys(shape(spark, sf_dir, "dim_hierarchy"), ["sh_2_code"])


_MESSY = """
    SELECT c_custkey AS row_id, concat(' ', lower(c_name), chr(9)) AS customer_code,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE concat(c_mktsegment, '@Example.COM ') END AS email,
        CASE WHEN c_nationkey = 1 THEN CAST('Infinity' AS DOUBLE) WHEN c_nationkey = 2 THEN CAST('NaN' AS DOUBLE)
             WHEN c_nationkey = 3 THEN CAST('-Infinity' AS DOUBLE) ELSE c_acctbal / 7 END AS balance
    FROM {customer}
"""


@WORK.add(
    "standardise",
    f"""WITH messy AS ({_own(_MESSY, "customer")})
    SELECT row_id, upper(nullif(regexp_replace(customer_code, '^\\s+|\\s+$', '', 'g'), '')) AS customer_code,
        lower(nullif(regexp_replace(email, '^\\s+|\\s+$', '', 'g'), '')) AS email,
        CASE WHEN isfinite(balance) THEN round(balance, 2) END AS balance
    FROM messy""",
)
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.standardise(_raw(spark, sf_dir, _MESSY, "customer"))


_RUNS = "SELECT year(o_orderdate) * 12 + month(o_orderdate) AS run, count(*) AS rows FROM {orders} GROUP BY 1"


@WORK.add(
    "volume_change",
    f"""WITH runs AS ({_own(_RUNS, "orders")}),
    compared AS (
        SELECT a.run, a.rows, b.rows AS previous_rows, a.rows / nullif(b.rows, 0) AS ratio
        FROM runs a JOIN runs b ON b.run + 1 = a.run)
    SELECT CAST(run AS INT) AS run, rows, previous_rows, ratio,
        CASE WHEN ratio > 1.5 THEN 'increase' WHEN ratio < 0.5 THEN 'decrease' ELSE 'none' END AS alert
    FROM compared""",
)
def volume_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's volume against the month before."""
    runs = _raw(spark, sf_dir, _RUNS, "orders").withColumn("run", F.col("run").cast("int"))
    previous = runs.withColumn("run", F.col("run") + 1)
    return quality.volume_alerts(runs, previous, "run")


@WORK.add(
    "retention",
    """SELECT o_orderkey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS load_day
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 365""",
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded within the last year of the given day."""
    from ..functions.dates import int_date

    orders = source(spark, sf_dir, "orders").select("o_orderkey", int_date("o_orderdate").alias("load_day"))
    return quality.within_retention(orders, "load_day", dt.date(2001, 8, 1), 365)


@WORK.add(
    "audit_columns",
    """SELECT n_nationkey, n_name, 'SYSTEM' AS created_by, 'SYSTEM' AS updated_by, 'nation.parquet' AS source_file,
        'erp' AS source_system, '2024-01-31 06:00:00' AS load_timestamp, 'b-1' AS load_batch_id FROM nation""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage taken from the file each row came from."""
    nations = source(spark, sf_dir, "nation")
    out = quality.audit_columns(
        nations.select("n_nationkey", "n_name", "_metadata.file_name"),
        "b-1",
        dt.datetime(2024, 1, 31, 6, tzinfo=dt.timezone.utc),
        "erp",
        source_file=F.col("file_name"),
    )
    stamp = F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss").alias("load_timestamp")
    return out.select(
        "n_nationkey", "n_name", "created_by", "updated_by", "source_file", "source_system", stamp, "load_batch_id"
    )
