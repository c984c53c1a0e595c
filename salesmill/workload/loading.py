"""Load modes, as plans and through stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import load
from ..operators.load import Table
from ..plans.ingest import load_checked
from ..samples import shape, shape_cte, source
from ..session import scratch
from . import Workload
from .quality import _FEED_CTE, _STOPS, feed, feed_rules
from .sales import CONFIG, RUN_DATE, _DD_SELECT, CUTOFF

WORK = Workload()

SECONDARY = "fact_invoice_secondary"


@WORK.add(
    "upsert",
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 10 THEN -1.0 ELSE c_acctbal END AS c_acctbal
    FROM customer
    UNION ALL SELECT s_suppkey + 100000000, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed and new records against stored ones."""
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    stored = source(spark, sf_dir, "customer").select(columns)
    changed = stored.filter(F.col("c_nationkey") < 10).withColumn("c_acctbal", F.lit(-1.0))
    new = source(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 100000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return load.upserted(stored, changed.unionByName(new), ["c_custkey"])


@WORK.add(
    "insert_ignore",
    """SELECT s_suppkey AS code, s_name AS name FROM supplier
    WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""",
)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = source(spark, sf_dir, "customer").filter(F.col("c_nationkey") < 20).select(F.col("c_custkey").alias("code"))
    arriving = source(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"))
    return load.new_only(stored, arriving, ["code"])


_COLUMNS = "invoice_no, sales_group_code, record_type, reporting_value"


@WORK.add(
    "replace_slice",
    f"""{shape_cte(SECONDARY)},
    marked AS (SELECT *, CASE WHEN line_no = 3 THEN NULL ELSE record_type END AS kind FROM {SECONDARY})
    SELECT invoice_no, sales_group_code, kind AS record_type, reporting_value FROM marked
    WHERE NOT coalesce(sales_group_code IN (7, 12) AND kind <> 'DD', false)
    UNION ALL
    SELECT invoice_no, sales_group_code, 'NEW', 0.0 FROM {SECONDARY} WHERE sales_group_code = 12""",
)
def replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales groups exchanged; rows for which the condition is NULL stay."""
    fact = shape(spark, sf_dir, SECONDARY)
    kind = F.when(F.col("line_no") != 3, F.col("record_type"))
    columns = _COLUMNS.split(", ")
    stored = fact.withColumn("record_type", kind).select(columns)
    arriving = fact.filter(F.col("sales_group_code") == 12).select(columns)
    arriving = arriving.withColumns({"record_type": F.lit("NEW"), "reporting_value": F.lit(0.0)})
    return load.slice_replaced(stored, arriving, load.group_slice(["7", "12"]))


@WORK.add(
    "stored_dd_refresh",
    f"""{shape_cte(SECONDARY, "fact_invoice_details")},
    dd AS ({_DD_SELECT} WHERE active_flag = '1' AND posting_date >= {CUTOFF}
        AND (mis_type IN ('CN', 'INV') OR (mis_type = 'FCN' AND reason_code IN ('RTDIF', 'SLPMT')))),
    joined AS (
        SELECT record_type, sales_group_code, reporting_value FROM {SECONDARY}
        UNION ALL SELECT record_type, sales_group_code, reporting_value FROM dd)
    SELECT record_type, sales_group_code, count(*) AS line_count,
        CAST(sum(CAST(reporting_value AS DECIMAL(18, 4))) AS DOUBLE) AS reporting_value
    FROM joined GROUP BY record_type, sales_group_code""",
)
def stored_dd_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived records exchanged twice in a stored, partitioned table: a rerun adds nothing."""
    from ..operators.align import conform
    from ..plans.derived import refresh_dd
    from ..tables import SPECS

    spec = SPECS[SECONDARY]
    target = Table(spark, scratch(spark, SECONDARY))
    target.replace(shape(spark, sf_dir, SECONDARY), spec.partition_by, lambda rows: conform(rows, spec.schema))
    details = shape(spark, sf_dir, "fact_invoice_details")
    refresh_dd(details, target, CONFIG, RUN_DATE)
    refresh_dd(details, target, CONFIG, RUN_DATE)
    return (
        target.read()
        .groupBy("record_type", "sales_group_code")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("reporting_value"),
        )
    )


@WORK.add(
    "checked_load",
    f"""{_FEED_CTE}
    SELECT row_id, CASE WHEN amount < 0 THEN NULL ELSE amount END AS amount,
        CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS quantity
    FROM feed WHERE NOT ({_STOPS})""",
)
def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, quarantine, gate and publication in one pass; returns the published rows."""
    df = feed(spark, sf_dir)
    target = Table(spark, scratch(spark, "checked"))
    load_checked(df, target, df.schema, feed_rules(), max_error_ratio=0.5, mode="replace", table="feed")
    return target.read().select("row_id", "amount", "quantity")


@WORK.add(
    "load_summary",
    f"""{_FEED_CTE}
    SELECT 'feed' AS table_name, count(*) AS row_count, count(*) FILTER (NOT ({_STOPS})) AS loaded,
        count(*) FILTER ({_STOPS}) AS rejected FROM feed""",
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feed(spark, sf_dir)
    target = Table(spark, scratch(spark, "summary"))
    report = load_checked(df, target, df.schema, feed_rules(), max_error_ratio=0.5, mode="replace", table="feed")
    return report.frame(spark).select("table_name", "row_count", "loaded", "rejected")
