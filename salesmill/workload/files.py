"""Sources and sinks, exercised on copies of the given tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import int_date
from ..functions.ddl import struct_from_ddl
from ..operators.load import REJECTED, Table
from ..samples import source
from ..session import scratch
from ..sources import files, routing
from ..streaming.drops import ingest_new
from . import Workload

WORK = Workload()


def _orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "orders").select(
        int_date("o_orderdate").cast("string").alias("invoicedate"),
        F.col("o_orderkey").cast("string").alias("invoiceno"),
        F.col("o_custkey").cast("string").alias("customercode"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("remarks"),
    )


_TEXT_SQL = """
    SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS invoicedate,
        CAST(o_orderkey AS STRING) AS invoiceno, CAST(o_custkey AS STRING) AS customercode,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS remarks
    FROM orders
"""


@WORK.add("csv_ingest", f"SELECT * FROM ({_TEXT_SQL}) t WHERE invoicedate > 19980331")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drops (gzip) to Parquet, with the old days left out on the way."""
    folder = scratch(spark, "csv")
    _orders_text(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(f"{folder}/in")
    columns = ["invoicedate", "invoiceno", "customercode", "remarks"]
    files.csv_to_parquet(spark, f"{folder}/in", f"{folder}/out", "invoicedate", 19980331, columns)
    return files.read_parquet(spark, f"{folder}/out")


@WORK.add("delimited_export", _TEXT_SQL)
def delimited_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export with control-character separator and NULL marker, read back."""
    folder = scratch(spark, "export")
    rows = _orders_text(spark, sf_dir).withColumn("invoicedate", F.col("invoicedate").cast("int"))
    files.write_delimited(rows, folder)
    return files.read_delimited(spark, folder, rows.schema)


@WORK.add(
    "multi_folder_union",
    """SELECT s_suppkey AS code, s_name AS name, CAST(NULL AS STRING) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""",
)
def multi_folder_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table fed by two folders with different columns."""
    folder = scratch(spark, "folders")
    source(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    ).write.parquet(f"{folder}/a")
    source(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name")).write.parquet(
        f"{folder}/b"
    )
    return files.read_folders(spark, f"{folder}/a", f"{folder}/b")


@WORK.add(
    "file_inventory",
    """SELECT 'customer.parquet' AS file_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders.parquet', count(*) FROM orders
    UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem""",
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "orders", "lineitem")
    parts = [files.inventory(source(spark, sf_dir, n)) for n in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("file_name", "row_count")


@WORK.add(
    "routed_rows",
    """SELECT CASE WHEN event_type = 'click' THEN 'fact_invoice_secondary' WHEN event_type = 'view' THEN
        'dim_material_mapping' WHEN event_type = 'error' THEN 'dim_material' ELSE 'fact_invoice_details' END AS table_name,
        CASE WHEN event_type = 'click' THEN '107,112' WHEN event_type = 'view' THEN '' WHEN event_type = 'error' THEN '9999'
            ELSE '901' END AS groups, count(*) AS row_count
    FROM events GROUP BY 1, 2""",
)
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and group codes read off file stems, row by row."""
    kind = F.col("event_type")
    stem = (
        F.when(kind == "click", "FactInvoiceSecondary_107_112")
        .when(kind == "view", "DimMaterialMapping")
        .when(kind == "error", "DimMaterial_9999")
        .otherwise("FactInvoiceDetails_901")
    )
    rows = source(spark, sf_dir, "events").select(stem.alias("stem"))
    routed = rows.select(
        routing.table_column("stem").alias("table_name"),
        F.array_join(routing.sales_groups_column("stem"), ",").alias("groups"),
    )
    return routed.groupBy("table_name", "groups").agg(F.count(F.lit(1)).alias("row_count"))


@WORK.add(
    "drop_entities",
    """SELECT CASE event_type WHEN 'click' THEN 'DimDealerMaster' WHEN 'view' THEN 'FactInvoiceSecondary'
        WHEN 'error' THEN 'DimMaterial' ELSE 'DimCustomerMaster' END AS entity,
        count(*) AS drops, min(strftime(ts, '%Y_%m_%d')) AS first_day
    FROM events GROUP BY 1""",
)
def drop_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities read off the names of drops that carry a sequence number and a time, row by row."""
    day = F.date_format("ts", "yyyy_MM_dd")
    kind = F.when(F.col("event_type") == "click", "DimDealer_MS").when(F.col("event_type") == "view", "fact_invoice_SECONDARY")
    kind = kind.when(F.col("event_type") == "error", "dimMaterial").otherwise("dim_customer_master")
    name = F.concat(kind, F.lit("_"), (F.col("event_id") % 90000 + 1000).cast("string"), F.lit("_"), day, F.lit("_14:01:37.parquet"))
    drops = source(spark, sf_dir, "events").select(routing.entity_column(name).alias("entity"), day.alias("day"))
    return drops.groupBy("entity").agg(F.count(F.lit(1)).alias("drops"), F.min("day").alias("first_day"))


@WORK.add(
    "incremental_events",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS event_count,
        CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS value
    FROM events GROUP BY 1, 2""",
)
def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily drops ingested by a checkpointed stream; a second call finds nothing new."""
    folder = scratch(spark, "drops")
    events = source(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    drops = events.select("event_id", "event_type", "value", "day")
    drops.hint("rebalance", "day").write.parquet(f"{folder}/in")
    target = Table(spark, f"{folder}/table")
    for _ in range(2):
        ingest_new(spark, f"{folder}/in", drops.schema, target, f"{folder}/state", pattern="*.parquet")
    loaded = target.read()
    return loaded.groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("value"),
    )


@WORK.add(
    "pending_files",
    """SELECT 'FactInvoiceDetails_' || CAST(l_suppkey % 25 AS STRING) AS stem, count(*) > 0 AS is_pending
    FROM lineitem WHERE l_suppkey % 25 % 3 <> 0 GROUP BY 1""",
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of every sales group, some of which have been converted already."""
    folder = scratch(spark, "pending")
    group = (F.col("l_suppkey") % 25).alias("sales_group")
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", group)
    name = F.concat(F.lit("FactInvoiceDetails_"), F.col("sales_group").cast("string")).alias("stem")
    lines.select("l_orderkey", "l_linenumber", "l_extendedprice", name).hint("rebalance", "stem").write.partitionBy("stem").csv(f"{folder}/in")
    lines.filter("sales_group % 3 = 0").select("l_orderkey", "l_linenumber", "l_extendedprice", name).hint("rebalance", "stem").write.partitionBy("stem").parquet(f"{folder}/out")
    # A drop is a folder here: its name stands where a file's stem would.
    stem = F.regexp_extract("path", "/stem=([^/]+)/", 1)
    drops = [files.listing(spark, f"{folder}/{side}").withColumn("stem", stem) for side in ("in", "out")]
    return files.pending(*drops).select("stem", F.lit(True).alias("is_pending")).distinct()


@WORK.add(
    "schema_problems",
    """SELECT part, 'l_quantity' AS column_name, 'string' AS kind, 'double' AS expected, 'type differs' AS problem
    FROM (SELECT DISTINCT l_linenumber AS part FROM lineitem) t WHERE part = 3
    UNION ALL SELECT part, 'l_tax', NULL, 'double', 'missing' FROM (SELECT DISTINCT l_linenumber AS part FROM lineitem) t WHERE part = 5
    UNION ALL SELECT part, 'note', 'string', 'string', 'column of few files'
    FROM (SELECT DISTINCT l_linenumber AS part FROM lineitem) t WHERE part = 5""",
)
def schema_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder whose columns or types differ from the others, by their footers."""
    folder = scratch(spark, "footers")
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    for part in range(1, 8):
        rows = lines.filter(F.col("l_linenumber") == part)
        if part == 3:
            rows = rows.withColumn("l_quantity", F.col("l_quantity").cast("string"))
        if part == 5:
            rows = rows.drop("l_tax").withColumn("note", F.lit("x"))
        rows.write.parquet(f"{folder}/part={part}")
    found = files.schema_problems(files.parquet_columns(spark, folder))
    part = F.regexp_extract("path", "/part=([0-9]+)/", 1).cast("int").alias("part")
    return found.select(part, "column_name", "kind", "expected", "problem").distinct()


@WORK.add(
    "json_ingest",
    """SELECT event_type, count(*) FILTER (WHERE event_id % 7 <> 0) AS loaded, count(*) FILTER (WHERE event_id % 7 = 0) AS malformed,
        CAST(sum(CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS DECIMAL(18, 4)) END) AS DOUBLE) AS v
    FROM events GROUP BY event_type""",
)
def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as JSON lines, some cut off: what can be read is loaded, what cannot is kept apart as it came."""
    folder = scratch(spark, "json")
    events = source(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "event_type", "props"))
    cut = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("broken "), F.col("event_type"), F.lit(" {"))).otherwise(line)
    events.select(cut.alias("value")).write.text(f"{folder}/in")
    schema = struct_from_ddl("event_id BIGINT, event_type VARCHAR(50), props VARCHAR(5000)")
    rows = files.read_json_lines(spark, f"{folder}/in", schema)
    target = Table(spark, f"{folder}/table")
    path, loaded = target.stage(rows.withColumn(REJECTED, F.col(files.CORRUPT).isNotNull()))
    target.commit("replace", path, loaded, schema)
    kept = spark.read.schema(rows.schema).parquet(path.replace(f"{REJECTED}=false", f"{REJECTED}=true"))
    bad = kept.select(F.regexp_extract(files.CORRUPT, r"^broken (\w+)", 1).alias("event_type"), F.lit(None).cast("double").alias("v"), F.lit(False).alias("ok"))
    good = target.read().select("event_type", F.get_json_object("props", "$.k").cast("double").alias("v"), F.lit(True).alias("ok"))
    return good.unionByName(bad).groupBy("event_type").agg(
        F.count_if("ok").alias("loaded"), F.count_if(~F.col("ok")).alias("malformed"), F.sum(F.col("v").cast("decimal(18,4)")).cast("double").alias("v")
    )
