"""Whole jobs over stored tables and files, with the given tables as their feeds."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TableSpec
from ..functions.dates import int_date
from ..functions.ddl import struct_from_ddl
from ..functions.names import squash
from ..operators import quality, records
from ..operators.load import Table, register, save_bucketed
from ..plans.dimensions import transform_dimension
from ..operators.align import union_all
from ..plans.ingest import daily_run, load_checked, run_drops, run_table
from ..plans.runs import Ledger, compared, keep_metrics, run_tenants
from ..samples import shape, shape_cte, source
from ..session import scratch
from ..streaming.drops import ingest_drops
from ..sources import files, routing, seeds
from ..tables import SPECS
from . import Workload
from .quality import _BROKEN, _FEED_CTE, feed, feed_rules
from .sales import CONFIG, CUTOFF, RUN_DATE

WORK = Workload()

SECONDARY = "fact_invoice_secondary"
#: Lines in a file of a streamed drop, so that files become more and not larger.
DROP_ROWS = 500_000


# --- files ---


@WORK.add(
    "csv_by_header",
    """SELECT CAST(c_custkey AS STRING) AS code,
        CASE WHEN c_nationkey % 2 = 0 THEN 'say "' || c_name || '", ok' ELSE 'C:\\' || c_name END AS name,
        CAST(c_acctbal AS STRING) AS balance
    FROM customer""",
)
def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers differ in order, with doubled quotes, separators and backslashes in their values."""
    folder = scratch(spark, "headers")
    name = F.concat(F.lit('say "'), "c_name", F.lit('", ok'))
    other = F.concat(F.lit("C:\\"), "c_name")
    customer = source(spark, sf_dir, "customer")
    rows = customer.select(
        F.col("c_custkey").cast("string").alias("code"),
        F.when(F.col("c_nationkey") % 2 == 0, name).otherwise(other).alias("name"),
        F.col("c_acctbal").cast("string").alias("balance"),
        "c_nationkey",
    )
    write = lambda df, part: df.write.options(header=True, escape='"').csv(f"{folder}/{part}")
    write(rows.filter("c_nationkey < 12").select("code", "name", "balance"), "a")
    write(rows.filter("c_nationkey >= 12").select("balance", "code", "name"), "b")
    return files.read_csv_text(spark, folder, ["code", "name", "balance"])


@WORK.add(
    "combined_groups",
    """WITH stems AS (
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN ['107', '112'] WHEN o_orderpriority = '5-LOW' THEN ['112']
            ELSE ['107', '305'] END AS named, count(*) AS n, o_orderpriority = '1-URGENT' AS combined
        FROM orders GROUP BY 1, 3)
    SELECT unnest(CASE WHEN combined THEN list_concat(named, string_split('"""
    + " ".join(routing.GROUPS_WITH_COMBINED)
    + """', ' ')) ELSE named END) AS sales_group, n AS row_count FROM stems""",
)
def combined_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of drops by file name, derived drops and groups delivered along with others included."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    stem = F.when(urgent, "FactInvoiceDetails_107_DD_112").when(F.col("o_orderpriority") == "5-LOW", "FactInvoiceDetails_112")
    rows = source(spark, sf_dir, "orders").select(stem.otherwise("FactInvoiceSecondary_107_305").alias("stem"))
    counted = rows.groupBy("stem").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.explode(routing.sales_groups_column("stem")).alias("sales_group"), "row_count")


@WORK.add(
    "seed_load",
    """SELECT s_suppkey AS code, CASE WHEN s_nationkey % 3 <> 0 THEN s_name END AS dealer_name, s_acctbal AS credit
    FROM supplier""",
)
def seed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed file in a table's columns; loading it again replaces it, blank cells are NULL."""
    folder = scratch(spark, "seed")
    rows = source(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("Credit"),
        F.col("s_suppkey").alias("CODE"),
        F.when(F.col("s_nationkey") % 3 != 0, F.col("s_name")).otherwise("  ").alias("Dealer Name"),
    )
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/in/seed")
    spec = TableSpec("dim_seed", struct_from_ddl("code INT, dealer_name VARCHAR(99), credit DOUBLE"))
    target = Table(spark, f"{folder}/table")
    for _ in range(2):
        seeds.load_seed(spark, {"dim_seed": seeds.Seed("dim_seed", "seed")}, "dim_seed", f"{folder}/in", spec, target)
    return target.read()


@WORK.add(
    "file_row_counts",
    """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""",
)
def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files by their footers."""
    counts = [(t, files.row_count(spark, f"{sf_dir}/{t}.parquet")) for t in ("orders", "lineitem", "events")]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


@WORK.add("preview_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return records.preview(orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey"), 10)


# --- checks ---


@WORK.add(
    "widening_plan",
    """SELECT 'text' AS column_name, 'VARCHAR(3000)' AS old,
        'VARCHAR(' || CAST(floor(CAST(max(octet_length(encode(text))) AS DOUBLE) * CAST(1.2 AS DOUBLE)) AS BIGINT) || ')' AS new
    FROM documents HAVING max(octet_length(encode(text))) > 3000
    UNION ALL
    SELECT 'doc_id', 'TINYINT', CASE WHEN max(doc_id) <= 32767 THEN 'SMALLINT' ELSE 'INT' END FROM documents
    HAVING max(doc_id) > 127""",
)
def widening_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types that the texts of documents do not fit, whatever their length."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    schema = struct_from_ddl("doc_id TINYINT, text VARCHAR(3000), lang VARCHAR(9)")
    plan = quality.propose_widening(docs, "documents", schema)
    return spark.createDataFrame([(w.column, w.old, w.new) for w in plan], "column_name string, old string, new string")


@WORK.add(
    "rule_stages",
    _FEED_CTE
    + " UNION ALL ".join(
        f"SELECT '{s}' AS stage, '{r}' AS rule, CAST(count(*) FILTER ({_BROKEN[r]}) AS BIGINT) AS violations FROM feed "
        for r, s in (
            ("invoice_date_missing", "schema"),
            ("customer_code_missing", "schema"),
            ("invoice_no_pattern", "quality"),
            ("amount_range", "business"),
        )
    ),
)
def rule_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of several stages, which run in the order of their stages."""
    stages = {"amount_range": "business", "invoice_no_pattern": "quality", "invoice_date_missing": "schema", "customer_code_missing": "schema"}
    rules = [dataclasses.replace(r, stage=stages[r.name]) for r in feed_rules() if r.name in stages]
    return quality.rule_counts(quality.flag(feed(spark, sf_dir), rules), rules).select("stage", "rule", "violations")


# --- stored tables ---


@WORK.add(
    "stored_upsert",
    """SELECT year(o_orderdate) * 100 + month(o_orderdate) AS month, count(*) AS row_count,
        CAST(sum(CAST(CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1""",
)
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows, each twice in the batch, into a table of many partitions."""
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", month)
    target = Table(spark, scratch(spark, "upsert"))
    target.replace(orders, ["month"])
    changed = orders.filter("o_custkey % 5 = 0")
    target.upsert(changed.unionByName(changed.withColumn("o_totalprice", F.lit(0.0))), ["o_orderkey"], [F.col("o_totalprice")])
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    return target.read().groupBy("month").agg(F.count(F.lit(1)).alias("row_count"), total)


@WORK.add(
    "stored_insert_ignore",
    """SELECT c_custkey AS code, c_nationkey AS nation FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_nationkey >= 10""",
)
def stored_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys only, each once although the batch repeats them."""
    customer = source(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.col("c_nationkey").alias("nation"))
    target = Table(spark, scratch(spark, "ignore"))
    target.replace(customer.filter("nation < 10"))
    target.insert_missing(customer.withColumn("nation", F.lit(-1)).unionByName(customer.withColumn("nation", F.lit(-2))), ["code"])
    return target.read()


@WORK.add(
    "compacted_table",
    """SELECT l_returnflag, count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM lineitem WHERE l_linestatus <> 'F' OR l_quantity >= 10 GROUP BY l_returnflag""",
)
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended in parts, some rows deleted, then rewritten in one piece."""
    lines = source(spark, sf_dir, "lineitem")
    target = Table(spark, scratch(spark, "compact"))
    for part in ("l_linenumber <= 2", "l_linenumber between 3 and 5", "l_linenumber > 5"):
        target.append(lines.filter(part))
    target.delete("l_linestatus = 'F' AND l_quantity < 10")
    target.compact(["l_returnflag"])
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total")
    return target.read().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"), total)


@WORK.add(
    "evolved_table",
    """SELECT kind, count(*) AS row_count, CAST(sum(CAST(code AS DECIMAL(38, 0))) AS DOUBLE) AS codes FROM (
        SELECT CAST(o_orderkey AS BIGINT) AS code, 'old' AS kind FROM orders
        UNION ALL SELECT o_orderkey + 10000000000, 'new' FROM orders) t GROUP BY kind""",
)
def evolved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column widened between two loads; the files of the first stay as they are."""
    orders = source(spark, sf_dir, "orders")
    target = Table(spark, scratch(spark, "evolved"))
    target.append(orders.select(F.col("o_orderkey").cast("int").alias("code"), F.lit("old").alias("kind")))
    target.evolve(struct_from_ddl("code BIGINT, kind VARCHAR(9)"))
    target.append(orders.select((F.col("o_orderkey") + 10_000_000_000).alias("code"), F.lit("new").alias("kind")))
    codes = F.sum(F.col("code").cast("decimal(38,0)")).cast("double").alias("codes")
    return target.read().groupBy("kind").agg(F.count(F.lit(1)).alias("row_count"), codes)


def bucketed(spark: SparkSession, sf_dir: str, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    """Orders and their lines in tables hashed by order."""
    tables = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        path = scratch(spark, f"bucketed_{name}")
        tables.append(save_bucketed(source(spark, sf_dir, name), path.rsplit("/", 1)[-1].replace("-", "_"), [key], buckets, path=path))
    return tables[0], tables[1]


def order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of each order summed up beside its total; on bucketed tables nothing is shuffled."""
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    joined = orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    sums = joined.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("line_count"), F.sum(value).alias("lines_total"), F.max("o_totalprice").alias("order_total"))
    return sums.withColumn("lines_total", F.col("lines_total").cast("double"))


@WORK.add(
    "bucketed_join",
    """SELECT o_orderkey, count(*) AS line_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS lines_total,
        max(o_totalprice) AS order_total
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join and aggregation by order over bucketed tables, without an exchange."""
    return order_totals(*bucketed(spark, sf_dir))


@WORK.add(
    "registered_views",
    "SELECT o_orderpriority, count(*) AS row_count FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority",
)
def registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views built in their order; a protected one serves the others without a name of its own."""
    views = {
        "by_priority": (2, lambda t: t["large_orders"].groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"))),
        "large_orders": (1, lambda t: t["all_orders"].filter("o_totalprice > 100000")),
    }
    register(spark, {"all_orders": source(spark, sf_dir, "orders")}, views, protected=["large_orders"])
    return spark.table("by_priority")


@WORK.add(
    "table_job",
    f"""{shape_cte(SECONDARY)}
    SELECT sales_group_code, count(*) AS row_count,
        CAST(sum(CAST(reporting_value AS DECIMAL(18, 4))) AS DOUBLE) AS reporting_value,
        min(invoice_date) AS first_day FROM {SECONDARY} WHERE invoice_date >= {CUTOFF} GROUP BY sales_group_code""",
)
def table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text drop through renaming, cut-off, conversion, checks and the checked load into a stored table."""
    fact, spec = shape(spark, sf_dir, SECONDARY), SPECS[SECONDARY]
    known = [c for c in fact.columns if c in spec.schema.names]
    drop = fact.select([F.col(c).cast("string").alias(squash(c)) for c in known])
    target = Table(spark, scratch(spark, "job"))
    run_table(drop, spec, CONFIG, target, mode="replace")
    value = F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("reporting_value")
    rows = target.read().groupBy("sales_group_code")
    return rows.agg(F.count(F.lit(1)).alias("row_count"), value, F.min("invoice_date").alias("first_day"))


@WORK.add(
    "dimension_job",
    f"""{shape_cte("dim_customer_master")}
    SELECT customer_code, population, regexp_replace(trim(upper(tsi_territory_name)), '\\s+', ' ', 'g') AS tsi_territory_name
    FROM dim_customer_master""",
)
def dimension_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension in its declared columns and types, with the rules of its own."""
    customers = shape(spark, sf_dir, "dim_customer_master").withColumn("population", F.col("population").cast("string"))
    out, _ = transform_dimension(customers, SPECS["dim_customer_master"])
    return out.select("customer_code", "population", "tsi_territory_name")


def text_drop(spark: SparkSession, sf_dir: str, name: str = SECONDARY) -> DataFrame:
    """A table's rows as they come in a drop: text, column names without underscores."""
    fact, spec = shape(spark, sf_dir, name), SPECS[name]
    return fact.select([F.col(c).cast("string").alias(squash(c)) for c in fact.columns if c in spec.schema.names])


def _by_group(rows: DataFrame) -> DataFrame:
    value = F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("reporting_value")
    return rows.groupBy("sales_group_code").agg(F.count(F.lit(1)).alias("row_count"), value)


_BY_GROUP = "count(*) AS row_count, CAST(sum(CAST({} AS DECIMAL(18, 4))) AS DOUBLE) AS reporting_value"


@WORK.add(
    "drop_run",
    f"""{shape_cte(SECONDARY)}
    SELECT sales_group_code, {_BY_GROUP.format("CASE WHEN sales_group_code = 7 THEN 0 ELSE reporting_value END")}
    FROM {SECONDARY} WHERE invoice_date >= {CUTOFF} GROUP BY sales_group_code""",
)
def drop_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of all sales groups loaded by their names; one sent again, corrected, replaces its group only."""
    folder = scratch(spark, "drops")
    drop = text_drop(spark, sf_dir)
    groups = sorted(int(r[0]) for r in shape(spark, sf_dir, SECONDARY).select("sales_group_code").distinct().collect())  # 25 at most
    parts = [groups[i::3] for i in range(3)]
    for part in filter(None, parts):
        listed = drop.filter(F.col("salesgroupcode").isin([str(g) for g in part]))
        listed.write.parquet(f"{folder}/first/FactInvoiceSecondary_{'_'.join(map(str, part))}.parquet")
    again = drop.filter("salesgroupcode = '7'").withColumn("reportingvalue", F.lit("0"))
    again.write.options(header=True, escape='"').csv(f"{folder}/second/FactInvoiceSecondary_7.csv")
    config = dataclasses.replace(CONFIG, base_path=folder)
    for day in ("first", "second", "second"):
        run_drops(spark, config, SPECS, f"{folder}/{day}")
    return _by_group(Table(spark, config.path("tables", SECONDARY)).read())


@WORK.add(
    "grown_table",
    f"""{shape_cte(SECONDARY)}
    SELECT sales_group_code, {_BY_GROUP.format("reporting_value")},
        count(CASE WHEN sales_group_code % 3 <> 0 THEN invoice_no END) AS vehicles,
        count(DISTINCT CASE WHEN sales_group_code % 3 = 2 THEN item_code END) AS lanes
    FROM {SECONDARY} WHERE invoice_date >= {CUTOFF} GROUP BY sales_group_code""",
)
def grown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops that bring columns their table lacks: the table takes them up, and drops without them still load."""
    target = Table(spark, scratch(spark, "grown"))
    config = dataclasses.replace(CONFIG, extra_columns="add")
    drop = text_drop(spark, sf_dir)
    vehicle, lane = F.concat(F.lit("V"), "invoiceno").alias("Vehicle No"), F.col("itemcode").alias("lane")
    parts = {"1": [vehicle], "2": [vehicle, lane], "0": []}
    for rest, more in parts.items():
        run_table(drop.filter(f"CAST(salesgroupcode AS INT) % 3 = {rest}").select("*", *more), SPECS[SECONDARY], config, target)
    value = F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("reporting_value")
    rows = target.read().groupBy("sales_group_code")
    return rows.agg(F.count(F.lit(1)).alias("row_count"), value, F.count("vehicle_no").alias("vehicles"), F.countDistinct("lane").alias("lanes"))


@WORK.add(
    "streamed_drops",
    f"""{shape_cte(SECONDARY)}
    SELECT sales_group_code, {_BY_GROUP.format("reporting_value")}
    FROM {SECONDARY} WHERE invoice_date >= {CUTOFF} GROUP BY sales_group_code""",
)
def streamed_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops streamed through the whole job; the last batch comes again, as after a lost driver, and changes nothing."""
    folder = scratch(spark, "stream")
    drop = text_drop(spark, sf_dir)
    lines = files.row_count(spark, f"{sf_dir}/lineitem.parquet")
    parts = max(3, -(-lines // DROP_ROWS))
    drop.repartition(parts).write.parquet(f"{folder}/in")
    target = Table(spark, f"{folder}/table")
    for _ in range(2):
        ingest_drops(spark, f"{folder}/in", drop.columns, SPECS[SECONDARY], CONFIG, target, f"{folder}/state", pattern="*.parquet", files_per_batch=parts - parts // 3)
        forget_last_batch(spark, f"{folder}/state")
    return _by_group(target.read())


def forget_last_batch(spark: SparkSession, state: str) -> None:
    """What a stream looks like that failed after loading its last batch and before noting so."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    done = path(f"{state}/commits")
    system = done.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(s.getPath().getName()) for s in system.listStatus(done) if s.getPath().getName().isdigit())
    system.delete(path(f"{state}/commits/{last}"), False)


@WORK.add(
    "daily_run_totals",
    f"""{shape_cte(SECONDARY, "fact_invoice_details")}
    SELECT 'secondary' AS kind, count(*) AS row_count, CAST(sum(CAST(reporting_value AS DECIMAL(18, 4))) AS DOUBLE) AS reporting_value
    FROM {SECONDARY} WHERE invoice_date >= {CUTOFF}
    UNION ALL SELECT 'details', count(*), CAST(sum(CAST(net_value AS DECIMAL(18, 4))) AS DOUBLE)
    FROM fact_invoice_details WHERE posting_date > 19950101""",
)
def daily_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's run that breaks at its second fact, goes on where it stopped, and is then run once more: facts count once."""
    folder = scratch(spark, "daily")
    config = dataclasses.replace(CONFIG, base_path=folder, detail_cutoff=19950101)
    drops = {n: text_drop(spark, sf_dir, n) for n in (SECONDARY, "fact_invoice_details")}
    last = max(drops, key=lambda n: SPECS[n].order)
    broken = drops | {last: drops[last].withColumn(drops[last].columns[0], F.raise_error(F.lit("the drop is damaged")).cast("string"))}
    specs = {n: SPECS[n] for n in drops}
    ledger = Ledger(spark, config.path("state", "steps"))
    for attempt in (broken, drops, drops):
        try:
            daily_run(spark, config, specs, attempt, RUN_DATE, ledger=ledger)
        except Exception:
            if attempt is not broken:
                raise
    tables = {n: Table(spark, config.path("tables", n)).read() for n in drops}
    total = lambda c: F.sum(F.col(c).cast("decimal(18,4)")).cast("double").alias("reporting_value")
    count = F.count(F.lit(1)).alias("row_count")
    secondary = tables[SECONDARY].filter("record_type <> 'DD'").agg(count, total("reporting_value")).withColumn("kind", F.lit("secondary"))
    details = tables["fact_invoice_details"].agg(count, total("net_value")).withColumn("kind", F.lit("details"))
    return secondary.unionByName(details)


@WORK.add(
    "tenant_run",
    f"""{shape_cte(SECONDARY)}
    SELECT tenant, sales_group_code, {_BY_GROUP.format("reporting_value")}
    FROM {SECONDARY}, (VALUES ('north', 0), ('south', 1)) AS t (tenant, rest)
    WHERE invoice_date >= {CUTOFF} AND sales_group_code % 2 = rest GROUP BY tenant, sales_group_code""",
)
def tenant_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tenants side by side, each with its drop; one fails, the others' tables stand."""
    folder = scratch(spark, "tenants")
    tenants = [dataclasses.replace(CONFIG, tenant=t, base_path=folder, priority=i) for i, t in enumerate(("broken", "north", "south"))]
    drop = text_drop(spark, sf_dir)

    def job(config):
        part = {"north": "CAST(salesgroupcode AS INT) % 2 = 0", "south": "CAST(salesgroupcode AS INT) % 2 = 1"}.get(config.tenant, "true")
        mine = drop.filter(part)
        if config.tenant == "broken":
            mine = mine.withColumn("invoicedate", F.lit("no day"))
        return run_table(mine, SPECS[SECONDARY], config, Table(spark, config.path("tables", SECONDARY)), mode="replace")

    results = run_tenants(spark, tenants, job)
    done = [c for c in tenants if not isinstance(results[c.tenant], Exception)]
    loaded = [Table(spark, c.path("tables", SECONDARY)).read().withColumn("tenant", F.lit(c.tenant)) for c in done]
    value = F.sum(F.col("reporting_value").cast("decimal(18,4)")).cast("double").alias("reporting_value")
    return union_all(loaded).groupBy("tenant", "sales_group_code").agg(F.count(F.lit(1)).alias("row_count"), value)


@WORK.add(
    "run_history",
    """WITH runs AS (
        SELECT CAST(year(o_orderdate) AS STRING) AS run, count(*) AS row_count, count(*) FILTER (WHERE o_orderstatus = 'P') AS rejected
        FROM orders GROUP BY 1), compared AS (
        SELECT *, lag(row_count) OVER w AS previous_rows,
            avg(row_count) OVER (ORDER BY run ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS usual
        FROM runs WINDOW w AS (ORDER BY run))
    SELECT run, row_count, rejected, previous_rows, usual, CAST(row_count AS DOUBLE) / previous_rows AS ratio,
        CASE WHEN CAST(row_count AS DOUBLE) / previous_rows > HIGH THEN 'increase' WHEN CAST(row_count AS DOUBLE) / previous_rows < LOW THEN 'decrease' ELSE 'none' END AS alert,
        CASE WHEN CAST(rejected AS DOUBLE) / row_count > CRITICAL THEN 'critical' WHEN CAST(rejected AS DOUBLE) / row_count > WARN THEN 'warning' ELSE 'ok' END AS level
    FROM compared"""
    .replace("HIGH", str(quality.VOLUME_LIMITS[1])).replace("LOW", str(quality.VOLUME_LIMITS[0]))
    .replace("CRITICAL", str(quality.ERROR_LIMITS[1])).replace("WARN", str(quality.ERROR_LIMITS[0])),
)
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded year by year, the metrics of each load kept, and every run compared with those before it."""
    folder = scratch(spark, "history")
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    target, history = Table(spark, f"{folder}/orders"), Table(spark, f"{folder}/metrics")
    rules = [quality.Rule("settled", F.col("o_orderstatus") != "P", "skip_row")]
    for year in sorted(r[0] for r in orders.select("year").distinct().collect()):  # a handful
        rows = orders.filter(F.col("year") == year)
        for _ in range(2):  # a run noted twice counts once
            if not target.holds(str(year)):
                report = load_checked(rows, target, orders.schema, rules, max_error_ratio=1.0, table="orders", batch=str(year))
            keep_metrics(spark, history, str(year), [report])
    return compared(history.read()).select("run", "row_count", "rejected", "previous_rows", "usual", "ratio", "alert", "level")


@WORK.add(
    "duplicates_removed",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) t
    WHERE rn = 1""",
)
def duplicates_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return records.settle_duplicates(orders, ["o_custkey"], "remove", [F.desc("o_totalprice"), F.asc("o_orderkey")])


@WORK.add(
    "duplicates_marked",
    """SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_partkey) > 1 AS is_duplicate
    FROM lineitem""",
)
def duplicates_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return records.settle_duplicates(lines, ["l_orderkey", "l_partkey"], "warn")


@WORK.add(
    "stored_retention",
    """SELECT o_orderpriority, count(*) AS row_count FROM orders
    WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 1500 GROUP BY o_orderpriority""",
)
def stored_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table rewritten without the rows beyond its retention."""
    orders = source(spark, sf_dir, "orders").select("o_orderpriority", int_date("o_orderdate").alias("day"))
    target = Table(spark, scratch(spark, "retention"))
    target.replace(orders, ["o_orderpriority"])
    target.retain("day", dt.date(2001, 8, 1), 1500)
    return target.read().groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"))
