import os
import dataclasses
import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.config import PipelineConfig, deep_merge, load_table_specs, run_order
from salesmill.functions.names import squash
from salesmill.operators import quality
from salesmill.operators.load import Table
from salesmill.plans import derived, dimensions, ingest
from salesmill.samples import shapes
from salesmill.plans import runs
from salesmill.streaming.drops import ingest_new
from salesmill.workload.jobs import forget_last_batch
from salesmill.tables import SPECS

SECONDARY = SPECS["fact_invoice_secondary"]
CONFIG = PipelineConfig(tenant="t1", secondary_cutoff=20230401)


def feed(spark, rows):
    """Secondary drop as it arrives: squashed names, text everywhere."""
    return spark.createDataFrame(
        rows, "invoicedate string, customercode string, invoiceno string, reportingvalue string, salesgroupcode string"
    )


GOOD = [("20230401", "C1", "I1", " 5.5", "107"), ("20230331", "C2", "I2", "1", "107"), ("20240101", None, "I3", "", "12")]


def test_transform(spark):
    done = ingest.transform(feed(spark, GOOD), SECONDARY, dataclasses.replace(CONFIG, max_conversion_failures=0.5))
    rows = {r["invoice_no"]: r for r in done.frame.collect()}
    assert set(rows) == {"I1", "I3"}
    assert rows["I1"]["reporting_value"] == 5.5 and rows["I1"]["sales_group_code"] == 107
    assert rows["I3"]["fis_sg_id_cc_in"] == "20240101_NULL_I3"
    assert done.conversion_failures["reporting_value"] == 1 and "dealercode" in done.absent


def test_transform_refuses_unreadable_and_overflowing_values(spark):
    with pytest.raises(ValueError, match="reporting_value"):
        ingest.transform(feed(spark, [("20240101", "C", "I", "x", "1")]), SECONDARY, CONFIG)
    with pytest.raises(quality.QualityError, match="sales_group_code"):
        ingest.transform(feed(spark, [("20240101", "C", "I", "1", "40000")]), SECONDARY, CONFIG)


def test_long_text_is_reported_with_a_new_size(spark):
    done = ingest.transform(feed(spark, [("20240101", "C" * 20, "I", "1", "1")]), SECONDARY, CONFIG)
    assert [(w.column, w.new) for w in done.widenings if w.column == "customer_code"] == [("customer_code", "VARCHAR(24)")]


def test_drops_that_lack_or_add_columns_are_refused(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    good = feed(spark, GOOD[:1])
    with pytest.raises(quality.QualityError, match="invoice_date"):
        ingest.run_table(good.drop("invoicedate"), SECONDARY, CONFIG, target)
    with pytest.raises(quality.QualityError, match="fis_sg_id_cc_in"):
        ingest.run_table(good.drop("invoiceno"), SECONDARY, CONFIG, target)
    more = good.withColumn("newmeasure", F.lit("1"))
    with pytest.raises(quality.QualityError, match="newmeasure"):
        ingest.run_table(more, SECONDARY, CONFIG, target)
    ingest.run_table(more, SECONDARY, dataclasses.replace(CONFIG, extra_columns="report"), target)
    assert target.read().count() == 1


def test_columns_of_a_drop_are_added_to_the_table(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    config = dataclasses.replace(CONFIG, extra_columns="add")
    good = feed(spark, GOOD[:1])
    more = good.withColumn("New Measure", F.lit("1")).withColumn("order", F.lit("x" * 300)).withColumn("weight", F.lit(2.5))
    load = lambda df, **how: ingest.run_table(df, SECONDARY, config, target, **how)
    load(good)
    load(more)
    load(good)
    rows = target.read()
    assert rows.columns == SECONDARY.schema.names + ["new_measure", "order_raw", "weight"]
    assert sorted((r["new_measure"], len(r["order_raw"]), r["weight"]) for r in rows.filter("weight is not null").collect()) == [("1", 300, 2.5)]
    assert rows.count() == 3 and dict(rows.dtypes)["weight"] == "double"
    # Numbers that come as text fit the type the column has by now; text longer than the limit widens it.
    load(more.withColumn("weight", F.lit("7")), mode="slice", condition="invoice_no = 'none'")
    assert sorted(r["weight"] for r in target.read().filter("weight is not null").collect()) == [2.5, 7.0]
    with pytest.raises(quality.QualityError, match="cannot be added"):
        load(good.withColumn("a b", F.lit("1")).withColumn("a_b ", F.lit("1")).withColumn("a-b", F.lit("1")))
    with pytest.raises(quality.QualityError, match="no plain column"):
        load(good.withColumn("list", F.array(F.lit(1))))


def test_not_null_declarations_are_rules(spark, tmp_path):
    rows = spark.createDataFrame([(None, "7", "V")], "division string, salesgroup string, vertical string")
    with pytest.raises(Exception, match="division"):
        ingest.run_table(rows, SPECS["dim_sales_group"], CONFIG, Table(spark, str(tmp_path / "t")), mode="replace")


def test_wider_text_widens_the_stored_table(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    ingest.run_table(feed(spark, GOOD[:1]), SECONDARY, CONFIG, target)
    ingest.run_table(feed(spark, [("20240101", "C" * 7000, "I", "1", "1")]), SECONDARY, CONFIG, target)
    assert target.schema()["customer_code"].metadata["max_bytes"] == 8400
    assert target.read().count() == 2


def test_checked_append_keeps_the_partitions(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, kind string")
    ingest.load_checked(df, target, df.schema, mode="replace", partition_by=["kind"])
    ingest.load_checked(df, target, df.schema)
    assert target.read().count() == 4 and target.commits()[-1].partitions == ("kind",)
    with pytest.raises(ValueError, match="partitioned"):
        ingest.load_checked(df, target, df.schema, partition_by=["k"])


def test_run_table_loads_every_column(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    config = dataclasses.replace(CONFIG, max_conversion_failures=0.5)
    report = ingest.run_table(feed(spark, GOOD), SECONDARY, config, target, mode="replace")
    assert (report.rows, report.loaded, report.rejected) == (2, 2, 0)
    assert target.read().columns == SECONDARY.schema.names and target.read().count() == 2
    ingest.run_table(feed(spark, GOOD[:1]), SECONDARY, config, target)
    assert target.read().count() == 3


def test_rejects_are_kept_with_reasons_and_gated(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    rules = [quality.required("customer_code", "skip_row")]
    config = dataclasses.replace(CONFIG, max_conversion_failures=0.5)
    with pytest.raises(quality.QualityError):
        ingest.run_table(feed(spark, GOOD), SECONDARY, config, target, rules, "replace")
    assert not target.exists()
    report = ingest.run_table(
        feed(spark, GOOD), SECONDARY, dataclasses.replace(config, max_error_ratio=0.5), target, rules, "replace"
    )
    assert (report.loaded, report.rejected, report.rule_counts) == (1, 1, {"customer_code_missing": 1})
    bad = spark.read.parquet(report.quarantine).first()
    assert bad["invoice_no"] == "I3" and bad[quality.VIOLATIONS] == ["customer_code_missing"]
    assert report.frame(spark).first()["rejected_percent"] == 50.0
    assert quality.VIOLATIONS not in target.read().columns


def test_everything_rejected(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(None,)], "k string")
    ingest.load_checked(df, target, df.schema, [quality.required("k", "skip_row")], 1.0, "replace")
    assert target.read().count() == 0


def details(spark):
    schema = SPECS["fact_invoice_details"].schema
    base = {
        "active_flag": "1",
        "posting_date": 20230401,
        "customer_code": "C1",
        "customer_code_org": 7,
        "material_code": "M",
        "invoice_no": "I",
        "mis_type": "INV",
        "net_value": 10,
        "billing_quantity_in_stock_keeping_unit": 4,
        "sales_group_code": 107,
    }
    cases = [
        {},
        {"mis_type": "CN"},
        {"mis_type": "CN", "net_value": None, "invoice_no": None},
        {"mis_type": "INV", "net_value": None, "billing_quantity_in_stock_keeping_unit": None},
        {"mis_type": "FCN", "reason_code": "SLPMT"},
        {"mis_type": "FCN", "reason_code": "OTHER"},
        {"mis_type": "FCN"},
        {"active_flag": "0"},
        {"posting_date": 20230331},
    ]
    rows = [tuple((base | c).get(f.name) for f in schema.fields) for c in cases]
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = [tuple(None if v is None else str(v) for v in r) for r in rows]
    df = spark.createDataFrame(text, plain)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def test_dd_records(spark):
    rows = derived.dd_rows(details(spark), CONFIG, dt.date(2024, 2, 29)).collect()
    assert len(rows) == 5 and len(rows[0]) == 68
    assert [r["reporting_value"] for r in rows] == [10.0, -10.0, None, 0.0, 10.0]
    assert [r["volume"] for r in rows] == [4.0, 0.0, 0.0, 0.0, 0.0]
    assert [r["stock_required_quantity"] for r in rows] == [0.0, -4.0, -4.0, 0.0, 0.0]
    assert rows[2]["invoice_no"] == "" and rows[2]["fis_sg_id_cc_in"] == "20230401_C1_NULL"
    assert rows[0]["year_month"] == 202304 and rows[0]["created_date"] == 20240229
    assert rows[0]["dealer_sg_key"] == "C1_107" and rows[0]["record_type"] == "DD" and rows[0]["active_flag"] == 1


def test_dd_refresh_replaces_its_slice_only(spark, tmp_path):
    target = Table(spark, str(tmp_path / "t"))
    ingest.run_table(feed(spark, GOOD[:1]), SECONDARY, CONFIG, target, mode="replace")
    for _ in range(2):
        derived.refresh_dd(details(spark), target, CONFIG, dt.date(2024, 1, 1))
    kinds = {r["record_type"]: r["count"] for r in target.read().groupBy("record_type").count().collect()}
    assert kinds == {None: 1, "DD": 5}


def test_dealer_groups(spark):
    dealers = spark.createDataFrame(
        [
            ("D1", "One", None, "True", 1),
            ("D2", "Two", "D1", "True", 2),
            ("D3", "Three", "D9", "True", 3),
            ("D4", "Four", "D5", "True", 4),
            ("D5", "Old five", None, "False", 5),
            ("D1", "One again", None, "True", 6),
            ("D6", "Six", "D7", "True", 7),
            ("D7", None, None, "True", 8),
        ],
        "dealer_code string, dealer_name string, dealer_group_code string, active_flag string, seq int",
    )
    rows = {r["seq"]: r for r in dimensions.dealer_groups(dealers, "seq").collect()}
    assert len(rows) == 8
    assert rows[1]["dealer_group_code"] == "D1" and rows[1]["dealer_group_name"] == "One"
    assert rows[2]["dealer_group_name"] == "One again"
    assert rows[3]["dealer_group_name"] == "Three" and rows[4]["dealer_group_name"] == "Four"
    assert rows[6]["dealer_group_name"] == "One again" and rows[7]["dealer_group_name"] is None


def test_transform_dimension_keeps_rows(spark):
    df = spark.createDataFrame([(" a  b ", "12", "x")], "TSI_TERRITORY_NAME string, population string, junk string")
    out, fitted = dimensions.transform_dimension(df, SPECS["dim_customer_master"])
    assert out.first()["tsi_territory_name"] == "A B" and out.first()["population"] == 12
    assert fitted.extra == ("junk",) and out.count() == 1


def test_daily_run(spark, tmp_path):
    """Dimensions, facts, derived records, access map, snapshot and facets of one tenant."""
    config = dataclasses.replace(CONFIG, base_path=str(tmp_path), secondary_cutoff=19980401, detail_cutoff=19980331)
    shaped = shapes(spark, "/root/testdata/sf0.001")
    drops = {}
    for name, df in shaped.items():
        known = [c for c in df.columns if c in SPECS[name].schema.names]
        drops[name] = df.select([F.col(c).cast("string").alias(squash(c)) for c in known])
    specs = {n: s for n, s in SPECS.items() if n in drops}
    for _ in range(2):
        reports = ingest.daily_run(
            spark,
            config,
            specs,
            drops,
            dt.date(2024, 1, 31),
            modes={"fact_invoice_secondary": ("slice", "record_type <> 'DD'"), "fact_invoice_details": ("replace", None)},
        )
    assert all(r.rejected == 0 for r in reports.values())

    def stored(name):
        return Table(spark, config.path("tables", name)).read()

    secondary = shaped["fact_invoice_secondary"].filter("invoice_date >= 19980401").count()
    kinds = {r["record_type"]: r["count"] for r in stored("fact_invoice_secondary").groupBy("record_type").count().collect()}
    assert kinds["SEC"] == secondary and kinds["DD"] > 0
    assert stored("secondary_sales_mat_view").count() > 0
    constants = stored("business_constants")
    assert constants.count() == constants.select("display_name", "value").distinct().count() > 0
    assert stored("rls_map").count() > 0 and stored("rls_master").count() > 0


def test_tenants_run_by_priority_and_keep_going(spark):
    tenants = [
        PipelineConfig("late", priority=5),
        PipelineConfig("off", priority=0, enabled=False),
        PipelineConfig("first", priority=1),
    ]
    assert [t.tenant for t in run_order(tenants)] == ["first", "late"]
    seen = []

    def job(config):
        seen.append(config.tenant)
        if config.tenant == "first":
            raise ValueError("no data")
        return "done"

    results = runs.run_tenants(spark, tenants, job, at_once=1)
    assert seen == ["first", "late"] and results["late"] == "done" and isinstance(results["first"], ValueError)
    with pytest.raises(ValueError):
        runs.run_tenants(spark, tenants, job, fail_fast=True, at_once=1)
    assert seen == ["first", "late", "first"]


def test_a_failed_tenant_is_cancelled_alone(spark):
    """What a failed tenant left running ends; the other tenant's job, which starts with it, comes to its end."""
    from pyspark import inheritable_thread_target

    both, left = threading.Barrier(2), []

    def slow():
        try:
            spark.range(8, numPartitions=8).selectExpr("java_method('java.lang.Thread', 'sleep', 60000L)").collect()
        except Exception as err:  # noqa: BLE001
            left.append(err)

    def job(config):
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == config.tenant
        both.wait()
        if config.tenant == "bad":
            thread = threading.Thread(target=inheritable_thread_target(spark)(slow))
            thread.start()
            time.sleep(2)
            raise ValueError("broken")
        return spark.range(1000).count()

    started = time.monotonic()
    results = runs.run_tenants(spark, [PipelineConfig("bad", priority=1), PipelineConfig("good", priority=2)], job)
    assert results["good"] == 1000 and isinstance(results["bad"], ValueError)
    while not left and time.monotonic() - started < 40:
        time.sleep(0.2)
    assert left and "cancel" in str(left[0]).lower()


def test_ledger_goes_on_where_it_stopped(spark, tmp_path):
    ledger, did = runs.Ledger(spark, str(tmp_path / "steps")), []

    def step(name, fails=False):
        def job():
            if fails:
                raise ValueError("broken")
            did.append(name)
            return name

        return name, job

    with pytest.raises(ValueError):
        ledger.run("monday", [step("a"), step("b", fails=True), step("c")])
    assert ledger.run("monday", [step("a"), step("b"), step("c")]) == {"b": "b", "c": "c"}
    assert ledger.run("monday", [step("a"), step("b"), step("c")]) == {} and did == ["a", "b", "c"]
    assert runs.Ledger(spark, str(tmp_path / "steps")).run("tuesday", [step("a")]) == {"a": "a"}
    states = [(r["step"], r["state"], r["message"]) for r in ledger.entries().filter("run = 'monday'").orderBy("at").collect()]
    assert states == [("a", "done", ""), ("b", "failed", "ValueError: broken"), ("b", "done", ""), ("c", "done", "")]


def test_runs_are_compared_and_kept_once(spark, tmp_path):
    history = Table(spark, str(tmp_path / "history"))
    report = lambda rows, bad: ingest.LoadReport("t", rows, rows - bad, bad, 1, None, 0.5, {}, [])
    for run, rows, bad in (("1", 100, 0), ("2", 40, 1), ("3", 100, 0), ("3", 999, 0), ("4", 0, 0)):
        runs.keep_metrics(spark, history, run, [report(rows, bad)])
    got = [(r["run"], r["ratio"], r["usual"], r["alert"], r["level"]) for r in runs.compared(history.read()).orderBy("run").collect()]
    assert got == [("1", None, None, "none", "ok"), ("2", 0.4, 100.0, "decrease", "critical"), ("3", 2.5, 70.0, "increase", "ok"), ("4", 0.0, 80.0, "decrease", "ok")]


def test_settings_merge():
    shared = {"business_rules": {"sales_threshold": 1, "fiscal_year": {"start_month": 4, "x": 1}}, "list": [1, 2]}
    tenant = {
        "tenant_slug": "t",
        "schedule_priority": 2,
        "list": [3],
        "business_rules": {"date_filter_start": "20240101", "fiscal_year": {"start_month": 1}},
    }
    merged = deep_merge(shared, tenant)
    assert merged["list"] == [3] and merged["business_rules"]["fiscal_year"] == {"start_month": 1, "x": 1}
    assert shared["business_rules"]["fiscal_year"]["start_month"] == 4
    config = PipelineConfig.from_settings(shared, tenant)
    assert (config.tenant, config.priority, config.secondary_cutoff) == ("t", 2, 20240101)
    assert (config.sales_threshold, config.fiscal_start_month) == (1.0, 1)
    assert PipelineConfig("t", "/data/").path("tables", "x") == "/data/t/tables/x"


def test_table_specs_from_a_tenant_directory(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "schemas" / "tables").mkdir(parents=True)
    (tmp_path / "column_mappings").mkdir()
    (tmp_path / "schemas" / "tables" / "02.yaml").write_text(
        'name: dim_b\norder: 2\nsql: "CREATE TABLE dim_b (\\n code VARCHAR(5),\\n n DECIMAL(8, 2)\\n)\\nBUCKETS 1;"\n'
    )
    (tmp_path / "schemas" / "tables" / "01.yaml").write_text('name: dim_a\norder: 1\nsql: "CREATE TABLE dim_a (x INT)"\n')
    (tmp_path / "column_mappings" / "b.yaml").write_text("table_name: dim_b\ncolumns:\n  thecode: {db_column: code}\n")
    (tmp_path / "computed_columns.yaml").write_text("dim_b:\n  k: {type: concatenation, columns: [code, n]}\n")
    specs = load_table_specs(tmp_path)
    assert list(specs) == ["dim_a", "dim_b"]
    assert specs["dim_b"].mapping["thecode"] == "code" and specs["dim_b"].computed["k"]["columns"] == ["code", "n"]
    assert specs["dim_b"].types == {"code": "VARCHAR(5)", "n": "DECIMAL(8, 2)"}


def test_new_drops_only(spark, tmp_path):
    schema = T.StructType([T.StructField("day", T.StringType()), T.StructField("v", T.StringType())])
    folder = tmp_path / "in"
    folder.mkdir()
    target = Table(spark, str(tmp_path / "out"))

    def call():
        return ingest_new(
            spark,
            str(folder),
            schema,
            target,
            str(tmp_path / "state"),
            "csv",
            "*.csv",
            job=lambda df, batch: target.append(df.withColumn("v", F.col("v").cast("int")), batch),
            files_per_batch=1,
            header="true",
        )

    (folder / "a.csv").write_text("day,v\n1,10\n")
    (folder / "b.csv").write_text("day,v\n2,20\n")
    assert len(call()) == 2
    (folder / "c.csv").write_text("day,v\n3,30\n")
    (folder / "ignored.tmp").write_text("day,v\n9,90\n")
    assert len(call()) == 1 and len(call()) == 0
    forget_last_batch(spark, str(tmp_path / "state"))
    assert len(call()) == 0  # it comes again and is known
    rows = target.read().orderBy("v").collect()
    assert [(r["day"], r["v"]) for r in rows] == [("1", 10), ("2", 20), ("3", 30)]


def test_streamed_files_become_more_with_the_rows(spark, monkeypatch):
    """No file of a drop, and so no task that makes one, grows with the table; the stream still takes them in two batches."""
    from salesmill.workload import jobs

    kept = {}
    ingest = jobs.ingest_drops

    def watched(session, folder, *args, **options):
        kept["files"] = len([f for f in os.listdir(folder) if f.endswith(".parquet")])
        done = ingest(session, folder, *args, **options)
        kept.setdefault("batches", len(done))
        return done

    monkeypatch.setattr(jobs, "ingest_drops", watched)
    few = {r.sales_group_code: r.row_count for r in jobs.streamed_drops(spark, "/root/testdata/sf0.001").collect()}
    assert kept == {"files": 3, "batches": 2}
    kept.clear()
    monkeypatch.setattr(jobs, "DROP_ROWS", 1000)
    many = {r.sales_group_code: r.row_count for r in jobs.streamed_drops(spark, "/root/testdata/sf0.001").collect()}
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert kept == {"files": -(-lines // 1000), "batches": 2} and many == few
