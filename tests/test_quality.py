import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmill.functions.ddl import struct_from_ddl
from salesmill.operators import quality as q
from salesmill.operators import records


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "INV00001", 5.0, 20240101),
            (2, None, -1.0, 20240101),
            (3, "bad", 7.0, 20240101),
            (4, "INV00004", None, 20990101),
        ],
        "id int, invoice_no string, amount double, day int",
    )


def rules():
    return [
        q.required("invoice_no", "skip_row"),
        q.matches("invoice_no"),
        q.in_range("amount", "amount"),
        q.plausible_day("day", dt.date(2024, 6, 1)),
    ]


def test_good_and_bad_make_up_the_input(rows):
    good, bad = q.split(rows, rules())
    assert sorted(r["id"] for r in good.collect()) == [1, 3]
    reasons = {r["id"]: r["reasons"] for r in bad.collect()}
    assert reasons == {2: ["invoice_no_missing", "amount_range"], 4: ["day_day"]}
    assert good.columns == rows.columns


def test_defaults_and_nulls_are_filled_in(rows):
    flagged = q.flag(rows, rules())
    assert {r["id"]: r["amount"] for r in flagged.collect()} == {1: 5.0, 2: 0.0, 3: 7.0, 4: None}
    nulled = q.flag(rows, [q.in_range("amount", "amount", "convert_to_null")])
    assert {r["id"]: r["amount"] for r in nulled.collect()}[2] is None


def test_counts_per_rule(rows):
    counts = {r["rule"]: r["violations"] for r in q.rule_counts(q.flag(rows, rules()), rules()).collect()}
    assert counts == {"invoice_no_missing": 1, "invoice_no_pattern": 1, "amount_range": 1, "day_day": 1}


def test_no_rules_accept_everything(rows):
    good, bad = q.split(rows, [])
    assert good.count() == 4 and bad.count() == 0


def test_gate():
    stop = [q.required("x")]
    with pytest.raises(q.QualityError, match="x_missing"):
        q.gate({"rows": 10, "rejected": 1, "rule:x_missing": 1}, stop, 1.0)
    q.gate({"rows": 10, "rejected": 1}, [], 0.1)
    with pytest.raises(q.QualityError, match="rejected"):
        q.gate({"rows": 10, "rejected": 2}, [], 0.1)
    with pytest.raises(q.QualityError):
        q.gate({"rows": 10, "rejected": 1}, [], 0.0)


def test_stages_run_in_order():
    late = q.Rule("late", F.lit(True), stage="cross_table")
    early = q.Rule("early", F.lit(True), stage="schema")
    assert [r.name for r in q.ordered([late, early])] == ["early", "late"]
    with pytest.raises(ValueError):
        q.Rule("x", F.lit(True), action="explode")
    with pytest.raises(ValueError):
        q.Rule("x", F.lit(True), action="use_default")


def test_length_counts_bytes(spark):
    schema = struct_from_ddl("s VARCHAR(3), t VARCHAR(2)")
    df = spark.createDataFrame([("Éa", "ab"), ("abc", "Éa"), (None, None)], "s string, t string")
    found = q.text_overflows(df, schema).collect()
    assert [(r["column_name"], r["max_bytes"], r["proposed_bytes"]) for r in found] == [("t", 3, 3)]
    rules = q.fits_bytes(schema)
    counts = {r["rule"]: r["violations"] for r in q.rule_counts(q.flag(df, rules), rules).collect()}
    assert counts == {"s_length": 0, "t_length": 1}


def test_int_overflow_uses_the_exact_type(spark):
    schema = struct_from_ddl("a INT, b BIGINT, c TINYINT")
    df = spark.createDataFrame([(2**31, 2**40, 127), (0, 0, -128)], "a long, b long, c long")
    assert [r["column_name"] for r in q.int_overflows(df, schema).collect()] == ["a"]


def test_widening_plan_and_application(spark):
    schema = struct_from_ddl("a SMALLINT, s VARCHAR(2), f FLOAT, d DATE, ok INT")
    df = spark.createDataFrame(
        [(40000, "abcde", 1.0, dt.datetime(2024, 1, 1, 5), 1)], "a long, s string, f double, d timestamp, ok int"
    )
    plan = {c.column: c for c in q.propose_widening(df, "t", schema)}
    assert {c: (w.old, w.new) for c, w in plan.items()} == {
        "a": ("SMALLINT", "INT"),
        "s": ("VARCHAR(2)", "VARCHAR(6)"),
        "f": ("FLOAT", "DOUBLE"),
        "d": ("DATE", "DATETIME"),
    }
    assert plan["a"].statement == "t.a: SMALLINT to INT"
    new = q.widened(schema, plan.values())
    assert new["a"].dataType.simpleString() == "int" and new["s"].metadata["max_bytes"] == 6
    with pytest.raises(ValueError, match="not a widening"):
        q.widened(schema, [q.Widening("t", "ok", "INT", "SMALLINT", "")])
    log = q.widening_log(spark, plan.values(), dt.datetime(2024, 1, 1)).collect()
    assert len(log) == 4 and any('"column": "a"' in r["change"] for r in log)


def test_all_null_columns_need_no_widening(spark):
    df = spark.createDataFrame([(None, None)], "a long, s string")
    assert q.propose_widening(df, "t", struct_from_ddl("a SMALLINT, s VARCHAR(2)")) == []


def test_text_in_numeric(spark):
    df = spark.createDataFrame([("1", 1)], "a string, b int")
    assert q.text_in_numeric(df, struct_from_ddl("a INT, b INT")) == ["a"]


def test_orphans_count_fact_rows(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("b",), ("b",)], "k string")
    assert [tuple(r) for r in q.orphans(fact, dim, "k", "k").collect()] == [("a", 2)]


def test_volume_alerts(spark):
    now = spark.createDataFrame([("x", 30), ("y", 10), ("z", 4)], "t string, rows long")
    before = spark.createDataFrame([("x", 10), ("y", 10), ("z", 10)], "t string, rows long")
    alerts = {r["t"]: r["alert"] for r in q.volume_alerts(now, before, "t").collect()}
    assert alerts == {"x": "increase", "y": "none", "z": "decrease"}
    levels = now.select(q.error_level(F.lit(2), F.lit(100)).alias("a"), q.error_level(F.lit(0), F.lit(1)).alias("b"))
    assert tuple(levels.first()) == ("critical", "ok")


def test_standardise(spark):
    df = spark.createDataFrame(
        [(" a1\t", " X@Y ", 1.005, "  "), (None, "", float("inf"), "k ")], "customer_code string, email string, v double, o string"
    )
    assert [tuple(r) for r in q.standardise(df).collect()] == [("A1", "x@y", 1.01, None), (None, None, None, "k")]


def test_retention_and_audit(spark):
    df = spark.createDataFrame([(20240101,), (20230101,), (None,)], "d int")
    kept = q.within_retention(df, "d", dt.date(2024, 6, 1), 365)
    assert sorted(str(r["d"]) for r in kept.collect()) == ["20240101", "None"]
    out = q.audit_columns(df, "b1", dt.datetime(2024, 1, 1), "erp")
    assert out.columns[1:] == [
        "created_at",
        "updated_at",
        "created_by",
        "updated_by",
        "source_file",
        "source_system",
        "load_timestamp",
        "load_batch_id",
    ]


def test_first_per_key_and_running_total(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("b", 1, 1), ("a", 1, 7), (None, 1, 3)], "g string, d int, v int")
    first = records.first_per_key(df, ["g"], [F.desc("d"), F.desc("v")])
    assert sorted(map(str, (tuple(r) for r in first.collect()))) == sorted(map(str, [("a", 2, 5), ("b", 1, 1), (None, 1, 3)]))
    total = records.running_total(df, "g", "d", "v", "t").collect()
    assert sorted(str((r["g"], r["d"], r["t"])) for r in total) == sorted(
        map(str, [("a", 1, 17), ("a", 1, 17), ("a", 2, 22), ("b", 1, 1), (None, 1, 3)])
    )


def test_first_per_key_thins_out_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    plan = records.first_per_key(df, ["g"], [F.desc("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_running_total_windows_over_days_only(spark):
    """A group holding most rows reaches the window as one row per day."""
    df = spark.range(30000).selectExpr("IF(id % 3 > 0, 1, CAST(id % 7 AS INT)) AS g", "CAST(id % 20 AS INT) AS d", "1 AS v")
    out = records.running_total(df, "g", "d", "v", "t")
    assert out.count() == 30000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    want = {}
    for r in df.collect():
        want[(r["g"], r["d"])] = want.get((r["g"], r["d"]), 0) + r["v"]
    got = {(r["g"], r["d"]): r["t"] for r in out.distinct().collect()}
    for (g, d), t in got.items():
        assert t == sum(v for (g2, d2), v in want.items() if g2 == g and d2 <= d)


def test_unpivot_scans_once(spark):
    df = spark.range(3).selectExpr("id", "cast(id as string) a", "cast(null as string) b", "cast(id + 1 as string) c")
    out = records.unpivot(df, ["id"], ["a", "b", "c"])
    assert out.count() == 6
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
