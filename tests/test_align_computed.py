import datetime as dt

import pytest

from salesmill.config import TableSpec
from salesmill.functions.ddl import struct_from_ddl
from salesmill.operators import align, computed
from salesmill.tables import SPECS

SCHEMA = struct_from_ddl("code VARCHAR(5), amount DOUBLE, day INTEGER")


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "junk int, AMOUNT double, Code string")
    fitted = align.align(df, SCHEMA)
    assert fitted.frame.columns == ["code", "amount", "day"]
    assert fitted.missing == ("day",) and fitted.extra == ("junk",)
    assert fitted.frame.first().asDict() == {"code": "x", "amount": 2.0, "day": None}
    again = align.align(fitted.frame, SCHEMA)
    assert again.missing == again.extra == () and again.frame.collect() == fitted.frame.collect()


def test_conform_casts_or_fails(spark):
    df = spark.createDataFrame([("1.5", "7")], "amount string, day string")
    row = align.conform(df, SCHEMA).first()
    assert row["amount"] == 1.5 and row["day"] == 7 and row["code"] is None
    bad = spark.createDataFrame([("x",)], "day string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        align.conform(bad, SCHEMA).collect()


def test_rename_mapped_reports_absent(spark):
    df = spark.createDataFrame([(1, 2)], "invoicedate int, other int")
    out, absent = align.rename_mapped(df, {"invoicedate": "invoice_date", "gone": "g", "other": "other"})
    assert out.columns == ["invoice_date", "other"] and absent == ["gone"]


def test_squash_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="collide"):
        align.rename_squashed(df)


def test_rename_reserved(spark):
    out, renamed = align.rename_reserved(spark.createDataFrame([(1, 2)], "`Div` int, division int"))
    assert out.columns == ["Div_raw", "division"] and renamed == {"Div": "Div_raw"}


def test_matched_rename_claims_a_target_once(spark):
    df = spark.createDataFrame([(1, 2)], "`Code` string, `co-de` string")
    assert align.rename_matched(df, SPECS["rls_master"].types | {"code": "VARCHAR(5)"}).columns == ["code", "co-de"]


def test_union_all_fills_missing(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert sorted(map(tuple, align.union_all([a, b]).collect())) == [(1, None), (2, "y")]


def test_mapping_problems():
    spec = TableSpec("t", SCHEMA)
    assert align.mapping_problems(spec, spec.mapping) == []
    problems = align.mapping_problems(spec, {"a": "nope"}, required=["code"])
    assert {p["problem"] for p in problems} == {"target column is not declared", "required column is not mapped"}


def test_key_of_the_sample_frame(spark):
    df = spark.createDataFrame(
        [("20240101", "C1", "I1"), ("20240102", None, "I2"), (None, None, None)],
        "invoice_date string, customer_code string, invoice_no string",
    )
    out, skipped = computed.add_computed(df, SPECS["fact_invoice_secondary"].computed)
    assert skipped == {}
    assert [r["fis_sg_id_cc_in"] for r in out.collect()] == ["20240101_C1_I1", "20240102_NULL_I2", "NULL_NULL_NULL"]


def test_missing_source_skips_the_column(spark):
    out, skipped = computed.add_computed(spark.range(1), SPECS["fact_invoice_secondary"].computed)
    assert out.columns == ["id"] and skipped == {"fis_sg_id_cc_in": ["customer_code", "invoice_date", "invoice_no"]}


def test_cycles_and_self_reference_are_refused():
    loop = {
        "a": {"type": "calculation", "formula": "b + 1"},
        "b": {"type": "calculation", "formula": "a + 1"},
    }
    with pytest.raises(ValueError, match="depend on each other"):
        computed.build_order(loop)
    with pytest.raises(ValueError, match="by itself"):
        computed.build_order({"a": {"type": "calculation", "formula": "a + 1"}})


def test_calculation_null_policies(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    rule = {"type": "calculation", "formula": "a * b"}
    assert computed.add_computed(df, {"c": rule})[0].first()["c"] is None
    assert computed.add_computed(df, {"c": rule | {"nulls": "zero"}})[0].first()["c"] == 0.0
    with pytest.raises(Exception, match="no value for"):
        computed.add_computed(df, {"c": rule | {"nulls": "error"}})[0].collect()


def test_lookup_keeps_rows_without_a_match(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    ref = spark.createDataFrame([("a", 1)], "key string, val int")
    out, _ = computed.add_computed(
        df, {"v": {"type": "lookup", "table": "ref", "on": "k", "key": "key", "value": "val"}}, {"ref": ref}
    )
    assert out.count() == 3
    assert {r["k"]: r["v"] for r in out.collect()} == {"a": 1, "z": None, None: None}


def test_definition_problems_and_dates(spark):
    definitions = {
        "n": {"type": "days_since", "column": "day", "as_of": dt.date(2024, 1, 2)},
        "bad": {"type": "concatenation", "columns": ["code", "nope"]},
    }
    assert computed.definition_problems(SCHEMA, definitions) == [{"column": "bad", "missing": ["nope"]}]


def test_formula_columns_are_those_that_spark_sees(spark):
    names = computed.formula_columns("CAST(k AS double) / 2 + coalesce(`Odd Name`, upper('text')) + CASE WHEN Net > 0 THEN 1 END")
    assert names == {"k", "Odd Name", "Net"}
    df = spark.createDataFrame([(3, 4)], "k int, net int")
    out, skipped = computed.add_computed(df, {"h": {"type": "calculation", "formula": "CAST(k AS double) / 2 + NET"}})
    assert skipped == {} and out.first()["h"] == 5.5


def test_definition_report(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    made = {
        "d": {"type": "calculation", "formula": "c + 1"},
        "c": {"type": "calculation", "formula": "a + b"},
        "f": {"type": "calculation", "formula": "e + 1"},
        "e": {"type": "calculation", "formula": "z + 1"},
    }
    rows = {r["name"]: (r["missing"], r["filled"]) for r in computed.definition_report(df, made).collect()}
    assert rows == {"d": ("", 1), "c": ("", 1), "e": ("z", 0), "f": ("e", 0)}
    with pytest.raises(ValueError):
        computed.definition_report(df, {"c": {"type": "calculation", "formula": "d"}, "d": {"type": "calculation", "formula": "c"}})
