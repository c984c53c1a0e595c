import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.functions import dates, numbers, text
from salesmill.functions.ddl import struct_from_ddl
from salesmill.operators import convert


def one_column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def column(df, name="v"):
    return [r[name] for r in df.collect()]


def test_numbers_are_stripped_and_blanks_become_null(spark):
    df = one_column(spark, ["12", " 12 ", "\t7\n", None] * 20 + ["x", "12.0", ""])
    done = convert.convert(df, {"v": T.LongType()})
    got = column(done.frame)
    assert got[:4] == [12, 12, 7, None] and got[-3:] == [None, None, None]
    assert done.failures == {"v": 3}


def test_exactly_a_tenth_may_fail_but_no_more(spark):
    ok = one_column(spark, ["1"] * 9 + ["x"])
    assert column(convert.convert(ok, {"v": T.LongType()}).frame)[-1] is None
    bad = one_column(spark, ["1"] * 8 + ["x", "y"])
    with pytest.raises(convert.ConversionError):
        convert.convert(bad, {"v": T.LongType()})
    kept = convert.convert(bad, {"v": T.LongType()}, on_failure="keep")
    assert kept.kept_as_text == ("v",) and kept.frame.schema["v"].dataType == T.StringType()


def test_nulls_in_the_source_are_no_failures(spark):
    df = one_column(spark, [None] * 9 + ["5"])
    assert convert.convert(df, {"v": T.LongType()}, max_failures=0.0).failures == {"v": 0}


def test_java_suffixes_are_not_numbers(spark):
    df = one_column(spark, ["1.5", "1.5d", "2f", "inf"])
    assert column(df.select(numbers.lenient_double("v").alias("v"))) == [1.5, None, None, float("inf")]


def test_only_text_that_does_not_read_is_stripped(spark):
    values = ["7", " 7", "\t7\x0b", "\u20037\xa0", "\x007", "7\x7f", "7.5", "7.5\u3000", "1e3", "0x10", "Infinity", " nan ", "7d ", "7F", "7 d", "d", "", " ", "-", "99999999999999999999", None]
    df = one_column(spark, values)
    stripped = text.strip_all("v")
    plain = F.when(~F.col("v").rlike(r"[0-9.][dDfF]\s*$"), stripped.try_cast("double"))
    pairs = {
        "double": (numbers.lenient_double("v"), plain),
        "long": (numbers.lenient_long("v"), stripped.try_cast("bigint")),
        "decimal(6,2)": (convert.readings(F.col("v"), T.DecimalType(6, 2))["decimal(6,2)"], stripped.try_cast("decimal(6,2)")),
    }
    got = df.select([c.cast("string").alias(f"{k} {i}") for k, both in pairs.items() for i, c in enumerate(both)]).collect()
    for k in pairs:
        assert [r[f"{k} 0"] for r in got] == [r[f"{k} 1"] for r in got]
    shown = df.select(numbers.lenient_long("v").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("try_cast" if "try_cast" in shown else "cast(") < shown.index("trim(")
    assert df.select(numbers.lenient_long(F.lit(1.5)).alias("v")).first()[0] is None


@pytest.mark.parametrize(
    "values",
    [
        ["2024-01-05", "2024-1-5"],
        ["05/01/2024", "5/1/2024"],
        ["20240105", "20240105"],
        ["2024-01-05 10:20:30", "2024-1-5 1:2:3"],
    ],
)
def test_date_layouts(spark, values):
    done = convert.convert(one_column(spark, values), {"v": T.DateType()})
    assert column(done.frame) == [dt.date(2024, 1, 5)] * 2


def test_month_first_is_taken_when_day_first_fails(spark):
    done = convert.convert(one_column(spark, ["12/31/2024", "1/2/2024"]), {"v": T.DateType()})
    assert done.chosen == {"v": "M/d/yyyy"} and column(done.frame)[0] == dt.date(2024, 12, 31)


def test_one_layout_is_chosen_for_the_whole_column(spark):
    df = one_column(spark, ["5/1/2024"] * 19 + ["2024-01-05"])
    done = convert.convert(df, {"v": T.DateType()})
    assert done.chosen == {"v": "d/M/yyyy"} and column(done.frame)[-1] is None


def test_no_layout_fits(spark):
    with pytest.raises(convert.ConversionError):
        convert.convert(one_column(spark, ["soon", "2024-01-05"]), {"v": T.DateType()})


def test_decimals_keep_every_digit_and_flags_read_words(spark):
    df = spark.createDataFrame([(" 12345678901234567.895 ", "Yes"), ("7", " false ")], "d string, b string")
    out = convert.convert(df, {"d": T.DecimalType(20, 2), "b": T.BooleanType()}).frame.collect()
    assert [str(r["d"]) for r in out] == ["12345678901234567.90", "7.00"] and [r["b"] for r in out] == [True, False]


def test_mapped_conversion_keeps_columns_that_fail_once(spark):
    df = spark.createDataFrame([("1", "2", "2.5"), ("x", "3", "4")], "a string, b string, c string")
    done = convert.convert_mapped(df, struct_from_ddl("a SMALLINT, b INTEGER, c DOUBLE"))
    assert done.kept_as_text == ("a",)
    assert [f.dataType for f in done.frame.schema.fields] == [T.StringType(), T.IntegerType(), T.DoubleType()]


def test_strict_int_raises(spark):
    df = convert.strict_int(one_column(spark, ["20240101", "n/a"]), "v")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_lenient_types_rename_and_null(spark):
    df = spark.createDataFrame([("1", "x", 5)], "a string, b string, c int")
    out = convert.lenient_types(df, {"a": "int", "b": "float", "c": "str"}, {"a": "aa"})
    assert out.collect()[0].asDict() == {"aa": 1, "b": None, "c": "5"}


def test_profile_and_empty_frame(spark):
    df = spark.createDataFrame([(1, "Éa"), (None, None), (5, "abc")], "n int, s string")
    rows = {r["column_name"]: r for r in convert.profile(df).collect()}
    assert (rows["n"]["null_count"], rows["n"]["min_value"], rows["n"]["max_value"]) == (1, 1.0, 5.0)
    assert rows["s"]["max_bytes"] == 3 and rows["s"]["min_value"] is None
    empty = {r["column_name"]: r for r in convert.profile(df.limit(0)).collect()}
    assert empty["n"]["row_count"] == 0 and empty["n"]["max_value"] is None
    assert convert.convert(df.limit(0), {"s": T.LongType()}).failures == {"s": 0}
    assert convert.exact_ranges(df, ["n"]) == {"n": (1, 5)}


def test_profile_is_one_aggregation(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) s", "id * 2 d")
    plan = convert.profile(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_text_functions(spark):
    df = one_column(spark, ["  north\t east ", " x ", "", None])
    out = df.select(
        text.collapse_spaces("v").alias("c"), text.strip_all("v").alias("s"), text.blank_to_null("v").alias("b")
    ).collect()
    assert out[0]["c"] == "NORTH EAST" and out[1]["s"] == "x" and out[2]["b"] is None and out[3]["s"] is None


def test_mail_path_element(spark):
    df = one_column(spark, [" A.b-C d@X.com ", "é+1@x", "", None])
    assert column(df.select(text.mail_path_element("v").alias("v"))) == [
        "a_dot_b_c_d_at_x_dot_com",
        "é1_at_x",
        "",
        None,
    ]


def test_fiscal_calendar_and_days(spark):
    df = spark.createDataFrame([(20240331,), (20240401,), (20241231,), (None,), (20240230,)], "d int")
    rows = df.select(
        dates.fiscal_year("d").alias("y"),
        dates.fiscal_quarter("d").alias("q"),
        dates.days_since("d", dt.date(2025, 1, 1)).alias("n"),
        dates.year_month("d").alias("ym"),
    ).collect()
    assert [r["y"] for r in rows] == [2023, 2024, 2024, None, 2023]
    assert [r["q"] for r in rows][:3] == ["Q4", "Q1", "Q3"]
    assert [r["n"] for r in rows] == [276, 275, 1, None, None]
    assert rows[0]["ym"] == 202403


def test_number_functions(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (1.0, -2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    rows = df.select(
        numbers.guarded_ratio("a", "b").alias("g"),
        numbers.percent_change("a", "b").alias("p"),
        numbers.finite_or_null("a").alias("f"),
    ).collect()
    assert [r["g"] for r in rows[:3]] == [2.0, 0.0, 0.0]
    assert rows[0]["p"] == 100.0 and rows[1]["p"] is None and rows[4]["f"] is None
    flags = one_column(spark, ["Yes", "0", "maybe", None]).select(numbers.flag("v").alias("v"))
    assert column(flags) == [True, False, None, None]
    assert df.select(numbers.standard_decimal("a").alias("d")).schema["d"].dataType == T.DecimalType(18, 4)
    assert df.select(F.lit(1)).count() == 5
