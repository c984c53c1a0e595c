import itertools
import random

import pytest
from pyspark.sql import types as T

from salesmill.functions import names


def test_squash_ignores_quotes_spaces_and_marks():
    for spelled in ("invoice_date", "InvoiceDate", '"Invoice Date"', " invoice-date ", "invoice/date", "invoice%date"):
        assert names.squash(spelled) == "invoicedate"


def test_reserved_words_match_whole_names_only():
    assert names.is_reserved("Div") and names.is_reserved("select")
    assert not names.is_reserved("division") and not names.is_reserved("DropDownSelection")
    assert names.safe_name("key") == "key_raw" and names.safe_name("keys_1") == "keys_1"
    assert names.lookup_key('"Div"') == "div_raw" and names.lookup_key("branch code") == "branchcode"


def test_snake_case():
    assert names.snake_case("FactInvoiceSecondary") == "fact_invoice_secondary"
    assert names.snake_case("SomeTABLEName2X") == "some_table_name2_x"


def test_match_goes_from_exact_to_similar():
    targets = {"Invoice_Date": "INT", "invoice_date": "INT", "customer_code": "VARCHAR(12)", "dealer_code": "VARCHAR(9)"}
    assert names.match_column("invoice_date", targets) == "invoice_date"
    assert names.match_column("CUSTOMER_CODE", targets) == "customer_code"
    assert names.match_column("dealer code", targets) == "dealer_code"
    assert names.match_column("customercodes", targets) == "customer_code"
    assert names.match_column("territory", targets) is None
    assert names.match_column("x", {}) is None


def test_equal_keys_are_settled_by_type():
    targets = {"group_1": "SMALLINT", "group1": "VARCHAR(10)"}
    assert names.match_column("group-1", targets, T.StringType()) == "group1"
    assert names.match_column("group-1", targets, T.IntegerType()) == "group_1"
    assert names.match_column("group-1", targets) == "group_1"


def test_typed_match_takes_the_first_name_that_holds_the_type():
    targets = {"customer_group": "SMALLINT", "cm_customer_group": "VARCHAR(20)", "town": "VARCHAR(9)", "town_name": "VARCHAR(9)"}
    find = names.match_typed_column
    assert find("customer group", T.StringType(), targets, prefixes=["cm"]) == "cm_customer_group"
    assert find("customer group", T.LongType(), targets, prefixes=["cm"]) == "customer_group"
    assert find("customer group", T.StringType(), targets) == "customer_group"
    assert find("town", T.StringType(), targets) == "town"
    assert find("Town", T.StringType(), targets, {"town": "city"}) == "city"
    assert find("tow", T.StringType(), targets) == "town"
    assert find("nowhere", T.StringType(), targets) is None


def test_misspelled_names():
    targets = {"customer_code": "VARCHAR(12)", "invoice_number": "VARCHAR(9)"}
    assert names.match_column("custmer_code", targets) == "customer_code"
    assert names.match_column("invoice_numbr", targets) == "invoice_number"
    assert names.match_column("customer_name", targets) is None
    assert names.match_column("customer_name", targets, cutoff=0.5) == "customer_code"


def test_mapping_helpers():
    nested = {"columns": {"invoicedate": {"db_column": "invoice_date"}, "x": {}}}
    assert names.mapping_pairs(nested) == {"invoicedate": "invoice_date", "x": "x"}
    assert names.mapping_pairs({"a": "b"}) == {"a": "b"}
    assert names.target_name("INVOICEDATE", {"invoicedate": "invoice_date"}) == "invoice_date"
    assert names.target_name("other", {"invoicedate": "invoice_date"}) is None
    assert names.target_header(["Town", "zzzz"], {"town": "VARCHAR(1)"}) == (["town"], ["zzzz"])


def test_config_problems():
    good = {"table_name": "t", "columns": {"a": {"db_column": "b", "data_type": "INT"}}}
    assert names.config_problems(good) == []
    assert names.config_problems({"columns": {}}) == ["table_name is missing"]
    assert names.config_problems({"table_name": "t"}) == ["columns are missing"]
    assert names.config_problems({"table_name": "t", "columns": {"a": {"db_column": "b"}, "c": 1}}) == [
        "a: data_type is missing",
        "c: not a mapping",
    ]


def test_name_violations():
    found = names.name_violations(["ok_name", "BadName", "a" * 65, "order"], "sales_table")
    assert ("BadName", "not snake_case") in found and ("a" * 65, "too long") in found
    assert ("order", "reserved word") in found and ("sales_table", "unknown table prefix") in found
    assert names.name_violations(["ok_name"], "dim_ok") == []


def test_explain_matches(spark):
    df = spark.createDataFrame([("a", 1)], "`Group 1` string, other int")
    rows = {r["column_name"]: r for r in names.explain_matches(spark, df, {"group_1": "INT", "group1": "VARCHAR(3)"}).collect()}
    assert rows["Group 1"]["target"] == "group1" and rows["Group 1"]["same_key"] == ["group_1", "group1"]
    assert rows["other"]["target"] is None


def test_assignment_gives_no_target_twice():
    targets = {"invoice_no": "BIGINT", "town": "VARCHAR(9)", "town_name": "VARCHAR(9)", "value": "DOUBLE"}
    text = T.StringType()
    got = names.assign([("Invoice No", T.LongType()), ("invoice_no", T.LongType())], targets)
    assert got == {"invoice_no": "invoice_no"}
    # "tow" begins both; "twn" is close to one only, so the other column moves on.
    assert names.assign([("Town", text), ("town name", text), ("zzz", text)], targets) == {"Town": "town", "town name": "town_name"}
    assert names.assign([("tow", text), ("towm", text)], targets, prefixes=[]) == {"tow": "town"} | (
        {"towm": "town_name"} if names.match_score("towm", text, "town_name", "VARCHAR(9)") else {}
    )
    assert names.assign([("a", text), ("b", text)], targets, {"a": "value", "b": "value"}) == {"a": "value"}
    assert names.assign([], targets) == {} and names.assign([("x", text)], {}) == {}


def test_assignment_has_the_highest_total():
    rng = random.Random(5)
    for _ in range(300):
        columns, targets = [f"c{i}" for i in range(rng.randint(1, 5))], [f"t{i}" for i in range(rng.randint(1, 5))]
        score = {(c, t): rng.choice([0, 0, 0.5, 1, 1.5, 2, 3]) for c in columns for t in targets}
        with pytest.MonkeyPatch.context() as m:
            m.setattr(names, "match_score", lambda n, d, t, k, p=(): score[n, t])
            got = names.assign([(c, None) for c in columns], dict.fromkeys(targets, "INT"))
        assert len(set(got.values())) == len(got) and all(score[p] for p in got.items())
        padded = [*targets, *[None] * len(columns)]
        best = max(sum(score.get((c, t), 0) for c, t in zip(columns, p)) for p in itertools.permutations(padded, len(columns)))
        assert sum(score[p] for p in got.items()) == pytest.approx(best)


def test_explain_header_counts_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), (None, None)], "`Table` string, qty int")
    rows = {r["column_name"]: r for r in names.explain_header(df, {"qty": "INT"}).collect()}
    assert (rows["Table"]["lookup_key"], rows["Table"]["target"], rows["Table"]["filled"]) == ("table_raw", None, 2)
    assert rows["Table"]["problems"] == "not snake_case, reserved word"
    assert (rows["qty"]["target"], rows["qty"]["filled"], rows["qty"]["problems"]) == ("qty", 1, "")
    assert {r["filled"] for r in names.explain_header(df.limit(0), {}).collect()} == {0}
