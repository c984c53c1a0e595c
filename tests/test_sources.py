import gzip

import pytest
from pyspark.sql import functions as F

from salesmill.functions.ddl import struct_from_ddl
from salesmill.config import TableSpec
from salesmill.operators.load import Table
from salesmill.sources import files, lookup, routing, seeds


def write(path, text, gz=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as fh:
            fh.write(text)
    else:
        path.write_text(text, encoding="utf-8")


def test_csv_is_text_with_null_marker(spark, tmp_path):
    write(tmp_path / "a.csv", 'invoicedate,code,note\n20240101,007,\x00\n20230101,"x,y",\n')
    df = files.read_csv_text(spark, str(tmp_path / "a.csv"))
    assert set(df.dtypes) == {("invoicedate", "string"), ("code", "string"), ("note", "string")}
    assert [tuple(r) for r in df.collect()] == [("20240101", "007", None), ("20230101", "x,y", None)]


def test_malformed_row_fails(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv_text(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()


def test_wrong_header_fails(spark, tmp_path):
    write(tmp_path / "a.csv", "c,a\n1,2\n")
    with pytest.raises(Exception, match="header|HEADER"):
        files.read_csv_text(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    write(tmp_path / "in" / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "in" / "2.csv", "b,a\n4,3\n")
    write(tmp_path / "in" / "3.csv", "")
    for columns in (None, ["a", "b"], ["b", "a"]):
        df = files.read_csv_text(spark, str(tmp_path / "in"), columns)
        assert sorted((r["a"], r["b"]) for r in df.collect()) == [("1", "2"), ("3", "4")]
    write(tmp_path / "in" / "4.csv", "a\n5\n")
    assert sorted(map(str, files.read_csv_text(spark, str(tmp_path / "in")).select("b").collect()))[-1] == "Row(b=None)"
    with pytest.raises(ValueError, match="4.csv"):
        files.read_csv_text(spark, str(tmp_path / "in"), ["a", "b"])


def test_quotes_backslashes_and_line_breaks(spark, tmp_path):
    write(tmp_path / "q.csv", 'a,b\n"say ""hi"", ok","C:\\"\nx\\y,"\\"""\n')
    got = [tuple(r) for r in files.read_csv_text(spark, str(tmp_path / "q.csv")).collect()]
    assert got == [('say "hi", ok', "C:\\"), ("x\\y", '\\"')]
    write(tmp_path / "m.csv", 'a,b\n"two\nlines",1\n')
    got = files.read_csv_text(spark, str(tmp_path / "m.csv"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [("two\nlines", "1")]


def test_gzip_and_cutoff(spark, tmp_path):
    write(tmp_path / "in" / "a.csv.gz", "postingdate,v\n20230331,1\n20230401,2\n,3\n", gz=True)
    assert files.read_csv_text(spark, str(tmp_path / "in"), spread=3).rdd.getNumPartitions() == 3
    files.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), "postingdate", 20230331)
    assert [tuple(r) for r in files.read_parquet(spark, str(tmp_path / "out")).collect()] == [(20230401, "2")]
    assert files.row_count(spark, str(tmp_path / "out")) == 1


def test_bad_day_fails_the_conversion(spark, tmp_path):
    write(tmp_path / "a.csv", "invoicedate\nsoon\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.csv_to_parquet(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), "invoicedate", 1)


def test_export_marks_null_and_keeps_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("", "two\nlines \x01", None), ("b", 'q"t', 2)], "x string, y string, n int")
    files.write_delimited(df.coalesce(1), str(tmp_path / "e"))
    text = "".join(p.read_text() for p in (tmp_path / "e").glob("*.csv"))
    assert text == 'a\x01\\N\x011\n\x01"two\nlines \x01"\x01\\N\nb\x01"q""t"\x012\n'
    back = files.read_delimited(spark, str(tmp_path / "e"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_json(spark, tmp_path):
    write(tmp_path / "a.json", '[{"a": 1,\n "b": "x"}, {"a": 2}]')
    rows = files.read_json(spark, str(tmp_path / "a.json"), "a int, b string", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]


def test_pending_files(spark, tmp_path):
    write(tmp_path / "src" / "x" / "A.csv", "a\n1\n")
    write(tmp_path / "src" / "B.csv.gz", "a\n1\n", gz=True)
    write(tmp_path / "src" / "Empty.csv", "")
    write(tmp_path / "out" / "A.parquet", "x")
    waiting = files.pending(files.listing(spark, str(tmp_path / "src")), files.listing(spark, str(tmp_path / "out")))
    assert [r["stem"] for r in waiting.collect()] == ["B"]


def test_inventory_orders_dimensions_before_facts(spark, tmp_path):
    for name, n in (("FactInvoiceDetails_1", 3), ("RlsMaster", 1), ("DimMaterial", 2)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / name))
        part = next((tmp_path / name).glob("part*.parquet"))
        target = tmp_path / "all" / f"{name}.parquet"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(part.read_bytes())
    rows = files.inventory(spark.read.parquet(str(tmp_path / "all"))).collect()
    assert [(r["file_name"], r["row_count"]) for r in rows] == [
        ("DimMaterial.parquet", 2),
        ("RlsMaster.parquet", 1),
        ("FactInvoiceDetails_1.parquet", 3),
    ]


@pytest.mark.parametrize(
    "stem,table",
    [
        ("DimMaterial", "dim_material"),
        ("DimMaterialMapping", "dim_material_mapping"),
        ("DimMaterialMapping-MASTER", "dim_material_mapping"),
        ("FactInvoiceSecondary_107_112", "fact_invoice_secondary"),
        ("SomethingElse", "something_else"),
    ],
)
def test_table_for_stem(spark, stem, table):
    assert routing.table_for_stem(stem) == table
    df = spark.createDataFrame([(stem,)], "s string").select(routing.table_column("s").alias("t"))
    assert df.first()["t"] == (table if table != "something_else" else None)


@pytest.mark.parametrize(
    "name,entity",
    [
        ("DimMaterial.parquet", "DimMaterial"),
        ("Dim_Material.parquet", "DimMaterial"),
        ("dim_material.parquet", "DimMaterial"),
        ("DimHierarchy_9999_2025_12_02_14:01:46.parquet", "DimHierarchy"),
        ("DimDealer_MS_9999_2025_12_02_14:01:37.parquet", "DimDealerMaster"),
    ],
)
def test_entity_for_drop(name, entity):
    assert routing.entity_for_drop(name) == entity


def test_entity_column_follows_the_driver_form(spark):
    names = [
        "DimDealer_MS_9999_2025_12_02_14:01:37.parquet", "dimdealer_9999.PARQUET", "factInvoice_secondary_107_x", "dimMaterial_1234",
        "1234_abc", "abc", "a__b_12345_c", "dim_customer_123456", "", "_x", "x.parquet",
    ]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string").select("n", routing.entity_column("n").alias("e"))
    assert {r["n"]: r["e"] for r in df.collect()} == {n: routing.entity_for_drop(n) for n in names} | {None: None}


def test_sales_groups(spark):
    assert routing.sales_groups("FactInvoiceSecondary_107_112") == ["107", "112"]
    combined = routing.sales_groups("FactInvoiceDetails_107_112")
    assert combined[:3] == ["107", "112", "101"] and len(combined) == 41
    assert routing.sales_groups("FactInvoiceDetails_901") == ["901"]
    assert routing.is_dd_drop("FactInvoiceSecondary_DD") and routing.sales_groups("FactInvoiceSecondary_DD") == []
    df = spark.createDataFrame([("F_1_2",), ("F",)], "s string").select(routing.sales_groups_column("s").alias("g"))
    assert [r["g"] for r in df.collect()] == [["1", "2"], []]


def test_output_stem():
    assert routing.output_stem("FactInvoiceDetails_107_112_2024_01") == "FactInvoiceDetails_107_112"
    assert routing.output_stem("FactInvoiceSecondary_901_x") == "FactInvoiceSecondary_901"
    assert routing.output_stem("DimDealer_MS_9999") == "DimDealerMaster"
    assert routing.output_stem("DimMaterial_9999") == "DimMaterial"


SPEC = TableSpec("dim_sales_group", struct_from_ddl("division VARCHAR(50), sales_group SMALLINT, vertical VARCHAR(50)"))


def test_seeds(spark, tmp_path):
    write(tmp_path / "g.csv", "SalesGroup,Division,Vertical\n101, ,North\n105,West,\n")
    known = {"dim_sales_group": seeds.Seed("dim_sales_group", "g.csv"), "off": seeds.Seed("off", "g.csv", enabled=False)}
    target = Table(spark, str(tmp_path / "t"))
    for _ in range(2):
        assert seeds.load_seed(spark, known, "dim_sales_group", str(tmp_path), SPEC, target) == 2
    assert sorted(map(str, (tuple(r) for r in target.read().collect()))) == sorted(
        map(str, [(None, 101, "North"), ("West", 105, None)])
    )
    assert seeds.load_seed(spark, known, "off", str(tmp_path), SPEC, target) == 0
    with pytest.raises(KeyError):
        seeds.load_seed(spark, known, "nope", str(tmp_path), SPEC, target)


def test_seed_append(spark, tmp_path):
    write(tmp_path / "g.csv", "SalesGroup,Division,Vertical\n101,A,North\n")
    known = {"dim_sales_group": seeds.Seed("dim_sales_group", "g.csv", truncate_before_load=False)}
    target = Table(spark, str(tmp_path / "t"))
    for _ in range(2):
        seeds.load_seed(spark, known, "dim_sales_group", str(tmp_path), SPEC, target)
    assert target.read().count() == 2


def test_lookup_tables(spark, tmp_path):
    df = spark.createDataFrame([("a@x", ["T1", "T2"])], "email string, wss_territory_code array<string>")
    lookup.write_lookup(df, "rls_map", str(tmp_path))
    lookup.write_lookup(df, "rls_map", str(tmp_path))
    rows = lookup.read_lookup(spark, "rls_map", str(tmp_path)).select(F.explode("wss_territory_code").alias("t")).collect()
    assert [r["t"] for r in rows] == ["T1", "T2"]


def test_group_rows_equal_the_driver_form(spark):
    stems = ["FactInvoiceDetails_107_112", "FactInvoiceDetails_107_DD_112_305", "FactInvoiceDetails_112", "FactInvoiceSecondary_107_112", "DimMaterial"]
    df = spark.createDataFrame([(s,) for s in stems], "s string").select("s", routing.sales_groups_column("s").alias("g"))
    for r in df.collect():
        assert r["g"] == routing.sales_groups(r["s"])


def test_malformed_json_is_kept_apart(spark, tmp_path):
    from salesmill.functions.ddl import struct_from_ddl

    lines = ['{"a": 1, "b": "x"}', '{"a": "one"}', "no json", "", '{"b": "y", "c": 3}', '{"a": 2']
    (tmp_path / "x.json").write_text("\n".join(lines))
    got = [tuple(r) for r in files.read_json_lines(spark, str(tmp_path / "x.json"), struct_from_ddl("a INT, b VARCHAR(9)")).collect()]
    assert [r[2] for r in got] == [None, '{"a": "one"}', "no json", None, '{"a": 2']
    assert got[0][:2] == (1, "x") and got[3][:2] == (None, "y")


def test_schema_problems_of_a_folder(spark, tmp_path):
    from salesmill.functions.ddl import struct_from_ddl

    for name, cols in (("a", "id as k, 1.5D as v"), ("b", "id as k, 2.5D as v"), ("c d", "cast(id as int) as k, 'x' as more")):
        spark.range(3).coalesce(1).selectExpr(*cols.split(", ")).write.parquet(str(tmp_path / name))
    columns = files.parquet_columns(spark, str(tmp_path))
    assert columns.count() == 6
    found = {(r["path"].split("/")[-2].replace("%20", " "), r["column_name"], r["kind"], r["expected"], r["problem"]) for r in files.schema_problems(columns).collect()}
    assert found == {("c d", "k", "int", "bigint", "type differs"), ("c d", "v", None, "double", "missing"), ("c d", "more", "string", "string", "column of few files")}
    declared = files.schema_problems(columns, struct_from_ddl("k BIGINT, v DOUBLE, w INT")).collect()
    assert len(declared) == 3 + 3 and {r["problem"] for r in declared} == {"type differs", "missing", "not declared"}
