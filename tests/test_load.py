import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from salesmill.operators import load
from salesmill.operators.load import Table


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, kind string, v double")


@pytest.fixture()
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"))


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_unknown_table(table):
    assert not table.exists()
    with pytest.raises(load.LoadError):
        table.read()


def test_append_and_replace(spark, table):
    table.append(frame(spark, [(1, "a", 1.0)]))
    table.append(frame(spark, [(2, "b", 2.0)]))
    assert content(table) == [(1, "a", 1.0), (2, "b", 2.0)]
    table.replace(table.read().withColumn("v", F.col("v") * 10))
    assert content(table) == [(1, "a", 10.0), (2, "b", 20.0)]
    assert len(table.commits()) == 1


def test_append_fits_columns_by_name(spark, table):
    table.append(frame(spark, [(1, "a", 1.0)]))
    table.append(spark.createDataFrame([("b", 7)], "KIND string, k long"))
    assert table.read().filter("k = 7").first().asDict() == {"k": 7, "kind": "b", "v": None}


def test_failed_load_leaves_the_table_alone(spark, table):
    table.replace(frame(spark, [(1, "a", 1.0)]))
    broken = frame(spark, [(2, "b", 2.0)]).withColumn("v", F.raise_error("boom").cast("double"))
    for attempt in (table.replace, table.append, lambda df: table.replace_slice(df, "kind = 'a'")):
        with pytest.raises(Exception, match="boom"):
            attempt(broken)
        assert content(table) == [(1, "a", 1.0)]


def test_lost_rows_are_noticed(spark, table, monkeypatch):
    table.replace(frame(spark, [(1, "a", 1.0)]))
    with pytest.raises(load.LoadError, match="expected"):
        table.check(table.commits()[0].path, table.schema(), 2)


def test_upsert_and_insert_missing(spark, table):
    table.replace(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]))
    table.upsert(frame(spark, [(2, "x", 9.0), (3, "c", 3.0)]), ["k"])
    assert content(table) == [(1, "a", 1.0), (2, "x", 9.0), (3, "c", 3.0)]
    table.insert_missing(frame(spark, [(3, "z", 0.0), (4, "d", 4.0)]), ["k"])
    assert content(table) == [(1, "a", 1.0), (2, "x", 9.0), (3, "c", 3.0), (4, "d", 4.0)]


def test_slices(spark, table):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0), (3, None, 3.0)]), partition_by=["kind"])
    table.replace_slice(frame(spark, [(9, "DD", 9.0)]), "kind = 'DD'")
    table.replace_slice(frame(spark, [(8, "DD", 8.0)]), "kind = 'DD'")
    rows = {r["k"]: r["kind"] for r in table.read().collect()}
    assert rows == {2: "SEC", 3: None, 8: "DD"}
    table.append(frame(spark, [(4, "DD", 4.0), (5, "new", 5.0)]))
    table.replace_slice(frame(spark, []), "kind = 'SEC'")
    rows = {r["k"]: r["kind"] for r in table.read().collect()}
    assert rows == {3: None, 8: "DD", 4: "DD", 5: "new"} and len(table.commits()) == 1
    table.compact()
    assert {r["k"]: r["kind"] for r in table.read().collect()} == rows


def test_slice_without_new_rows_is_emptied(spark, table):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0)]), partition_by=["kind"])
    table.replace_slice(frame(spark, []), "kind = 'DD'")
    assert content(table) == [(2, "SEC", 2.0)]


def test_slices_that_cut_through_partitions(spark, table):
    table.replace(frame(spark, [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, "c d/e%", 4.0), (5, None, 5.0)]), partition_by=["kind"])
    table.append(frame(spark, [(1, "b", 7.0), (6, "c d/e%", 6.0)]))
    table.replace_slice(frame(spark, [(9, "a", 9.0)]), "k = 1 OR k >= 4")
    assert content(table) == [(2, "a", 2.0), (3, "b", 3.0), (9, "a", 9.0)]
    table.delete("k = 9")
    assert content(table) == [(2, "a", 2.0), (3, "b", 3.0)]


def test_an_interrupted_exchange_is_finished(spark, table, monkeypatch):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0), (3, "x", 3.0)]), partition_by=["kind"])

    def broken(self, found):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Table, "_publish", broken)
        with pytest.raises(OSError, match="lost"):
            table.replace_slice(frame(spark, [(9, "DD", 9.0)]), "kind in ('DD', 'x')")
    again = Table(spark, table.root)
    assert content(again) == [(2, "SEC", 2.0), (9, "DD", 9.0)]
    assert [c.kind for c in again.commits()] == ["published"]


def test_an_exchange_interrupted_between_two_partitions_is_finished(spark, table, monkeypatch):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0), (3, "x/=y", 3.0)]), partition_by=["kind"])

    def half(self, files, staged, base, depth):
        name = sorted(s.getPath().getName() for s in files.listStatus(staged))[0]
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files.delete(path(base, name), True)
        files.rename(path(staged, name), path(base, name))
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Table, "_move", half)
        with pytest.raises(OSError, match="lost"):
            table.replace_slice(frame(spark, [(9, "DD", 9.0), (8, None, 8.0), (7, "x/=y", 7.0)]), "kind in ('DD', 'x/=y')")
    again = Table(spark, table.root)
    assert content(again) == [(2, "SEC", 2.0), (7, "x/=y", 7.0), (8, None, 8.0), (9, "DD", 9.0)]
    assert [c.kind for c in again.commits()] == ["published"]


def test_an_exchange_writes_its_rows_once(spark, table, monkeypatch):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0)]), partition_by=["kind"])
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **kw: written.append(path) or parquet(self, path, **kw))
    table.replace_slice(frame(spark, [(9, "DD", 9.0)]), "kind = 'DD'")
    assert len(written) == 1 and content(table) == [(2, "SEC", 2.0), (9, "DD", 9.0)]


def test_columns_are_fitted_behind_the_shuffle(spark, table):
    seen = []

    def fit(rows):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows.withColumns({"v": F.col("k") * 2.0, "note": F.lit(None).cast("string")})

    table.replace(frame(spark, [(1, "a", 0.0), (2, "b", 0.0)]).drop("v"), ["kind", "note"], fit)
    assert any("RebalancePartitions" in plan for plan in seen)
    rows = sorted((r["k"], r["kind"], r["v"], r["note"]) for r in table.read().collect())
    assert rows == [(1, "a", 2.0, None), (2, "b", 4.0, None)]
    table.replace_slice(frame(spark, [(3, "a", 0.0)]).drop("v"), "kind = 'a'", fit)
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [(2, 4.0), (3, 6.0)]


def test_empty_table(spark, table):
    table.replace(frame(spark, []))
    assert content(table) == [] and table.read().columns == ["k", "kind", "v"]


def test_evolve(spark, table, tmp_path):
    from salesmill.functions.ddl import struct_from_ddl

    table.replace(frame(spark, [(1, "a", 1.0)]))
    files = sorted(f for f in (tmp_path / "t" / "data").rglob("*.parquet"))
    table.evolve(struct_from_ddl("k BIGINT, kind VARCHAR(9), v DOUBLE"))
    table.append(spark.createDataFrame([(1 << 40, "b", 2.0)], "k long, kind string, v double"))
    assert table.read().schema["k"].dataType.simpleString() == "bigint"
    assert content(table) == [(1, "a", 1.0), (1 << 40, "b", 2.0)]
    assert set(files) < set((tmp_path / "t" / "data").rglob("*.parquet")) and len(table.commits()) == 3
    assert table.schema()["kind"].metadata["max_bytes"] == 9


def test_slice_conditions(spark):
    target = spark.createDataFrame([(107, "SEC"), (107, "DD"), (107, None), (5, "SEC"), (None, "SEC")], "sales_group_code int, record_type string")
    out = load.slice_replaced(target, target.limit(0), load.group_slice(["107", "112"]))
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(
        map(str, [(107, "DD"), (107, None), (5, "SEC"), (None, "SEC")])
    )
    out = load.slice_replaced(target, target.limit(0), load.group_slice(["107"], keep_dd=False))
    assert out.count() == 2
    with pytest.raises(ValueError):
        load.group_slice(["1) OR (1=1"])


def test_register_in_order(spark):
    views = {
        "b_view": (2, lambda t: t["a_view"].selectExpr("k + 1 AS k")),
        "a_view": (1, lambda t: t["base"].selectExpr("id AS k")),
    }
    assert load.register(spark, {"base": spark.range(2)}, views) == ["base", "a_view", "b_view"]
    assert spark.sql("SELECT max(k) AS m FROM b_view").first()["m"] == 2
    for name in ("base", "a_view", "b_view"):
        spark.catalog.dropTempView(name)
    assert load.register(spark, {"base": spark.range(2)}, views, protected=["a_view"]) == ["base", "b_view"]
    assert not spark.catalog.tableExists("a_view")


def test_upsert_rewrites_only_the_partitions_involved(spark, table):
    table.replace(frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "o'c", 3.0), (4, None, 4.0)]), partition_by=["kind"])
    table.upsert(frame(spark, [(1, "b", 9.0), (4, None, 8.0), (5, "o'c", 5.0)]), ["k"])
    rows = sorted((tuple(r) for r in table.read().collect()), key=str)
    assert rows == [(1, "b", 9.0), (2, "b", 2.0), (3, "o'c", 3.0), (4, None, 8.0), (5, "o'c", 5.0)]
    table.upsert(frame(spark, [(2, "b", 0.0)]), ["k"])
    assert sorted(r["v"] for r in table.read().collect()) == [0.0, 3.0, 5.0, 8.0, 9.0]


def test_upsert_of_many_partitions_and_timestamps(spark, table):
    rows = spark.range(300).selectExpr(
        "cast(id as int) as k", "timestamp_seconds(id * 3601) as kind", "cast(id as double) as v"
    ).union(spark.sql("select -1, cast(null as timestamp), -1.0D"))
    table.replace(rows, partition_by=["kind"])
    table.upsert(rows.filter("k % 2 = 1 or k = -1").withColumn("v", F.lit(0.0)), ["k"])
    got = table.read()
    assert got.count() == 301 and got.select("k").distinct().count() == 301
    assert got.filter("v = 0").count() == 152
    assert len(table.commits()) == 1


def test_one_key_rewrites_one_part(spark, table, tmp_path):
    rows = spark.range(1000).selectExpr("cast(id as int) k", "'a' kind", "0.0D v").withColumn("part", load.hash_part(["k"], 8))
    table.replace(rows, partition_by=["part"])
    before = set((tmp_path / "t" / "data").glob("*/_rejected=false/part=*/*.parquet"))
    table.upsert(rows.filter("k = 5").withColumn("v", F.lit(1.0)), ["k"])
    base = {f.parent.parent for f in before}
    after = {f for b in base for f in b.glob("part=*/*.parquet")}
    assert len({f.parent for f in before - after}) == 1 and len({f.parent for f in after}) == 8
    assert table.read().count() == 1000 and table.read().filter("v = 1").count() == 1


def test_keys_repeated_in_a_batch_are_stored_once(spark, table):
    batch = frame(spark, [(1, "a", 1.0), (1, "b", 2.0), (2, "c", None), (2, "c", None)])
    table.insert_missing(batch, ["k"])
    assert sorted(r["k"] for r in table.read().collect()) == [1, 2]
    table.upsert(batch, ["k"], [F.col("v").asc_nulls_last()])
    assert sorted(map(str, content(table))) == ["(1, 'a', 1.0)", "(2, 'c', None)"]
    assert sorted(r["k"] for r in load.new_only(table.read(), frame(spark, [(3, "x", 1.0), (3, "y", 1.0)]), ["k"]).collect()) == [3]


def test_delete_keeps_rows_with_an_unknown_condition(spark, table):
    table.replace(frame(spark, [(1, "a", 1.0), (2, None, 2.0), (3, "b", 3.0)]))
    table.delete("kind = 'a'")
    assert sorted(r["k"] for r in table.read().collect()) == [2, 3]
    table.append(frame(spark, [(4, "a", 4.0)]))
    assert sorted(r["k"] for r in table.read().collect()) == [2, 3, 4]


def test_buckets_save_the_shuffle(spark):
    df = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    load.save_bucketed(df, "bucketed_a", ["k"], 4)
    load.save_bucketed(df, "bucketed_b", ["k"], 4)
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 100


def test_month_partitions(spark, table):
    from salesmill.functions.dates import year_month

    days = spark.createDataFrame([(20240105,), (20240210,), (20240211,)], "invoice_date int")
    table.replace(days.withColumn("year_month", year_month("invoice_date")), partition_by=["year_month"])
    february = table.read().filter("year_month = 202402")
    assert february.count() == 2
    assert "PartitionFilters: [isnotnull(year_month" in february._jdf.queryExecution().executedPlan().toString()


def test_many_slices_read_as_one(spark, table):
    table.replace(frame(spark, [(1, "DD", 1.0), (2, "SEC", 2.0)]), partition_by=["kind"])
    plan = lambda: re.sub(r"#\d+|file:\S+", "", table.read()._jdf.queryExecution().optimizedPlan().toString())
    first = plan()
    for i in range(6):
        table.replace_slice(frame(spark, [(9, "DD", float(i))]), "kind = 'DD'")
    assert plan() == first and content(table) == [(2, "SEC", 2.0), (9, "DD", 5.0)]


def test_vacuum_removes_what_nothing_names(spark, table, tmp_path):
    import datetime as dt

    table.replace(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), partition_by=["kind"])
    table.append(frame(spark, [(3, "a", 3.0)]))
    table.upsert(frame(spark, [(1, "a", 5.0)]), ["k"])
    before = content(table)
    assert table.vacuum(dt.timedelta(days=1)) == []
    table.compact()
    assert len(table.vacuum(dt.timedelta(0))) >= 3
    assert content(table) == before and len(table.commits()) == 1
    table.append(frame(spark, [(7, "c", 7.0)]))
    assert (7, "c", 7.0) in content(table)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_repeated_keys_can_end_the_job(spark):
    from salesmill.operators.records import settle_duplicates

    once, twice = frame(spark, [(1, "a", 1.0), (None, "a", 1.0)]), frame(spark, [(1, "a", 1.0), (1, "b", 2.0)])
    assert settle_duplicates(once, ["k"], "fail").count() == 2
    with pytest.raises(Exception, match="is repeated"):
        settle_duplicates(twice, ["k"], "fail").collect()
    assert [r["is_duplicate"] for r in settle_duplicates(twice, ["k"], "warn").collect()] == [True, True]
    with pytest.raises(ValueError):
        settle_duplicates(twice, ["k"], "remove")


def test_bucketed_join_has_no_exchange(spark):
    from salesmill.workload import jobs

    out = jobs.order_totals(*jobs.bucketed(spark, "/root/testdata/sf0.001", 4))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and out.count() > 0
