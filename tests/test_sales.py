import re
from functools import reduce

import pytest
from pyspark.sql import functions as F

from salesmill import session
from salesmill.operators.load import Table
from salesmill.plans import facets, growth, sales
from salesmill.samples import shape, shapes
from salesmill.workload.sales import CUTOFF, PRIMARY_STAR, STAR, secondary_view

SF = "/root/testdata/sf0.001"


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_layouts(spark):
    assert secondary_view(spark, SF).columns == sales.SECONDARY_COLUMNS and len(sales.SECONDARY_COLUMNS) == 60
    primary = sales.primary_sales(shapes(spark, SF, PRIMARY_STAR))
    assert primary.columns == sales.PRIMARY_COLUMNS and len(sales.PRIMARY_COLUMNS) == 55


def test_unmatched_fact_rows_stay_and_double_dimension_rows_multiply(spark):
    t = shapes(spark, SF, STAR)
    base = sales.secondary_sales(t, CUTOFF).count()
    kept = t["fact_invoice_secondary"].filter(f"active_flag = 1 AND invoice_date >= {CUTOFF}").count()
    assert base == kept
    t["dim_material_mapping"] = t["dim_material_mapping"].unionByName(
        t["dim_material_mapping"].withColumn("material_code_sg_key", F.lit(None).cast("string"))
    )
    assert sales.secondary_sales(t, CUTOFF).count() == 2 * kept


def test_key_glued_from_null_matches_nothing(spark):
    t = shapes(spark, SF, STAR)
    t["fact_invoice_secondary"] = t["fact_invoice_secondary"].withColumn(
        "sales_group_code", F.lit(None).cast("smallint")
    )
    assert sales.secondary_sales(t, CUTOFF).filter("final_classification IS NOT NULL OR division IS NOT NULL").count() == 0


def test_view_reads_only_what_a_query_needs(spark):
    out = secondary_view(spark, SF).groupBy("sh_3_name").agg(F.sum("sales"))
    read = [line for line in plan(out, "executedPlan").splitlines() if "ReadSchema" in line]
    assert len(read) > 7 and not any(c in line for line in read for c in ("p_retailprice", "s_acctbal", "l_tax"))


def test_fact_filters_reach_the_scan(spark, tmp_path):
    t = shapes(spark, SF, STAR)
    t["fact_invoice_secondary"].write.parquet(str(tmp_path / "fact"))
    t["fact_invoice_secondary"] = spark.read.parquet(str(tmp_path / "fact"))
    text = plan(sales.secondary_sales(t, CUTOFF), "executedPlan")
    assert f"GreaterThanOrEqual(invoice_date,{CUTOFF})" in text and "EqualTo(active_flag,1)" in text


def test_big_dealer_side_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    t = shapes(spark, SF, STAR)
    big = sales.secondary_sales(t, CUTOFF)
    assert "rightHint=(strategy=broadcast)" not in plan(big)
    monkeypatch.undo()
    small = sales.secondary_sales(t, CUTOFF)
    assert "rightHint=(strategy=broadcast)" in plan(small)
    assert big.exceptAll(small).count() == 0


def joined_by(df):
    """Keys of the joins that fact rows pass, in their order."""
    lines = [line for line in plan(df).splitlines() if re.match(r"^[ :+-]*Join LeftOuter", line)]
    depth = [re.match(r"^[ :+-]*", line).end() for line in lines]
    outer = [line for i, line in enumerate(lines) if i == 0 or depth[i] > max(depth[:i])]
    return outer[::-1]


def test_wide_sides_are_joined_after_narrow_ones(spark):
    def place(joins, *patterns):
        return [next(i for i, line in enumerate(joins) if re.search(p, line)) for p in patterns]

    primary = joined_by(sales.primary_sales(shapes(spark, SF, PRIMARY_STAR)))
    order = place(primary, "concat", r"\(_item#\d+L? = ", "wss_code")
    assert order == sorted(order) and len(set(order)) == 3
    secondary = joined_by(secondary_view(spark, SF))
    order = place(secondary, "concat", r"\(_item#\d+L? = ", "_territory")
    assert order == sorted(order) and len(set(order)) == 3


def test_dealer_rows_with_several_territories(spark):
    t = shapes(spark, SF, STAR)
    customers = t["dim_customer_master"]
    again = customers.filter("CAST(customer_code AS INT) % 2 = 0")
    t["dim_customer_master"] = reduce(
        lambda a, b: a.unionByName(b),
        [customers, again, again.withColumn("wss_territory_code", F.lit(None).cast("string")), again.withColumn("wss_territory_code", F.lit("other"))],
    )
    t["dim_dealer_master"] = t["dim_dealer_master"].unionByName(t["dim_dealer_master"].limit(3))
    got = sales.secondary_sales(t, CUTOFF)
    side = sales._dealers(t).drop("dealer_sg_key").withColumnRenamed("_key", "_k")
    fact = sales._fact(t, CUTOFF).select("invoice_no", "sales", "dealer_sg_key")
    shown = ["invoice_no", "sales", "wss_code", "wss_territory_code", "dealer_code", "tsr_name"]
    want = fact.join(side, F.col("dealer_sg_key") == F.col("_k"), "left").select(shown)
    assert sorted(map(str, got.select(shown).collect())) == sorted(map(str, want.collect()))


def test_broadcast_is_bound_by_bytes(spark, monkeypatch):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    big = spark.range(5).selectExpr("CAST(id AS STRING) AS s")

    def hinted():
        return "strategy=broadcast" in plan(big.join(session.broadcast_if_small(wide), "s"))

    assert hinted()
    monkeypatch.setattr(session, "BROADCAST_BYTES", 9999)
    assert not hinted()


def test_snapshot_is_clustered_and_replaceable(spark, tmp_path):
    target = Table(spark, str(tmp_path / "mv"))
    view = secondary_view(spark, SF)
    for _ in range(2):
        sales.refresh_snapshot(view, target)
    assert target.read().count() == view.count() and len(target.commits()) == 1


def test_a_snapshot_of_narrow_lines_holds_the_view(spark, tmp_path, monkeypatch):
    t, plans = shapes(spark, SF, STAR), []
    want = sorted(map(str, sales.secondary_sales(t, CUTOFF).collect()))
    for most in (session.BROADCAST_ROWS, 1):
        monkeypatch.setattr(session, "BROADCAST_ROWS", most)
        lines, shown = sales.secondary_in_parts(t, CUTOFF)
        assert ("dealer_city" in lines.columns) == (most == 1)
        target = Table(spark, str(tmp_path / f"mv{most}"))
        sales.refresh_snapshot(lines, target, shown=lambda rows: plans.append((rows.columns, plan(rows))) or shown(rows))
        assert sorted(map(str, target.read().select(sales.SECONDARY_COLUMNS).collect())) == want
    sent = [columns for columns, text in plans if "RebalancePartitions" in text]
    assert sent and "dealer_city" not in sent[0]


QUARTERS = growth.Quarters.of_fiscal_third(2024)


def test_quarters():
    assert QUARTERS.current == (20241001, 20241231) and QUARTERS.previous_last_year == (20230701, 20230930)


def view_rows(spark, rows):
    return spark.createDataFrame(rows, "tsi_name string, sh_3_name string, invoice_date int, sales double")


def test_growth_decline(spark):
    days = {"now": 20241105, "now_ly": 20231105, "before": 20240801, "before_ly": 20230801}

    def rows(name, **amounts):
        return [(name, "C", days[k], v) for k, v in amounts.items()]

    data = (
        rows("slower", now=110.0, now_ly=100.0, before=150.0, before_ly=100.0)
        + rows("faster", now=200.0, now_ly=100.0, before=150.0, before_ly=100.0)
        + rows("no base", now=1.0, before=1.0, before_ly=1.0)
        + rows("zero base", now=1.0, now_ly=0.0, before=1.0, before_ly=1.0)
        + rows("not now", now_ly=1.0, before=1.0, before_ly=1.0)
        + rows("nothing before", now=50.0, now_ly=100.0, before_ly=100.0)
        + rows(None, now=110.0, now_ly=100.0, before=150.0, before_ly=100.0)
        + [("slower", "C", 20240102, 1e6)]
    )
    got = [tuple(r) for r in growth.growth_decline(view_rows(spark, data), QUARTERS).collect()]
    assert got == [("slower", "C", "10.0%", "50.0%", 40.0)]


def test_growth_reads_the_view_once(spark):
    text = plan(growth.growth_decline(view_rows(spark, [("a", "b", 20241105, 1.0)]), QUARTERS))
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1 and "Join" not in text


def test_facet_columns():
    assert len(facets.FACETS) == 29 and [f.priority for f in facets.FACETS] == list(range(1, 30))
    known = set(sales.SECONDARY_COLUMNS) | set(sales.PRIMARY_COLUMNS)
    assert all(f.column in known for f in facets.FACETS)


@pytest.fixture()
def small_view(spark):
    return spark.createDataFrame(
        [
            ("RING", "NORTH", "7", "T2", 20000.0),
            ("RING", "NORTH", "7", None, 20000.0),
            ("RING", "NORTH", "5", "T1", 10000.5),
            ("BOLT", "NORTH", "5", "T1", 10000.0),
            (None, "NORTH", "5", "T1", 20000.0),
            ("NUT", None, "5", "T1", 20000.0),
            ("CAP", "NORTH", "5", None, 20000.0),
        ],
        "product_name string, sales_group_name string, sales_group_code string, wss_territory_code string, sales double",
    )


def test_business_constants(spark, small_view):
    out = facets.business_constants({facets.SECONDARY: small_view}, 10000.0)
    rows = {r["value"]: r for r in out.filter("group_name = 'ProductName'").collect()}
    assert set(rows) == {"RING", "CAP"}
    assert rows["RING"]["sales_group_codes"] == ["5", "7"] and rows["RING"]["territory_codes"] == ["T1", "T2"]
    assert rows["CAP"]["territory_codes"] == [] and rows["CAP"]["search_text"] == "product name cap"
    assert facets.new_constants(out, out).count() == 0


def test_hot_item_keeps_every_row(spark):
    """One item on most fact rows, and too large a dimension to broadcast: nothing is lost."""
    old = {k: spark.conf.get(k, None) for k in _SKEW}
    try:
        for k, v in _SKEW.items():
            spark.conf.set(k, v)
        t = shapes(spark, SF, STAR)
        fact = shape(spark, SF, "fact_invoice_secondary")
        hot = F.when(F.col("line_no") <= 4, F.lit("1")).otherwise(F.col("item_code"))
        t["fact_invoice_secondary"] = fact.withColumn("item_code", hot)
        total = sales.secondary_sales(t, CUTOFF).agg(F.count("*"), F.sum(F.col("sales").cast("decimal(18,4)")))
        want = t["fact_invoice_secondary"].filter(f"active_flag = 1 AND invoice_date >= {CUTOFF}")
        wanted = want.agg(F.count("*"), F.sum(F.col("reporting_value").cast("decimal(18,4)")))
        assert tuple(total.collect()[0]) == tuple(wanted.first())
        final = plan(total, "executedPlan").split("== Initial Plan ==")[0]
        assert re.search(r"skew=true\) \[_item", final), "the hot item was not split"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
    # Without this the small test data ends up in one task, which cannot be split.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_growth_of_tables_equals_growth_of_the_view(spark):
    from salesmill.samples import shapes
    from salesmill.workload.sales import CONFIG, STAR
    from salesmill.workload.sales import QUARTERS as PERIODS

    t = shapes(spark, "/root/testdata/sf0.001", STAR)
    # Dimension rows that repeat fact rows, for some keys only.
    for name in ("dim_material", "dim_material_mapping", "dim_sales_group", "dim_dealer_master"):
        t[name] = t[name].unionByName(t[name].sample(0.5, 3))
    want = growth.growth_decline(sales.secondary_sales(t, CONFIG.secondary_cutoff, CONFIG.material_types), PERIODS)
    got = growth.growth_decline_of(t, PERIODS, CONFIG.secondary_cutoff, CONFIG.material_types)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_growth_sums_the_fact_before_any_join(spark):
    from salesmill.samples import shapes
    from salesmill.workload.sales import CONFIG, STAR
    from salesmill.workload.sales import QUARTERS as PERIODS

    t = shapes(spark, "/root/testdata/sf0.001", STAR)
    text = plan(growth.growth_decline_of(t, PERIODS, CONFIG.secondary_cutoff, CONFIG.material_types))
    lines = text.splitlines()
    fact = next(i for i, x in enumerate(lines) if "Relation" in x and "l_" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above, level = [], depth(lines[fact])
    for x in reversed(lines[:fact]):
        if depth(x) < level:
            above.append(x.lstrip(" :+-").split(" ")[0])
            level = depth(x)
    assert "Aggregate" in above
