import pytest
from pyspark.sql import functions as F

from salesmill.operators import access
from salesmill.samples import shapes

HIERARCHY = (
    "primary_key string, txn_type string, wss_territory_code string, cluster_code string, division_code short, "
    "sales_group short, sh_2_email string, sh_3_email string, sh_4_email string, sh_5_email string, "
    "sh_6_email string, sh_7_email string"
)


def hierarchy(spark, *lines):
    rows = [(str(i), kind, territory, "C", 1, 1, *mails) for i, (kind, territory, mails) in enumerate(lines)]
    return spark.createDataFrame(rows, HIERARCHY)


SALES = "Primary Sales Hierarchy"
POLICY = access.policy_of({"roles": ["manager", "auditor"]})


@pytest.fixture()
def people(spark):
    return hierarchy(
        spark,
        (SALES, "T2", ("a@x.com", "B@x.com ", "b@x.com", None, "", "top@x.com")),
        (SALES, "T1", ("c@x.com", "b@x.com", "a@x.com", " ", None, "top@x.com")),
        (SALES, "T1", (None, "b@x.com", None, None, None, "top@x.com")),
        ("Other", "T9", ("a@x.com", None, None, None, None, "top@x.com")),
        (SALES, "T3", ("solo@x.com", "solo@x.com", None, None, None, None)),
    )


def test_access_map(people):
    got = {r["email"]: (r["wss_territory_code"], r["territory_count"]) for r in access.access_map(people).collect()}
    assert got == {
        "a@x.com": (["T1", "T2"], 2),
        "b@x.com": (["T1", "T2"], 2),
        "c@x.com": (["T1"], 1),
        "top@x.com": (["T1", "T2"], 2),
        "solo@x.com": (["T3"], 1),
    }


def test_paths_drop_only_adjacent_repeats(people):
    paths = {r["wss_territory_code"]: r for r in access.hierarchy_paths(people).collect()}
    assert set(paths) == {"T1", "T2"}
    assert paths["T2"]["hierarchy_path"] == "a_at_x_dot_com.b_at_x_dot_com.top_at_x_dot_com"
    assert paths["T1"]["hierarchy_path"] == "c_at_x_dot_com.b_at_x_dot_com.a_at_x_dot_com.top_at_x_dot_com"
    assert paths["T2"]["email_id"] == "a@x.com" and paths["T2"]["sh_3"] == "B@x.com "


def test_path_lookup_finds_first_middle_and_last(people):
    master = access.hierarchy_paths(people)

    def found(mail):
        return sorted(r[0] for r in access.path_territories(master, mail).collect())

    assert found("A@X.com") == ["T1", "T2"] and found("c@x.com") == ["T1"] and found("top@x.com") == ["T1", "T2"]
    assert found("x.com") == [] and found("") == []


def test_dealer_map(spark, people):
    dealers = spark.createDataFrame([("D1", "T1"), ("D2", "T2"), ("D1", "T1")], "dealer_code string, tsi_territory_code string")
    got = sorted(map(tuple, access.dealer_map(people, dealers).collect()))
    assert [d for m, d in got if m == "a@x.com"] == ["D1", "D2"] and ("c@x.com", "D1") in got
    assert not any(m == "solo@x.com" for m, _ in got) and len(got) == len(set(got))


@pytest.fixture()
def view(spark):
    return spark.createDataFrame(
        [("T1", 1.0), ("T2", 2.0), ("T3", 4.0), (None, 8.0)], "wss_territory_code string, sales double"
    )


def total(df):
    return sum(r["sales"] for r in df.collect())


def test_known_user_sees_own_rows(people, view):
    grants = access.access_map(people)
    assert total(access.secure("secondary_sales_view", view, grants, " C@x.com", "manager", POLICY)) == 1.0
    assert total(access.secure("secondary_sales_view", view, grants, "top@x.com", "auditor", POLICY)) == 3.0


def test_unknown_user_sees_nothing(people, view):
    assert access.secure("secondary_sales_view", view, access.access_map(people), "who@x.com", "manager", POLICY).count() == 0


def test_unknown_role_or_view_is_refused(people, view):
    grants = access.access_map(people)
    with pytest.raises(access.AccessDenied):
        access.secure("secondary_sales_view", view, grants, "a@x.com", "guest", POLICY)
    with pytest.raises(access.AccessDenied):
        access.secure("dim_customer_master", view, grants, "a@x.com", "manager", POLICY)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT sum(sales) AS sales FROM {secondary_sales_view}",
        "WITH t AS (SELECT * FROM {secondary_sales_view}) SELECT sum(sales) AS sales FROM t WHERE sales > 0 GROUP BY 1 = 1",
        "SELECT sum(sales) AS sales FROM (SELECT sales FROM {secondary_sales_view} WHERE sales < 2 "
        "UNION ALL SELECT sales FROM {secondary_sales_view} WHERE sales >= 2) u",
        "SELECT sum(a.sales) AS sales FROM {secondary_sales_view} a JOIN {secondary_sales_view} b USING (wss_territory_code)",
    ],
)
def test_composed_queries_are_filtered(spark, people, view, text):
    out = access.query_as(
        spark, text, {"secondary_sales_view": view}, access.access_map(people), "a@x.com", "auditor", POLICY
    )
    assert out.first()["sales"] == 3.0


def test_filter_is_a_semi_join_below_the_aggregation(spark):
    from salesmill.workload.sales import STAR, secondary_view

    sf_dir = "/root/testdata/sf0.001"
    grants = access.access_map(shapes(spark, sf_dir, STAR)["dim_hierarchy"])
    mine = access.secure("secondary_sales_view", secondary_view(spark, sf_dir), grants, "head@example.com", "manager", POLICY)
    plan = mine.groupBy("wss_town").sum("sales")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Aggregate") < plan.index("LeftSemi")


@pytest.mark.parametrize(
    "text",
    [
        "SELECT * FROM secondary_sales_view",
        "SELECT * FROM parquet.`{path}`",
        "SELECT (SELECT max(sales) FROM secondary_sales_view) FROM {{secondary_sales_view}}",
        "SELECT * FROM {{secondary_sales_view}} WHERE sales IN (SELECT sales FROM secondary_sales_view)",
        "SELECT * FROM {{secondary_sales_view}} WHERE EXISTS (SELECT 1 FROM parquet.`{path}`)",
        "WITH t AS (SELECT * FROM secondary_sales_view) SELECT * FROM t",
        "WITH secondary_sales_view AS (SELECT * FROM secondary_sales_view) SELECT * FROM secondary_sales_view",
        "SELECT * FROM {{secondary_sales_view}}, LATERAL (SELECT * FROM secondary_sales_view)",
        "SELECT * FROM {{secondary_sales_view}} UNION ALL SELECT * FROM secondary_sales_view",
        "SELECT * FROM IDENTIFIER('secondary_sales_view')",
        "SELECT * FROM {{other_view}}",
        "SELECT * FROM range(3)",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM {{secondary_sales_view}}",
        "SELECT leak() FROM {{secondary_sales_view}}",
        "SELECT sales, IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home') AS leak FROM {{secondary_sales_view}}",
        "SELECT transform(array(1), x -> IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.home')) FROM {{secondary_sales_view}}",
        "SELECT (SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')) FROM {{secondary_sales_view}}",
        "SELECT sum(sales) OVER w FROM {{secondary_sales_view}} WINDOW w AS (ORDER BY IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'a'))",
        "SELECT sum(sales) OVER w FROM {{secondary_sales_view}} WINDOW w AS (ORDER BY reflect('java.lang.System', 'getProperty', 'a'))",
        "SELECT * FROM VALUES (reflect('java.lang.System', 'getProperty', 'user.home')) AS t(a), {{secondary_sales_view}}",
        "SELECT IDENTIFIER('sales') FROM {{secondary_sales_view}}",
        "SELECT (SELECT max(sales) FROM IDENTIFIER('secondary_' || 'sales_view')) FROM {{secondary_sales_view}}",
        "SELECT * FROM {{secondary_sales_view}} LATERAL VIEW nosuchgen(sales) t AS y",
        "SELECT * FROM {{secondary_sales_view}} LATERAL VIEW leak() t AS y",
        "SELECT * FROM {{secondary_sales_view}}, LATERAL (SELECT try_reflect('java.lang.System', 'getProperty', 'a'))",
        "SELECT :x FROM {{secondary_sales_view}}",
        "DROP VIEW secondary_sales_view",
        "CREATE VIEW mine AS SELECT * FROM secondary_sales_view",
        "INSERT INTO secondary_sales_view SELECT * FROM {{secondary_sales_view}}",
        "EXECUTE IMMEDIATE 'SELECT * FROM secondary_sales_view'",
        "SELECT TRANSFORM(sales) USING 'cat' FROM {{secondary_sales_view}}",
        "SET spark.sql.runSQLOnFiles = true",
        "SHOW TABLES",
        "SELECT 1; SELECT 2",
        "",
    ],
)
def test_anything_but_the_given_views_is_refused(spark, people, view, tmp_path, text):
    view.write.parquet(str(tmp_path / "plain"))
    view.createOrReplaceTempView("secondary_sales_view")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION leak() RETURNS DOUBLE RETURN (SELECT max(sales) FROM secondary_sales_view)")
    try:
        with pytest.raises(access.AccessDenied):
            access.query_as(
                spark,
                text.format(path=tmp_path / "plain"),
                {"secondary_sales_view": view},
                access.access_map(people),
                "a@x.com",
                "manager",
                POLICY,
            )
    finally:
        spark.catalog.dropTempView("secondary_sales_view")
        spark.sql("DROP TEMPORARY FUNCTION leak")


def test_refusal_leaves_no_view_behind(spark, people, view):
    before = {t.name for t in spark.catalog.listTables()}
    access.query_as(spark, "SELECT 1 AS one FROM {secondary_sales_view}", {"secondary_sales_view": view}, access.access_map(people), "a@x.com", "manager", POLICY)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_own_names_may_hide_others(spark, people, view):
    view.withColumn("sales", F.lit(100.0)).createOrReplaceTempView("hidden")
    text = "WITH hidden AS (SELECT sales FROM {secondary_sales_view}) SELECT sum(sales) AS sales FROM hidden"
    out = access.query_as(spark, text, {"secondary_sales_view": view}, access.access_map(people), "a@x.com", "auditor", POLICY)
    assert out.first()["sales"] == 3.0
    spark.catalog.dropTempView("hidden")


def test_no_roles_no_access():
    with pytest.raises(access.AccessDenied):
        access.policy_of({}).column_for("secondary_sales_view", "manager")


def test_what_users_write_is_allowed(spark, people, view):
    text = """
        WITH t AS (SELECT wss_territory_code AS code, sales, array(1, 2) AS xs FROM {secondary_sales_view})
        SELECT code, CASE WHEN sum(sales) > 1 THEN 'much' ELSE 'little' END AS kind, count(DISTINCT sales) AS n,
            max(y) FILTER (WHERE y > 0) AS y, CAST(sum(sales) AS INT) AS whole, upper(trim(code)) AS up,
            rank() OVER (ORDER BY sum(sales) DESC NULLS LAST) AS place, sum(sum(sales)) OVER w AS every,
            any_value(transform(xs, x -> x * 2)[0]) AS twice, date '2024-01-01' + interval 1 day AS day
        FROM t LATERAL VIEW explode(xs) g AS y
        WHERE (code LIKE 'T%' AND sales BETWEEN 0 AND 10) AND code NOT IN (SELECT upper('x')) AND sales <= (SELECT max(sales) FROM t)
        GROUP BY code HAVING count(*) > 0 WINDOW w AS (PARTITION BY 1) ORDER BY 1 LIMIT 10
    """
    out = access.query_as(spark, text, {"secondary_sales_view": view}, access.access_map(people), "a@x.com", "auditor", POLICY)
    assert [(r["code"], r["kind"], r["place"], r["every"], r["twice"]) for r in out.collect()] == [("T1", "much", 2, 6.0, 2), ("T2", "much", 1, 6.0, 2)]


def test_analysed_queries_are_checked_again(spark):
    spark.range(3).createOrReplaceTempView("given")
    spark.range(3).createOrReplaceTempView("other")
    access._check_analysed(spark.sql("SELECT id, (SELECT max(id) FROM given) AS m FROM given"), {"given"})
    for text in (
        "SELECT * FROM given JOIN other USING (id)",
        "SELECT (SELECT max(id) FROM other) FROM given",
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home') FROM given",
        "SELECT * FROM range(3)",
    ):
        with pytest.raises(access.AccessDenied):
            access._check_analysed(spark.sql(text), {"given"})
    spark.catalog.dropTempView("given")
    spark.catalog.dropTempView("other")


def test_a_stored_view_is_read_in_the_parts_of_the_user(spark, people, tmp_path):
    from salesmill.operators.load import Table
    from salesmill.plans.sales import refresh_snapshot

    rows = spark.range(4000).selectExpr("IF(id % 50 = 0, NULL, concat('T', id % 200)) AS wss_territory_code", "1.0D AS sales")
    target = Table(spark, str(tmp_path / "mv"))
    refresh_snapshot(rows, target)
    mine = access.secure("secondary_sales_mat_view", target.read(), access.access_map(people), "a@x.com", "auditor", POLICY)
    assert mine.columns == ["wss_territory_code", "sales"]
    assert mine.count() == 40 and {r[0] for r in mine.distinct().collect() for r in [r]} == {"T1", "T2"}
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and access.PART in plan
