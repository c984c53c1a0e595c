"""Row-level security."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import access
from ..operators.load import Table
from ..operators.records import unpivot
from ..plans import growth
from ..plans.sales import refresh_snapshot
from ..samples import shape, shape_cte, shapes
from ..session import shared_dir
from . import Workload
from .sales import CONFIG, QUARTERS, SECONDARY_CTE, STAR, growth_sql, secondary_in_parts, secondary_view

WORK = Workload()

USER, ROLE = "ZSM-1@example.com", "manager"
POLICY = access.policy_of({"roles": [ROLE, "auditor"]})

_LEVELS = [m.removesuffix("_email").removeprefix("sh_") for m in access.MAIL_LEVELS]

PAIRS_SQL = (
    "SELECT DISTINCT trim(lower(email)) AS email, wss_territory_code FROM ("
    + " UNION ALL ".join(
        f"SELECT wss_territory_code, sh_{n}_email AS email FROM dim_hierarchy WHERE txn_type LIKE '%Sales Hierarchy%'"
        for n in _LEVELS
    )
    + ") mails WHERE email IS NOT NULL AND trim(email) <> ''"
)
HIERARCHY_CTE = f"{shape_cte('dim_hierarchy')}, pairs AS ({PAIRS_SQL})"
SECURED_CTE = f"""{SECONDARY_CTE}, pairs AS ({PAIRS_SQL}),
    secured AS (
        SELECT * FROM secondary_view WHERE wss_territory_code IN (
            SELECT wss_territory_code FROM pairs WHERE email = lower('{USER}')))"""


def _access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.access_map(shape(spark, sf_dir, "dim_hierarchy"))


@WORK.add(
    "access_map",
    f"""{HIERARCHY_CTE}
    SELECT email, string_agg(wss_territory_code, ',' ORDER BY wss_territory_code) AS territory_codes,
        count(*) AS territory_count
    FROM pairs GROUP BY email ORDER BY email""",
)
def access_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _access(spark, sf_dir)
    codes = F.array_join("wss_territory_code", ",").alias("territory_codes")
    return out.select("email", codes, "territory_count").orderBy("email")


@WORK.add(
    "dealer_access_map",
    f"""{shape_cte("dim_hierarchy", "dim_dealer_master")}, pairs AS ({PAIRS_SQL})
    SELECT DISTINCT p.email, d.dealer_code
    FROM pairs p JOIN dim_dealer_master d ON d.tsi_territory_code = p.wss_territory_code""",
)
def dealer_access_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.dealer_map(shape(spark, sf_dir, "dim_hierarchy"), shape(spark, sf_dir, "dim_dealer_master"))


@WORK.add(
    "unpivot_emails",
    shape_cte("dim_hierarchy")
    + " UNION ALL ".join(
        f"SELECT primary_key, wss_territory_code, 'sh_{n}_email' AS level, sh_{n}_email AS email "
        f"FROM dim_hierarchy WHERE sh_{n}_email IS NOT NULL "
        for n in _LEVELS
    ),
)
def unpivot_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    hierarchy = shape(spark, sf_dir, "dim_hierarchy")
    return unpivot(hierarchy, ["primary_key", "wss_territory_code"], list(access.MAIL_LEVELS), "level", "email")


def _element_sql(mail: str) -> str:
    spelled = f"replace(replace(lower(regexp_replace({mail}, '^\\s+|\\s+$', '', 'g')), '@', '_at_'), '.', '_dot_')"
    return f"regexp_replace(translate({spelled}, '- ', '__'), '[^\\p{{L}}\\p{{N}}_]', '', 'g')"


PATHS_SQL = f"""
    mails AS (
        SELECT *, list_filter([{", ".join(access.MAIL_LEVELS)}], lambda m: m IS NOT NULL AND m <> '') AS people
        FROM dim_hierarchy WHERE txn_type LIKE '%Sales Hierarchy%' AND sh_2_email IS NOT NULL),
    stepped AS (SELECT *, list_transform(people, lambda m: {_element_sql("m")}) AS steps FROM mails),
    lined AS (
        SELECT *, list_filter(steps, lambda s, i: s <> '' AND (i = 1 OR steps[i - 1] <> s)) AS line FROM stepped),
    master AS (
        SELECT cluster_code AS cluster, division_code AS division, people[1] AS email_id,
            array_to_string(line, '.') AS hierarchy_path, sales_group,
            {", ".join(f"sh_{n}_email AS sh_{n}" for n in _LEVELS)}, wss_territory_code
        FROM lined WHERE len(line) >= 2)
"""


@WORK.add("hierarchy_path", f"{shape_cte('dim_hierarchy')}, {PATHS_SQL} SELECT * FROM master")
def hierarchy_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.hierarchy_paths(shape(spark, sf_dir, "dim_hierarchy"))


@WORK.add(
    "path_lookup",
    f"""{shape_cte('dim_hierarchy')}, {PATHS_SQL}
    SELECT DISTINCT wss_territory_code FROM master
    WHERE list_contains(string_split(hierarchy_path, '.'), 'zsm_1_at_example_dot_com')""",
)
def path_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = access.hierarchy_paths(shape(spark, sf_dir, "dim_hierarchy"))
    return access.path_territories(master, USER)


@WORK.add(
    "rls_secondary_sales",
    f"""{SECURED_CTE} SELECT invoice_no, invoice_date, wss_territory_code, wss_code, product_name, sales
    FROM secured""",
)
def rls_secondary_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = secondary_view(spark, sf_dir)
    mine = access.secure("secondary_sales_view", view, _access(spark, sf_dir), USER, ROLE, POLICY)
    return mine.select("invoice_no", "invoice_date", "wss_territory_code", "wss_code", "product_name", "sales")


@WORK.add("rls_growth", f"{SECURED_CTE}, {growth_sql('secured')}")
def rls_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The growth query of one user: dealers are limited to the user's territories before anything is joined to them."""
    grants = _access(spark, sf_dir)
    return growth.growth_decline_of(
        shapes(spark, sf_dir, STAR),
        QUARTERS,
        CONFIG.secondary_cutoff,
        CONFIG.material_types,
        lambda side: access.secure("secondary_sales_view", side, grants, USER, ROLE, POLICY),
    )


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored view of the given tables: made by the first query that asks, found by the others."""
    tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    stored = Table(spark, f"{shared_dir(spark)}/secondary_sales_mat_view-{spark.sparkContext.applicationId}-{tag}")
    if not stored.exists():
        lines, shown = secondary_in_parts(spark, sf_dir)
        refresh_snapshot(lines, stored, shown=shown)
    return stored.read()


_COMPOSED = """
    WITH towns AS (
        SELECT wss_town, count(*) AS line_count FROM {secured} WHERE volume >= 25 GROUP BY wss_town
    ), both_halves AS (
        SELECT wss_territory_code, sales FROM {secured} WHERE volume < 25
        UNION ALL
        SELECT wss_territory_code, sales FROM {secured} WHERE volume >= 25
    )
    SELECT 'territory' AS kind, wss_territory_code AS name, count(*) AS line_count,
        CAST(sum(CAST(sales AS DECIMAL(18, 4))) AS DOUBLE) AS sales
    FROM both_halves GROUP BY wss_territory_code
    UNION ALL
    SELECT 'town' AS kind, s.wss_town AS name, max(t.line_count) AS line_count,
        CAST(sum(CAST(s.sales AS DECIMAL(18, 4))) AS DOUBLE) AS sales
    FROM {secured} s JOIN towns t ON t.wss_town = s.wss_town GROUP BY s.wss_town
"""


@WORK.add("rls_composed_query", f"{SECURED_CTE}, result AS ({_COMPOSED.format(secured='secured')}) SELECT * FROM result")
def rls_composed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own SQL with CTEs, UNION branches and a join, over the stored, secured view.

    The text names the view four times; the snapshot keeps it from being joined
    four times, and of its parts only those of the user's territories are read.
    """
    text = _COMPOSED.replace("{secured}", "{secondary_sales_mat_view}")
    views = {"secondary_sales_mat_view": snapshot(spark, sf_dir)}
    return access.query_as(spark, text, views, _access(spark, sf_dir), USER, ROLE, POLICY)
