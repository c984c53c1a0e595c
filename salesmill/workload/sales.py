"""Sales views and the jobs on them."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.load import Table
from ..operators.records import latest_per_key
from ..plans import derived, dimensions, facets, growth, sales
from ..samples import shape, shape_cte, shapes
from ..session import scratch
from . import Workload

WORK = Workload()

CUTOFF = 19980401
CONFIG = PipelineConfig(tenant="sample", secondary_cutoff=CUTOFF, detail_cutoff=CUTOFF - 1)
RUN_DATE = dt.date(2024, 1, 31)
QUARTERS = growth.Quarters.of_fiscal_third(1999)

STAR = (
    "fact_invoice_secondary",
    "dim_sales_group",
    "dim_material",
    "dim_dealer_master",
    "dim_customer_master",
    "dim_material_mapping",
    "dim_hierarchy",
)
PRIMARY_STAR = (
    "fact_invoice_details",
    "dim_customer_master",
    "dim_sales_group",
    "dim_material",
    "dim_material_mapping",
)

SECONDARY_SQL = f"""
    SELECT
        c.customer_code AS wss_code, c.customer_group_3 AS wss_group_3, upper(c.customer_name) AS wss_name,
        upper(d.dealer_city) AS dealer_city, d.dealer_class, upper(d.dealer_district) AS dealer_district,
        d.dealer_code, d.dealer_group_code, d.dealer_name, upper(d.dealer_route_name) AS dealer_route_name,
        upper(d.dealer_state) AS dealer_state, d.tsi_type AS dealer_tsi_type,
        upper(d.dealer_type_1) AS dealer_type_1, d.dealer_type_2, d.dealer_type_3,
        upper(d.dealer_type_4) AS dealer_type_4, d.dealer_type_5, upper(d.dealer_type_6) AS dealer_type_6,
        upper(d.dealer_type_7) AS dealer_type_7, upper(d.dealer_type_12) AS dealer_type_12,
        upper(g.division) AS division, k.final_classification, upper(mm.brand) AS brand,
        upper(k.vertical) AS vertical, f.invoice_date, f.invoice_no, mm.parent_division_name,
        upper(c.pop_strata) AS pop_strata, m.material_description AS product_description,
        m.sales_group_code AS product_division_code, g.vertical AS sub_division,
        upper(m.product_group_1_description) AS product_category,
        upper(m.product_group_2_description) AS product_sub_category,
        upper(m.product_group_3_description) AS product_name, m.product_group_5_description AS pack_size,
        f.reporting_unit_in_each AS quantity, f.record_type, f.reporting_value AS sales,
        f.revised_net_value_mvg AS uvg, g.vertical AS sales_group, f.sales_group_code,
        upper(g.vertical) AS sales_group_name, c.cluster_code AS sh_3_code, upper(c.cluster) AS sh_3_name,
        c.branch_code AS sh_4_code, c.branch AS sh_4_name, c.cm_region_code AS sh_5_code,
        upper(c.region) AS sh_5_name, c.zone_code AS sh_6_code, upper(c.zone) AS sh_6_name,
        d.tsi_territory_code AS tsi_code, upper(trim(c.tsi_territory_name)) AS tsi_name,
        upper(trim(h.sh_2_name)) AS tsr_name, f.reporting_unit AS volume, c.wss_territory_code,
        upper(c.wss_territory_name) AS wss_territory_name, upper(c.town) AS wss_town, f.dealer_sg_key,
        d.tsi_code AS ssdm_tsr_code, d.tsi_name AS ssdm_tsr_name
    FROM fact_invoice_secondary f
    LEFT JOIN dim_sales_group g ON g.sales_group = f.sales_group_code
    LEFT JOIN dim_material m
        ON m.material_code = f.item_code AND m.active_flag = 'True' AND m.material_type = 'ZFGD'
    LEFT JOIN dim_dealer_master d ON d.dealer_sg_key = f.dealer_sg_key AND d.active_flag = 'True'
    LEFT JOIN dim_customer_master c ON c.customer_code = d.customer_code
    LEFT JOIN dim_material_mapping mm ON mm.material_code = f.item_code
    LEFT JOIN dim_material_mapping k
        ON k.material_code_sg_key = f.item_code || CAST(f.sales_group_code AS STRING)
    LEFT JOIN (
        SELECT sh_2_code, arg_max(sh_2_name, primary_key) AS sh_2_name FROM dim_hierarchy GROUP BY sh_2_code
    ) h ON h.sh_2_code = d.tsi_territory_code
    WHERE f.active_flag = 1 AND f.invoice_date >= {CUTOFF}
"""

PRIMARY_SQL = """
    SELECT
        f.customer_code AS wss_code, upper(c.customer_group) AS wss_group,
        CAST(c.customer_group_1 AS STRING) AS wss_group_1, CAST(c.customer_group_3 AS STRING) AS wss_group_3,
        upper(c.customer_group_3_status) AS wss_group_3_status, upper(c.customer_name) AS wss_name,
        upper(c.customer_block) AS wss_block, upper(c.district) AS wss_district, c.payment_method_name,
        c.credit_limit, c.customer_creation_date, c.population, f.division_code AS division,
        k.final_classification, c.grand_parent_customer_code AS grand_parent_wss_code, f.invoice_no,
        f.invoice_type, f.posting_date AS invoice_date, c.parent_customer_code AS parent_wss_code,
        CAST(f.billing_quantity_in_stock_keeping_unit AS DOUBLE) AS quantity,
        upper(c.pop_strata) AS pop_strata, upper(m.product_group_1_description) AS product_category,
        upper(m.product_group_2_description) AS product_sub_category,
        upper(m.product_group_3_description) AS product_name, m.product_group_5_description AS pack_size,
        f.material_division AS product_division_code, f.mis_type,
        CAST(CASE WHEN f.mis_type = 'CN' THEN -1 * f.net_value ELSE f.net_value END AS DOUBLE) AS sales,
        f.sales_group_code, upper(mm.brand) AS brand, c.sale_group_name AS sales_group,
        upper(c.region) AS sh_5_name, c.region_code AS sh_5_code, upper(k.vertical) AS vertical,
        mm.material_code, mm.parent_division_code, mm.parent_division_name, mm.material_code_sg_key,
        upper(c.cluster) AS sh_3_name, c.cluster_code AS sh_3_code, c.branch AS sh_4_name,
        c.branch_code AS sh_4_code, upper(c.zone) AS sh_6_name, c.zone_code AS sh_6_code,
        upper(g.vertical) AS sales_group_name, upper(c.state) AS wss_state, c.term_of_payment,
        c.tsi_grouping, c.tsi_territory_code AS tsi_code, upper(trim(c.tsi_territory_name)) AS tsi_name,
        CAST(f.reporting_unit AS DOUBLE) AS volume, c.winomkar_wss_flag, c.wss_territory_code,
        upper(c.wss_territory_name) AS wss_territory_name, upper(c.town) AS wss_town
    FROM fact_invoice_details f
    LEFT JOIN dim_customer_master c ON c.customer_code = f.customer_code
    LEFT JOIN dim_sales_group g ON g.sales_group = f.sales_group_code
    LEFT JOIN dim_material m ON m.material_code = f.material_code
    LEFT JOIN dim_material_mapping mm ON mm.material_code = f.material_code
    LEFT JOIN dim_material_mapping k
        ON k.material_code_sg_key = f.material_code || CAST(f.sales_group_code AS STRING)
    WHERE f.active_flag = '1' AND f.mis_type IN ('CN', 'INV')
"""


def growth_sql(view: str) -> str:
    """The comparison as separate quarter totals joined on territory and cluster."""
    q = dataclasses.asdict(QUARTERS)
    totals = ",\n".join(
        f"""t_{name} AS (
            SELECT tsi_name, sh_3_name, CAST(sum(CAST(sales AS DECIMAL(18, 4))) AS DOUBLE) AS total
            FROM {view} WHERE invoice_date BETWEEN {first} AND {last} GROUP BY tsi_name, sh_3_name)"""
        for name, (first, last) in q.items()
    )
    return f"""{totals},
    rates AS (
        SELECT a.tsi_name AS tsi_territory_name, a.sh_3_name AS cluster,
            round((coalesce(a.total, 0) - coalesce(b.total, 0)) * 100.0 / nullif(b.total, 0), 2) AS now_rate,
            round((coalesce(c.total, 0) - coalesce(d.total, 0)) * 100.0 / nullif(d.total, 0), 2) AS before_rate
        FROM t_current a
        LEFT JOIN t_current_last_year b ON b.tsi_name = a.tsi_name AND b.sh_3_name = a.sh_3_name
        LEFT JOIN t_previous c ON c.tsi_name = a.tsi_name AND c.sh_3_name = a.sh_3_name
        LEFT JOIN t_previous_last_year d ON d.tsi_name = a.tsi_name AND d.sh_3_name = a.sh_3_name
        WHERE b.total IS NOT NULL AND d.total IS NOT NULL
    )
    SELECT tsi_territory_name, cluster,
        CAST(now_rate AS STRING) || '%' AS current_quarter_growth,
        CAST(before_rate AS STRING) || '%' AS previous_quarter_growth,
        round(before_rate - now_rate, 2) AS growth_decline
    FROM rates WHERE now_rate < before_rate ORDER BY growth_decline DESC
    """


def secondary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.secondary_sales(shapes(spark, sf_dir, STAR), CONFIG.secondary_cutoff, CONFIG.material_types)


def secondary_in_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    return sales.secondary_in_parts(shapes(spark, sf_dir, STAR), CONFIG.secondary_cutoff, CONFIG.material_types)


def primary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.primary_sales(shapes(spark, sf_dir, PRIMARY_STAR))


SECONDARY_CTE = f"{shape_cte(*STAR)}, secondary_view AS ({SECONDARY_SQL})"


@WORK.add("growth_decline", f"{SECONDARY_CTE}, {growth_sql('secondary_view')}")
def growth_decline(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = shapes(spark, sf_dir, STAR)
    return growth.growth_decline_of(tables, QUARTERS, CONFIG.secondary_cutoff, CONFIG.material_types)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals and nullable integers as double, which every client shows alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _doubles_sql(view: str, *columns: str) -> str:
    shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({shown}) FROM {view}"


@WORK.add(
    "secondary_sales", f"{SECONDARY_CTE} {_doubles_sql('secondary_view', 'product_division_code', 'wss_group_3')}"
)
def secondary_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(secondary_view(spark, sf_dir), "product_division_code", "wss_group_3")


@WORK.add(
    "primary_sales",
    f"{shape_cte(*PRIMARY_STAR)}, primary_view AS ({PRIMARY_SQL}) {_doubles_sql('primary_view', 'division')}",
)
def primary_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(primary_view(spark, sf_dir), "quantity", "sales", "volume", "division")


@WORK.add(
    "secondary_snapshot",
    f"""{SECONDARY_CTE}
    SELECT wss_territory_code, wss_town, count(*) AS line_count,
        CAST(sum(CAST(sales AS DECIMAL(18, 4))) AS DOUBLE) AS sales
    FROM secondary_view WHERE wss_territory_code IS NOT NULL GROUP BY wss_territory_code, wss_town""",
)
def secondary_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the view clustered by territory, then report from the stored copy."""
    target = Table(spark, scratch(spark, "secondary_sales_mat_view"))
    lines, shown = secondary_in_parts(spark, sf_dir)
    sales.refresh_snapshot(lines, target, shown=shown)
    stored = target.read().filter(F.col("wss_territory_code").isNotNull())
    return stored.groupBy("wss_territory_code", "wss_town").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("sales").cast("decimal(18,4)")).cast("double").alias("sales"),
    )


_DD_SELECT = """
    SELECT
        CAST(revised_net_value_mvg AS DOUBLE) AS revised_net_value_mvg, active_flag, sales_group_code,
        CAST(coalesce(division_code, 0) AS INT) AS division_code, customer_code, material_code AS item_code,
        customer_code AS dealer_code, coalesce(invoice_no, '') AS invoice_no, posting_date AS invoice_date,
        CAST(CASE WHEN mis_type = 'INV' THEN coalesce(billing_quantity_in_stock_keeping_unit, 0) ELSE 0 END
            AS DOUBLE) AS volume,
        CAST(volume_in_kg AS DOUBLE) AS volume_in_kg, CAST(volume_in_ltr AS DOUBLE) AS volume_in_ltr,
        CAST(CASE WHEN mis_type = 'CN' THEN net_value * -1 ELSE coalesce(net_value, 0) END AS DOUBLE)
            AS reporting_value,
        order_no,
        CAST(CASE WHEN mis_type = 'CN' THEN coalesce(billing_quantity_in_stock_keeping_unit, 0) * -1 ELSE 0 END
            AS DOUBLE) AS stock_required_quantity,
        customer_code_org AS customer_code_original, CAST(posting_date // 100 AS INT) AS year_month,
        20240131 AS created_date, mis_type, CAST(reporting_unit AS DOUBLE) AS reporting_unit,
        customer_code || '_' || CAST(sales_group_code AS STRING) AS dealer_sg_key,
        CAST(net_weight_in_kg AS DOUBLE) AS net_weight_in_kg, CAST(business_area_code AS STRING) AS tsi_code,
        CAST(rate AS DOUBLE) AS rate, 'DD' AS record_type,
        CAST(posting_date AS STRING) || '_' || customer_code || '_' || coalesce(invoice_no, 'NULL')
            AS fis_sg_id_cc_in
    FROM fact_invoice_details
"""

_DD_MEASURES = (
    "revised_net_value_mvg volume volume_in_kg volume_in_ltr reporting_value "
    "stock_required_quantity reporting_unit net_weight_in_kg rate"
).split()


def _dd(spark: SparkSession, sf_dir: str, config: PipelineConfig) -> DataFrame:
    out = derived.dd_records(shape(spark, sf_dir, "fact_invoice_details"), config, RUN_DATE)
    return as_double(out, *_DD_MEASURES)


@WORK.add(
    "dd_records",
    f"""{shape_cte("fact_invoice_details")} {_DD_SELECT}
    WHERE active_flag = '1' AND posting_date >= {CUTOFF}
      AND (mis_type IN ('CN', 'INV') OR (mis_type = 'FCN' AND reason_code IN ('RTDIF', 'SLPMT')))""",
)
def dd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dd(spark, sf_dir, CONFIG)


@WORK.add(
    "dd_records_other_customer",
    f"""{shape_cte("fact_invoice_details")} {_DD_SELECT}
    WHERE active_flag = '1' AND customer_code <> CAST(customer_code_org AS STRING)""",
)
def dd_records_other_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that selects rows by two differing columns."""
    details = shape(spark, sf_dir, "fact_invoice_details")
    config = dataclasses.replace(CONFIG, dd_differs=("customer_code", "_original"))
    details = details.withColumn("_original", F.col("customer_code_org").cast("string"))
    return as_double(derived.dd_records(details, config, RUN_DATE), *_DD_MEASURES)


def _constants_sql() -> str:
    parts = []
    for f in facets.FACETS:
        for view, name, columns in (
            ("secondary_view", facets.SECONDARY, sales.SECONDARY_COLUMNS),
            ("primary_view", facets.PRIMARY, sales.PRIMARY_COLUMNS),
        ):
            if f.column in columns and (not f.views or name in f.views):
                parts.append(
                    f"""SELECT {f.priority} AS priority, '{f.group_name}' AS group_name,
                    '{f.display_name}' AS display_name, CAST({f.column} AS STRING) AS value, wss_territory_code,
                    CAST(sales_group_code AS STRING) AS sales_group_code
                    FROM {view} WHERE sales > 10000 AND sales_group_name IS NOT NULL
                      AND sales_group_code IS NOT NULL AND {f.column} IS NOT NULL"""
                )
    rows = "\nUNION\n".join(parts)
    return f"""
    SELECT group_name, display_name, value AS display_value, value,
        lower(display_name || ' ' || value) AS search_text,
        string_agg(DISTINCT sales_group_code, ',' ORDER BY sales_group_code) AS sales_group_codes,
        coalesce(string_agg(DISTINCT wss_territory_code, ',' ORDER BY wss_territory_code)
            FILTER (wss_territory_code IS NOT NULL), '') AS territory_codes,
        priority
    FROM ({rows}) found GROUP BY priority, group_name, display_name, value
    """


_BOTH = tuple(dict.fromkeys(STAR + PRIMARY_STAR))


@WORK.add(
    "business_constants",
    f"""{shape_cte(*_BOTH)}, secondary_view AS ({SECONDARY_SQL}), primary_view AS ({PRIMARY_SQL})
    {_constants_sql()}""",
)
def business_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = {facets.SECONDARY: secondary_view(spark, sf_dir), facets.PRIMARY: primary_view(spark, sf_dir)}
    out = facets.business_constants(views, CONFIG.sales_threshold).drop("is_active")
    joined = {c: F.array_join(c, ",") for c in ("sales_group_codes", "territory_codes")}
    return out.withColumns(joined)


@WORK.add(
    "dealer_group",
    f"""{shape_cte("dim_dealer_master")},
    grouped AS (SELECT *, coalesce(dealer_group_code, dealer_code) AS grp FROM dim_dealer_master),
    heads AS (
        SELECT dealer_code, arg_max(dealer_name, dealer_sg_key) AS head_name
        FROM dim_dealer_master WHERE active_flag = 'True' GROUP BY dealer_code)
    SELECT g.dealer_code, g.dealer_name, g.grp AS dealer_group_code,
        CASE WHEN g.grp <> g.dealer_code AND h.dealer_code IS NOT NULL THEN h.head_name ELSE g.dealer_name END
            AS dealer_group_name
    FROM grouped g LEFT JOIN heads h ON h.dealer_code = g.grp""",
)
def dealer_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealers = shape(spark, sf_dir, "dim_dealer_master")
    out = dimensions.dealer_groups(dealers, "dealer_sg_key")
    return out.select("dealer_code", "dealer_name", "dealer_group_code", "dealer_group_name")


@WORK.add(
    "customer_normalise",
    f"""{shape_cte("dim_customer_master")}
    SELECT customer_code,
        regexp_replace(trim(upper(tsi_territory_name)), '\\s+', ' ', 'g') AS tsi_territory_name
    FROM dim_customer_master""",
)
def customer_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dimensions.customer_names(shape(spark, sf_dir, "dim_customer_master"))
    return out.select("customer_code", "tsi_territory_name")


@WORK.add(
    "latest_record",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) ranked
    WHERE rn = 1""",
)
def latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order of every customer."""
    from ..samples import source

    orders = source(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return latest_per_key(orders, ["o_custkey"], "o_orderkey")
