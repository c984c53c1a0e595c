"""Derived (DD) records: company invoices restated as dealer sales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.dates import as_int, year_month
from ..functions.text import joined_key
from ..operators import filters
from ..operators.align import conform
from ..operators.load import Table, dd_slice
from ..operators.records import concat_key
from ..tables import SPECS


def qualifying(details: DataFrame, config: PipelineConfig) -> DataFrame:
    """Invoice details that count as dealer sales.

    A tenant that sets ``dd_differs`` keeps rows whose two columns differ
    instead of selecting by document type.
    """
    rows = details.filter(F.col("active_flag") == "1")
    if config.dd_differs is not None:
        return rows.filter(filters.differ(*config.dd_differs))
    return rows.filter(
        filters.any_of(config.dd_types, config.dd_reason_types, config.dd_reasons)
        & (F.col("posting_date") >= config.secondary_cutoff)
    )


def restated(rows: DataFrame, run_date: dt.date) -> DataFrame:
    """Invoice details in the layout of dealer sales."""
    billed = F.coalesce(F.col("billing_quantity_in_stock_keeping_unit"), F.lit(0))
    is_invoice, is_credit = F.col("mis_type") == "INV", F.col("mis_type") == "CN"
    return rows.select(
        "revised_net_value_mvg",
        "active_flag",
        "sales_group_code",
        F.coalesce("division_code", F.lit(0)).alias("division_code"),
        "customer_code",
        F.col("material_code").alias("item_code"),
        F.col("customer_code").alias("dealer_code"),
        F.coalesce("invoice_no", F.lit("")).alias("invoice_no"),
        F.col("posting_date").alias("invoice_date"),
        F.when(is_invoice, billed).otherwise(0).alias("volume"),
        "volume_in_kg",
        "volume_in_ltr",
        # A credit note without a value stays without one; other gaps count as zero.
        F.when(is_credit, -F.col("net_value")).otherwise(F.coalesce("net_value", F.lit(0))).alias("reporting_value"),
        "order_no",
        F.when(is_credit, -billed).otherwise(0).alias("stock_required_quantity"),
        F.col("customer_code_org").alias("customer_code_original"),
        year_month("posting_date").alias("year_month"),
        F.lit(as_int(run_date)).alias("created_date"),
        "mis_type",
        "reporting_unit",
        F.concat("customer_code", F.lit("_"), concat_key("sales_group_code")).alias("dealer_sg_key"),
        "net_weight_in_kg",
        F.col("business_area_code").cast("string").alias("tsi_code"),
        "rate",
        F.lit("DD").alias("record_type"),
        F.when(
            F.col("posting_date").isNotNull() & F.col("customer_code").isNotNull(),
            joined_key(["posting_date", "customer_code", "invoice_no"]),
        ).alias("fis_sg_id_cc_in"),
    )


def dd_records(details: DataFrame, config: PipelineConfig, run_date: dt.date) -> DataFrame:
    """Qualifying invoice details in the layout of dealer sales."""
    return restated(qualifying(details, config), run_date)


def dd_rows(details: DataFrame, config: PipelineConfig, run_date: dt.date) -> DataFrame:
    """The same, widened to every column of the target table."""
    return conform(dd_records(details, config, run_date), SPECS["fact_invoice_secondary"].schema)


def refresh_dd(details: DataFrame, target: Table, config: PipelineConfig, run_date: dt.date) -> int:
    """Exchange the derived records of the dealer-sales table; on the way to their partitions they are still invoice details."""
    schema = SPECS["fact_invoice_secondary"].schema
    return target.replace_slice(qualifying(details, config), dd_slice(), lambda rows: conform(restated(rows, run_date), schema))
