"""Dimension-specific transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TableSpec
from ..functions.text import collapse_spaces
from ..operators.align import Alignment, align
from ..operators.convert import lenient_types
from ..operators.records import last_value_map


def dealer_groups(dealers: DataFrame, order: str) -> DataFrame:
    """Group code and name of every dealer.

    A dealer without a group is its own group. The name is that of the active
    dealer the group code points to (the last one by ``order``), else the
    dealer's own.
    """
    active = dealers.filter((F.col("active_flag") == "True") & F.col("dealer_code").isNotNull())
    heads = last_value_map(active, "dealer_code", "dealer_name", order, "_head_name").select(
        F.col("dealer_code").alias("_head"), "_head_name"
    )
    grouped = dealers.withColumn("dealer_group_code", F.coalesce("dealer_group_code", "dealer_code"))
    joined = grouped.join(heads, grouped["dealer_group_code"] == F.col("_head"), "left")
    foreign = ~F.col("dealer_group_code").eqNullSafe(F.col("dealer_code")) & F.col("_head").isNotNull()
    name = F.when(foreign, F.col("_head_name")).otherwise(F.col("dealer_name"))
    return joined.withColumn("dealer_group_name", name).drop("_head", "_head_name")


def customer_names(customers: DataFrame) -> DataFrame:
    """Territory names in one spelling: upper case, single spaces."""
    if "tsi_territory_name" not in customers.columns:
        return customers
    return customers.withColumn("tsi_territory_name", collapse_spaces("tsi_territory_name"))


def _kinds(spec: TableSpec) -> dict[str, str]:
    families = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "float", "double": "float"}
    return {f.name: families.get(f.dataType.simpleString(), "string") for f in spec.schema.fields}


def transform_dimension(df: DataFrame, spec: TableSpec, order: str | None = None) -> tuple[DataFrame, Alignment]:
    """Align to the declared columns, cast leniently, then the table's own rules.

    None of the steps adds or removes rows.
    """
    fitted = align(df, spec.schema)
    out = lenient_types(fitted.frame, _kinds(spec))
    if spec.name == "dim_dealer_master":
        out = dealer_groups(out, order or "dealer_sg_key")
    if spec.name == "dim_customer_master":
        out = customer_names(out)
    return out, fitted
