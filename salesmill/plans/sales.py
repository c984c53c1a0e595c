"""Sales views over the star schema.

The dimension side is prepared first: each dimension is reduced to the columns
the view shows, already formatted, and dimensions that hang on other dimensions
are joined to them before the fact table is touched. The fact table then needs
one join per own key, sides that show little before those that show much, since
each shuffle carries what was attached before it. The planner decides from file sizes whether a dimension is
broadcast; the joined dealer side, whose size it cannot know, is measured. Hot
keys in shuffled joins are split by AQE.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import access
from ..operators.load import Table
from ..operators.records import concat_key, latest_per_key
from ..session import broadcast_if_small, is_small

Tables = Mapping[str, DataFrame]

# View columns in their order.
SECONDARY_COLUMNS = """
    wss_code wss_group_3 wss_name dealer_city dealer_class dealer_district dealer_code dealer_group_code
    dealer_name dealer_route_name dealer_state dealer_tsi_type dealer_type_1 dealer_type_2 dealer_type_3
    dealer_type_4 dealer_type_5 dealer_type_6 dealer_type_7 dealer_type_12 division final_classification
    brand vertical invoice_date invoice_no parent_division_name pop_strata product_description
    product_division_code sub_division product_category product_sub_category product_name pack_size
    quantity record_type sales uvg sales_group sales_group_code sales_group_name sh_3_code sh_3_name
    sh_4_code sh_4_name sh_5_code sh_5_name sh_6_code sh_6_name tsi_code tsi_name tsr_name volume
    wss_territory_code wss_territory_name wss_town dealer_sg_key ssdm_tsr_code ssdm_tsr_name
""".split()

PRIMARY_COLUMNS = """
    wss_code wss_group wss_group_1 wss_group_3 wss_group_3_status wss_name wss_block wss_district
    payment_method_name credit_limit customer_creation_date population division final_classification
    grand_parent_wss_code invoice_no invoice_type invoice_date parent_wss_code quantity pop_strata
    product_category product_sub_category product_name pack_size product_division_code mis_type sales
    sales_group_code brand sales_group sh_5_name sh_5_code vertical material_code parent_division_code
    parent_division_name material_code_sg_key sh_3_name sh_3_code sh_4_name sh_4_code sh_6_name sh_6_code
    sales_group_name wss_state term_of_payment tsi_grouping tsi_code tsi_name volume winomkar_wss_flag
    wss_territory_code wss_territory_name wss_town
""".split()


def _shown(form: str, columns: Sequence[str], renamed: Mapping[str, str]) -> list[str]:
    pairs = [(c, c) for c in columns] + [(c, out) for out, c in renamed.items()]
    return [f"{form.format(c)} AS {out}" for c, out in pairs]


def _plain(*columns: str, **renamed: str) -> list[str]:
    return _shown("{}", columns, renamed)


def _text(**renamed: str) -> list[str]:
    return _shown("CAST({} AS STRING)", (), renamed)


def _upper(*columns: str, **renamed: str) -> list[str]:
    return _shown("upper(CAST({} AS STRING))", columns, renamed)


def _upper_trim(**renamed: str) -> list[str]:
    return _shown("upper(trim({}))", (), renamed)


def _is(df: DataFrame, column: str, value: str) -> Column:
    """Equality with the literal in the column's own type, so the scan can use it."""
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def _attach(df: DataFrame, side: DataFrame, key: Column | str) -> DataFrame:
    """Left join on the side's ``_key``; an unmatched or NULL key leaves NULLs."""
    key = F.col(key) if isinstance(key, str) else key
    return df.join(side, key == F.col("_key"), "left").drop("_key")


def _sales_groups(t: Tables, *shown: str) -> DataFrame:
    return t["dim_sales_group"].selectExpr(*_plain(_key="sales_group"), *shown)


def _categories() -> list[str]:
    return _upper(
        product_category="product_group_1_description",
        product_sub_category="product_group_2_description",
        product_name="product_group_3_description",
    ) + _plain(pack_size="product_group_5_description")


def _classification(t: Tables) -> DataFrame:
    """Mapping rows keyed by material and sales group together."""
    return t["dim_material_mapping"].selectExpr(
        *_plain("final_classification", _key="material_code_sg_key"), *_upper("vertical")
    )


def latest_hierarchy(hierarchy: DataFrame) -> DataFrame:
    """The newest record per territory code."""
    return latest_per_key(hierarchy.select("sh_2_code", "sh_2_name", "primary_key"), ["sh_2_code"], "primary_key")


def _dealers(t: Tables) -> DataFrame:
    side, small = _sized_dealers(t)
    return F.broadcast(side) if small else side


def _sized_dealers(t: Tables) -> tuple[DataFrame, bool]:
    """Active dealers with their customer and the latest hierarchy record, and whether these can be broadcast."""
    dealers = t["dim_dealer_master"]
    dealers = dealers.filter(_is(dealers, "active_flag", "True")).selectExpr(
        *_text(_dealer="dealer_sg_key", _customer="customer_code"),
        *_upper("dealer_city", "dealer_district", "dealer_route_name", "dealer_state"),
        *_upper("dealer_type_1", "dealer_type_4", "dealer_type_6", "dealer_type_7", "dealer_type_12"),
        *_plain("dealer_class", "dealer_code", "dealer_group_code", "dealer_name"),
        *_plain("dealer_type_2", "dealer_type_3", "dealer_type_5", dealer_tsi_type="tsi_type"),
        *_plain(tsi_code="tsi_territory_code", ssdm_tsr_code="tsi_code", ssdm_tsr_name="tsi_name"),
    )
    customers = t["dim_customer_master"].selectExpr(
        *_text(_key="customer_code"),
        *_plain(wss_code="customer_code", wss_group_3="customer_group_3", sh_3_code="cluster_code"),
        *_plain("wss_territory_code", sh_4_code="branch_code", sh_4_name="branch"),
        *_plain(sh_5_code="cm_region_code", sh_6_code="zone_code"),
        *_upper("pop_strata", "wss_territory_name", wss_name="customer_name", wss_town="town"),
        *_upper(sh_3_name="cluster", sh_5_name="region", sh_6_name="zone"),
        *_upper_trim(tsi_name="tsi_territory_name"),
    )
    latest = latest_hierarchy(t["dim_hierarchy"]).selectExpr(
        *_plain(_key="sh_2_code"), *_upper_trim(tsr_name="sh_2_name")
    )
    known = _attach(_attach(dealers, customers, "_customer"), latest, "tsi_code")
    side = known.drop("_customer").withColumnRenamed("_dealer", "_key")
    return side, is_small(side, driving=dealers)


def _fact(t: Tables, cutoff: int) -> DataFrame:
    """Active lines of dealer sales from a day on."""
    fact = t["fact_invoice_secondary"]
    return fact.filter(_is(fact, "active_flag", "1") & (F.col("invoice_date") >= cutoff)).selectExpr(
        *_plain("invoice_date", "invoice_no", "record_type", "sales_group_code", "dealer_sg_key"),
        *_plain(quantity="reporting_unit_in_each", sales="reporting_value", uvg="revised_net_value_mvg"),
        *_plain(volume="reporting_unit", _item="item_code"),
    )


def _product_sides(t: Tables, material_types: Sequence[str]) -> list[tuple[DataFrame, Column]]:
    """Classification, materials, mapping and sales groups, each with the key of a fact row; the narrowest that shuffles is first."""
    groups = _sales_groups(
        t,
        *_upper("division", sales_group_name="vertical"),
        *_plain(sub_division="vertical", sales_group="vertical"),
    )
    materials = t["dim_material"]
    materials = materials.filter(
        _is(materials, "active_flag", "True") & F.col("material_type").isin(*material_types)
    ).selectExpr(
        *_plain(_key="material_code", product_description="material_description", product_division_code="sales_group_code"),
        *_categories(),
    )
    mapping = t["dim_material_mapping"].selectExpr(
        *_plain("parent_division_name", _key="material_code"), *_upper("brand")
    )
    item = F.col("_item")
    both = concat_key("_item", "sales_group_code")
    return [(_classification(t), both), (materials, item), (mapping, item), (groups, F.col("sales_group_code"))]


def secondary_sales(
    t: Tables, cutoff: int = 20230401, material_types: Sequence[str] = ("ZFGD",)
) -> DataFrame:
    """Dealer sales with product, customer and hierarchy attributes; one row per match.

    The territories of dealers come first: they are what filters of a user's
    territories reach, and what these leave out need not meet the other tables.
    All else that dealers show is wide and comes last, by dealer and territory,
    so that each fact row meets the same dealer rows as in one join.
    """
    lines, shown, _ = _secondary(t, cutoff, material_types)
    return shown(lines)


def secondary_in_parts(
    t: Tables, cutoff: int = 20230401, material_types: Sequence[str] = ("ZFGD",)
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The same view as narrow lines and what makes the view of them, for ``refresh_snapshot``.

    Dealers that cannot be broadcast would be joined by a shuffle of their own;
    then the lines are the view already.
    """
    lines, shown, small = _secondary(t, cutoff, material_types)
    return (lines, shown) if small else (shown(lines), lambda view: view)


def _secondary(t: Tables, cutoff: int, material_types: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], bool]:
    side, small = _sized_dealers(t)
    dealers = F.broadcast(side) if small else side
    territories = broadcast_if_small(dealers.select("_key", "wss_territory_code").distinct())
    dealer = F.col("dealer_sg_key").cast("string")
    out = _attach(_fact(t, cutoff), territories, dealer)
    for product, key in _product_sides(t, material_types):
        out = _attach(out, product, key)
    rest = dealers.withColumnRenamed("wss_territory_code", "_territory")
    same = (dealer == F.col("_key")) & F.col("wss_territory_code").eqNullSafe(F.col("_territory"))
    return out, lambda lines: lines.join(rest, same, "left").select(*SECONDARY_COLUMNS), small


def dealer_totals(
    t: Tables,
    by: Sequence[str],
    totals: Mapping[str, Column],
    wanted: Column,
    cutoff: int = 20230401,
    material_types: Sequence[str] = ("ZFGD",),
    allowed: Callable[[DataFrame], DataFrame] = lambda side: side,
) -> DataFrame:
    """Sums over the secondary view by columns of its dealers, without building the view.

    The fact is summed by its keys before anything is joined. Of the product
    tables the view shows nothing here, so each gives only the number of its
    rows for a key, by which a fact row would be repeated. ``totals`` are exact
    aggregates of fact columns, ``wanted`` a condition on these, ``allowed``
    limits the dealers (by territory, say). Rows without a dealer are left out.
    """
    keys = ["_item", "sales_group_code", "dealer_sg_key"]
    summed = _fact(t, cutoff).filter(wanted).groupBy(*keys).agg(*[v.alias(f"_t_{n}") for n, v in totals.items()])
    side = allowed(_dealers(t)).select(F.col("_key"), *by)
    out = summed.join(side, F.col("dealer_sg_key").cast("string") == F.col("_key")).drop("_key")
    out = out.withColumn("_copies", F.lit(1).cast("decimal(12,0)"))
    for product, key in _product_sides(t, material_types):
        repeated = product.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        out = _attach(out, repeated, key).withColumn("_copies", (F.col("_copies") * F.coalesce("_n", F.lit(1)).cast("decimal(12,0)")).cast("decimal(12,0)")).drop("_n")
    return out.groupBy(*by).agg(*[F.sum(F.col(f"_t_{n}") * F.col("_copies")).alias(n) for n in totals])


def primary_sales(t: Tables) -> DataFrame:
    """Company sales to customers; credit notes count negative."""
    fact = t["fact_invoice_details"]
    fact = fact.filter(_is(fact, "active_flag", "1") & F.col("mis_type").isin("CN", "INV")).selectExpr(
        *_plain("invoice_no", "invoice_type", "mis_type", "sales_group_code"),
        *_plain(wss_code="customer_code", division="division_code", invoice_date="posting_date"),
        *_plain(quantity="billing_quantity_in_stock_keeping_unit", product_division_code="material_division"),
        *_plain(volume="reporting_unit", _item="material_code"),
        "CASE WHEN mis_type = 'CN' THEN -net_value ELSE net_value END AS sales",
    )
    customers = t["dim_customer_master"].selectExpr(
        *_plain(_key="customer_code"),
        *_upper(wss_group="customer_group", wss_group_1="customer_group_1", wss_group_3="customer_group_3"),
        *_upper(wss_group_3_status="customer_group_3_status", wss_name="customer_name"),
        *_upper(wss_block="customer_block", wss_district="district", wss_state="state", wss_town="town"),
        *_upper("pop_strata", "wss_territory_name"),
        *_upper(sh_3_name="cluster", sh_5_name="region", sh_6_name="zone"),
        *_plain("payment_method_name", "credit_limit", "customer_creation_date", "population"),
        *_plain("term_of_payment", "tsi_grouping", "winomkar_wss_flag", "wss_territory_code"),
        *_plain(parent_wss_code="parent_customer_code", grand_parent_wss_code="grand_parent_customer_code"),
        *_plain(sales_group="sale_group_name", sh_3_code="cluster_code", sh_4_code="branch_code"),
        *_plain(sh_4_name="branch", sh_5_code="region_code", sh_6_code="zone_code"),
        *_plain(tsi_code="tsi_territory_code"),
        *_upper_trim(tsi_name="tsi_territory_name"),
    )
    materials = t["dim_material"].selectExpr(*_plain(_key="material_code"), *_categories())
    mapping = t["dim_material_mapping"].selectExpr(
        *_upper("brand"),
        *_plain("material_code", _key="material_code"),
        *_plain("parent_division_code", "parent_division_name", "material_code_sg_key"),
    )
    out = _attach(fact, _classification(t), concat_key("_item", "sales_group_code"))
    out = _attach(out, materials, "_item")
    out = _attach(out, mapping, "_item")
    out = _attach(out, customers, "wss_code")
    out = _attach(out, _sales_groups(t, *_upper(sales_group_name="vertical")), "sales_group_code")
    return out.select(*PRIMARY_COLUMNS)


def refresh_snapshot(
    view: DataFrame,
    target: Table,
    cluster_by: str = "wss_territory_code",
    shown: Callable[[DataFrame], DataFrame] = lambda view: view,
) -> int:
    """Store a view's result in parts by the column users are filtered on, so that a user's query reads few of them.

    Parts are numbers hashed from the column, ``access.PARTS`` whatever the
    number of territories; one that holds much of the data has several files.
    The order inside files lets a territory filter skip row groups. ``shown``
    adds what is wide (see ``secondary_in_parts``) behind the shuffle to the parts.
    """
    parted = lambda rows: rows.withColumn(access.PART, access.part_of(cluster_by))
    ordered = parted(view).sortWithinPartitions(access.PART, cluster_by)
    return target.replace(ordered, (access.PART,), lambda rows: parted(shown(rows.drop(access.PART))))
