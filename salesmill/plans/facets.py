"""Filter facets: the values users can pick, with the groups and territories selling them."""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import union_all
from ..operators.load import new_only
from ..operators.records import unpivot

SECONDARY, PRIMARY = "secondary_sales_view", "primary_sales_view"


@dataclasses.dataclass(frozen=True)
class Facet:
    """``views`` names where the values come from; both views when empty."""

    priority: int
    group_name: str
    display_name: str
    views: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        """ProductName -> product_name, SH5Name -> sh_5_name, WSSGroup1 -> wss_group_1."""
        words = re.findall(r"[A-Z]{2,}(?=[A-Z][a-z]|\d|$)|[A-Z][a-z]+|\d+", self.group_name)
        return "_".join(words).lower()


_S, _P, _BOTH = (SECONDARY,), (PRIMARY,), ()

# Facets in order of priority.
FACETS = tuple(
    Facet(i, *row)
    for i, row in enumerate(
        [
            ("ProductName", "Product Name", _S),
            ("SH5Name", "Zone Name", _S),
            ("SH3Name", "Cluster Name", _S),
            ("TSIName", "TSI Territory Name", _S),
            ("SalesGroupName", "Sales Group Name", _S),
            ("DealerType1", "Dealer Type 1", _S),
            ("DealerType7", "Dealer Type 7  –  PCC Dealer", _S),
            ("DealerType6", "Dealer Type 6", _S),
            ("DealerType4", "Dealer Type 4", _S),
            ("DealerType12", "Dealer Type 12 - Periphery", _S),
            ("ProductCategory", "Product Category", _S),
            ("ProductSubCategory", "Product Sub Category", _S),
            ("DealerCity", "Dealer City", _S),
            ("DealerDistrict", "Dealer District", _S),
            ("WSSTown", "Customer Town", _S),
            ("Division", "Division Name", _S),
            ("Vertical", "Sales Vertical", _S),
            ("WSSGroup", "Customer Group", _P),
            ("WSSGroup1", "Customer Group 1", _P),
            ("WSSGroup3", "Customer Group 3", _P),
            ("WSSGroup3Status", "Customer Group 3 Status", _P),
            ("WSSBlock", "Customer Block Status ", _P),
            ("PopStrata", "Pop Strata", _P),
            ("DealerState", "Dealer State", _S),
            ("WSSName", "Customer Name", _P),
            ("WSSTown", "WSS Town", _BOTH),
            ("WSSDistrict", "WSS District", _BOTH),
            ("WSSState", "WSS State", _BOTH),
            ("Brand", "Brand", _S),
        ],
        start=1,
    )
)

CONFLICT_KEY = ("group_name", "display_name", "value")


def _facet_values(view: DataFrame, facets: Sequence[Facet], threshold: float) -> DataFrame:
    """Distinct (facet, value, group, territory) of one view, all facets in one scan.

    Facets are told apart only after the values are distinct: two that show the
    same column cost no more than one.
    """
    shown = [f for f in facets if f.column in view.columns]
    columns = list(dict.fromkeys(f.column for f in shown))
    priorities = F.create_map(
        *[x for c in columns for x in (F.lit(c), F.array(*[F.lit(f.priority) for f in shown if f.column == c]))]
    )
    rows = view.filter(
        (F.col("sales") > threshold)
        & F.col("sales_group_name").isNotNull()
        & F.col("sales_group_code").isNotNull()
    ).select(
        F.col("sales_group_code").cast("string").alias("_group"),
        F.col("wss_territory_code").alias("_territory"),
        *columns,
    )
    values = unpivot(rows, ["_group", "_territory"], columns, "_column", "value").distinct()
    return values.select(F.explode(priorities[F.col("_column")]).alias("priority"), "value", "_group", "_territory")


def business_constants(
    views: Mapping[str, DataFrame], threshold: float = 10000.0, facets: Sequence[Facet] = FACETS
) -> DataFrame:
    """One row per facet value.

    Rows are made distinct before they are grouped, so the arrays collect each
    group and territory once and a frequent value costs no more than a rare one.
    """
    parts = []
    for name, view in views.items():
        mine = [f for f in facets if not f.views or name in f.views]
        parts.append(_facet_values(view, mine, threshold))
    grouped = union_all(parts).groupBy("priority", "value").agg(
        F.array_sort(F.collect_set("_group")).alias("sales_group_codes"),
        F.array_sort(F.collect_set("_territory")).alias("territory_codes"),
    )
    labels = F.create_map(*[x for f in facets for x in (F.lit(f.priority), F.lit(f.display_name))])
    groups = F.create_map(*[x for f in facets for x in (F.lit(f.priority), F.lit(f.group_name))])
    return grouped.select(
        groups[F.col("priority")].alias("group_name"),
        labels[F.col("priority")].alias("display_name"),
        F.col("value").alias("display_value"),
        "value",
        F.lower(F.concat(labels[F.col("priority")], F.lit(" "), F.col("value"))).alias("search_text"),
        "sales_group_codes",
        "territory_codes",
        "priority",
        F.lit(True).alias("is_active"),
    )


def new_constants(existing: DataFrame, constants: DataFrame, keys: Sequence[str] = CONFLICT_KEY) -> DataFrame:
    """Constants the store does not hold yet."""
    return new_only(existing, constants, keys)
