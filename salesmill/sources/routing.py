"""From file names to tables and sales groups."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.names import snake_case
from ..functions.text import col

# File-name prefix of each table's drops.
FILE_PREFIXES = {
    "DimCustomerMaster": "dim_customer_master",
    "DimDealerMaster": "dim_dealer_master",
    "DimHierarchy": "dim_hierarchy",
    "DimMaterial": "dim_material",
    "DimMaterialMapping": "dim_material_mapping",
    "DimSalesGroup": "dim_sales_group",
    "FactInvoiceDetails": "fact_invoice_details",
    "FactInvoiceSecondary": "fact_invoice_secondary",
    "RlsMaster": "rls_master",
}

# Drop folders named differently from their table.
FOLDER_ALIASES = {"dimdealer_ms": "DimDealerMaster", "dimdealer": "DimDealerMaster"}

# Groups delivered together with groups 107 and 112.
COMBINED_GROUPS = ("107", "112")
GROUPS_WITH_COMBINED = (
    "101 203 204 202 205 302 303 304 408 409 402 403 407 451 452 453 454 455 456 457 "
    "501 502 503 504 505 506 508 509 601 602 604 956 957 961 949 951 958 959 960"
).split()


def table_for_stem(stem: str, prefixes: Mapping[str, str] = FILE_PREFIXES) -> str:
    """Table of a file: the longest matching prefix, else the name in snake case."""
    for prefix in sorted(prefixes, key=len, reverse=True):
        if stem.startswith(prefix):
            return prefixes[prefix]
    return snake_case(stem)


def table_column(stem: str | Column, prefixes: Mapping[str, str] = FILE_PREFIXES) -> Column:
    """The same per row, for frames holding file stems; NULL when nothing matches."""
    choices = [
        F.when(col(stem).startswith(p), F.lit(prefixes[p])) for p in sorted(prefixes, key=len, reverse=True)
    ]
    return F.coalesce(*choices)


def entity_for_drop(file_name: str, aliases: Mapping[str, str] = FOLDER_ALIASES) -> str:
    """Entity of a drop such as ``DimDealer_MS_9999_2025_12_02_14:01:37.parquet``.

    The name ends before the first 4- or 5-digit part; known folder names map to
    their entity, others become PascalCase.
    """
    stem = re.sub(r"\.parquet$", "", file_name, flags=re.I)
    parts = stem.split("_")
    cut = next((i for i, p in enumerate(parts) if re.fullmatch(r"\d{4,5}", p)), len(parts))
    kept = parts[: max(cut, 1)]
    alias = aliases.get("_".join(kept).lower())
    if alias:
        return alias
    if len(kept) > 1:
        return "".join(p.capitalize() for p in kept)
    return kept[0][:1].upper() + kept[0][1:]


def entity_column(file_name: str | Column, aliases: Mapping[str, str] = FOLDER_ALIASES) -> Column:
    """The same per row."""
    stem = F.regexp_replace(col(file_name), r"(?i)\.parquet$", "")
    parts = F.split(stem, "_")
    number = F.array_position(F.transform(parts, lambda p: p.rlike(r"^[0-9]{4,5}$")), True)
    kept = F.slice(parts, 1, F.greatest(F.when(number > 0, number - 1).otherwise(F.size(parts)), F.lit(1)).cast("int"))
    known = F.coalesce(*[F.when(F.lower(F.array_join(kept, "_")) == a, F.lit(e)) for a, e in aliases.items()], F.lit(None))
    first = F.upper(F.substring(kept[0], 1, 1))
    pascal = F.array_join(F.transform(kept, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(p.substr(F.lit(2), F.length(p))))), "")
    return F.coalesce(known, F.when(F.size(kept) > 1, pascal).otherwise(F.concat(first, kept[0].substr(F.lit(2), F.length(kept[0])))))


def sales_groups(stem: str) -> list[str]:
    """Sales groups named in a fact file, with the groups delivered along with them."""
    named = [p for p in stem.split("_")[1:] if p != "DD"]
    if stem.startswith("FactInvoiceDetails") and all(g in named for g in COMBINED_GROUPS):
        named += [g for g in GROUPS_WITH_COMBINED if g not in named]
    return named


def is_dd_drop(stem: str) -> bool:
    return "DD" in stem.split("_")[1:]


def sales_groups_column(stem: str | Column) -> Column:
    """The same per row."""
    parts = F.split(col(stem), "_")
    named = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p != "DD")
    along = F.array(*[F.lit(g) for g in GROUPS_WITH_COMBINED])
    both = reduce(lambda x, y: x & y, [F.array_contains(named, g) for g in COMBINED_GROUPS])
    details = col(stem).startswith("FactInvoiceDetails")
    return F.when(details & both, F.concat(named, F.array_except(along, named))).otherwise(named)


def output_stem(stem: str) -> str:
    """Name of the converted file: facts keep one or two group codes, others lose every suffix."""
    fact = re.match(r"(FactInvoice(?:Details|Secondary)(?:_\d+){1,2})_", stem)
    name = fact.group(1) if fact else stem.split("_")[0]
    return FOLDER_ALIASES.get(name.lower(), name)
