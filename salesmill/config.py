"""Tenant settings and table declarations: plain values handed to the Spark jobs."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from .functions.ddl import struct_from_ddl
from .functions.names import lookup_key, squash


@dataclasses.dataclass(frozen=True)
class TableSpec:
    """A target table: declared columns, key, and how feeds name its columns."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    overrides: Mapping[str, str] = dataclasses.field(default_factory=dict)
    computed: Mapping[str, Mapping[str, Any]] = dataclasses.field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    order: int = 0

    @classmethod
    def from_ddl(cls, name: str, ddl: str, **kw: Any) -> TableSpec:
        return cls(name, struct_from_ddl(ddl), **kw)

    @property
    def types(self) -> dict[str, str]:
        return {f.name: f.metadata["ddl"] for f in self.schema.fields}

    @property
    def mapping(self) -> dict[str, str]:
        """Feeds carry the column name without underscores unless told otherwise."""
        return {squash(f.name): f.name for f in self.schema.fields} | dict(self.overrides)

    @property
    def keyed_mapping(self) -> dict[str, str]:
        return {lookup_key(k): v for k, v in self.mapping.items()}


@dataclasses.dataclass(frozen=True)
class PipelineConfig:
    """Everything a tenant can set. Dates are 8-digit integers."""

    tenant: str = "default"
    base_path: str = ""
    priority: int = 999
    enabled: bool = True
    secondary_cutoff: int = 20230401
    detail_cutoff: int = 20230331
    sales_threshold: float = 10000.0
    material_types: tuple[str, ...] = ("ZFGD",)
    fiscal_start_month: int = 4
    max_error_ratio: float = 0.0
    max_conversion_failures: float = 0.1
    # Columns of a drop that its table lacks: "refuse" the drop, "report" and leave them out, or "add" them to the table.
    extra_columns: str = "refuse"
    run_date: dt.date | None = None
    dd_types: tuple[str, ...] = ("CN", "INV")
    dd_reason_types: tuple[str, ...] = ("FCN",)
    dd_reasons: tuple[str, ...] = ("RTDIF", "SLPMT")
    dd_differs: tuple[str, str] | None = None
    lookup_options: Mapping[str, str] = dataclasses.field(default_factory=dict)

    def path(self, *parts: str) -> str:
        """Location inside the tenant's own directory."""
        return "/".join([self.base_path.rstrip("/"), self.tenant, *parts])

    @classmethod
    def from_settings(cls, shared: Mapping, tenant: Mapping) -> PipelineConfig:
        """Tenant settings laid over the shared defaults; unknown settings are ignored."""
        merged = deep_merge(shared, tenant)
        rules = merged.get("business_rules", {})
        known = {f.name for f in dataclasses.fields(cls)}
        values = {k: v for k, v in merged.items() if k in known}
        for src, dst, make in (
            ("date_filter_start", "secondary_cutoff", int),
            ("sales_threshold", "sales_threshold", float),
            ("material_type_filter", "material_types", tuple),
        ):
            if src in rules:
                values[dst] = make(rules[src])
        if "start_month" in rules.get("fiscal_year", {}):
            values["fiscal_start_month"] = int(rules["fiscal_year"]["start_month"])
        if "tenant_slug" in merged:
            values["tenant"] = merged["tenant_slug"]
        if "schedule_priority" in merged:
            values["priority"] = int(merged["schedule_priority"])
        return cls(**values)


def deep_merge(base: Mapping, over: Mapping) -> dict:
    """Settings of ``over`` win; nested mappings are merged, lists are replaced."""
    out = dict(base)
    for key, value in over.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = deep_merge(out[key], value) if both else value
    return out


def run_order(tenants: Iterable[PipelineConfig]) -> list[PipelineConfig]:
    """Enabled tenants, lowest priority number first."""
    return sorted((t for t in tenants if t.enabled), key=lambda t: (t.priority, t.tenant))


def read_yaml(path: str | Path) -> dict:
    try:
        import yaml
    except ImportError as err:
        raise RuntimeError("reading YAML settings needs PyYAML") from err
    with open(path, encoding="utf-8") as fh:
        return yaml.safe_load(fh) or {}


def load_table_specs(tenant_dir: str | Path) -> dict[str, TableSpec]:
    """Table specs from a tenant directory.

    ``schemas/tables/*.yaml`` holds ``name``, ``order`` and ``sql``;
    ``column_mappings/*.yaml`` holds ``table_name`` and ``columns``;
    ``computed_columns.yaml`` holds the derived columns per table.
    """
    from .functions.names import mapping_pairs

    root = Path(tenant_dir)
    mappings = {}
    for f in sorted((root / "column_mappings").glob("*.yaml")):
        m = read_yaml(f)
        mappings[m["table_name"]] = mapping_pairs(m)
    computed_file = root / "computed_columns.yaml"
    computed = read_yaml(computed_file) if computed_file.exists() else {}
    specs = {}
    for f in sorted((root / "schemas" / "tables").glob("*.yaml")):
        t = read_yaml(f)
        specs[t["name"]] = TableSpec.from_ddl(
            t["name"],
            t["sql"],
            overrides=mappings.get(t["name"], {}),
            computed=computed.get(t["name"], {}),
            order=int(t.get("order", 0)),
        )
    return dict(sorted(specs.items(), key=lambda kv: kv[1].order))
