"""From a raw drop to a loaded table, and the daily run of a tenant."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig, TableSpec
from ..functions import ddl, names
from ..functions.numbers import lenient_long
from ..operators import access, align, computed, convert, filters, quality
from ..operators.load import REJECTED, Table, group_slice, observed
from ..sources import routing
from ..sources.files import read_csv_text
from .derived import refresh_dd
from .dimensions import transform_dimension
from .facets import PRIMARY, SECONDARY, business_constants
from .runs import Ledger
from .sales import primary_sales, refresh_snapshot, secondary_in_parts


@dataclasses.dataclass(frozen=True)
class Transformed:
    frame: DataFrame
    mapping_problems: list[dict]
    absent: list[str]
    conversion_failures: dict[str, int]
    computed_skipped: dict[str, list[str]]
    widenings: list[quality.Widening]
    extra: list[str]


def _targets(schema: T.StructType) -> dict[str, T.DataType]:
    """Reading types: every integer as 64 bits first, so overflows are seen and not lost."""
    wide = {f.name: T.LongType() if isinstance(f.dataType, T.IntegralType) else f.dataType for f in schema.fields}
    return {c: t for c, t in wide.items() if not isinstance(t, T.StringType)}


def _size_measures(df: DataFrame, schema: T.StructType) -> dict:
    """Aggregates for the overflow checks, taken in the same pass as the conversion counts."""
    out = {}
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        actual = df.schema[f.name].dataType
        if isinstance(f.dataType, T.StringType) and "max_bytes" in f.metadata:
            out[f"bytes:{f.name}"] = F.max(F.octet_length(F.col(f.name).cast("string")))
        elif isinstance(f.dataType, T.IntegralType) and isinstance(actual, (T.StringType, T.IntegralType)):
            value = lenient_long(f.name) if isinstance(actual, T.StringType) else F.col(f.name)
            out[f"low:{f.name}"], out[f"high:{f.name}"] = F.min(value), F.max(value)
    return out


def transform(df: DataFrame, spec: TableSpec, config: PipelineConfig) -> Transformed:
    """Rename, cut off old days, convert, check sizes, add computed keys.

    The checks need one pass over the drop; the returned frame is lazy. Values
    outside an integer type are an error, over-long text is reported with a
    proposed size.
    """
    problems = align.mapping_problems(spec, spec.overrides)
    named, absent = align.rename_mapped(df, spec.mapping)
    day, keep = {
        "fact_invoice_secondary": ("invoice_date", lambda d: filters.from_day(d, "invoice_date", config.secondary_cutoff)),
        "fact_invoice_details": ("posting_date", lambda d: filters.after_day(d, "posting_date", config.detail_cutoff)),
    }.get(spec.name, (None, None))
    needed = {f.name for f in spec.schema.fields if not f.nullable and f.name not in spec.computed} | ({day} - {None})
    lacking = sorted(needed - set(named.columns))
    if lacking:
        raise quality.QualityError(f"{spec.name}: the drop lacks {lacking}")
    if day is not None:
        named = keep(convert.strict_int(named, day))
    extra = sorted(set(named.columns) - set(spec.schema.names))

    done = convert.convert(
        named, _targets(spec.schema), config.max_conversion_failures, extra=_size_measures(named, spec.schema)
    )
    widenings = []
    for f in spec.schema.fields:
        low, high = done.extra.get(f"low:{f.name}"), done.extra.get(f"high:{f.name}")
        if low is not None and ddl.next_int_type(f.metadata["ddl"], low, high):
            raise quality.QualityError(f"{f.name}: values {low} to {high} exceed {f.metadata['ddl']}")
        longest = done.extra.get(f"bytes:{f.name}")
        if longest is not None and longest > f.metadata["max_bytes"]:
            size = quality.proposed_bytes(longest)
            widenings.append(
                quality.Widening(spec.name, f.name, f.metadata["ddl"], f"VARCHAR({size})", f"longest value {longest} bytes")
            )
    out, skipped = computed.add_computed(done.frame, spec.computed)
    left = quality.text_in_numeric(out, spec.schema)
    if left:
        raise quality.QualityError(f"numeric columns still hold text: {left}")
    return Transformed(out, problems, absent, done.failures, skipped, widenings, extra)


@dataclasses.dataclass(frozen=True)
class LoadReport:
    table: str
    rows: int
    loaded: int
    rejected: int
    version: int
    quarantine: str | None
    seconds: float
    rule_counts: dict[str, int]
    widenings: list[quality.Widening]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The run as one metrics row."""
        share = 100.0 * self.rejected / self.rows if self.rows else 0.0
        row = (self.table, self.rows, self.loaded, self.rejected, share, self.version, self.seconds)
        return spark.createDataFrame(
            [row],
            "table_name string, row_count bigint, loaded bigint, rejected bigint, "
            "rejected_percent double, version bigint, seconds double",
        )


def load_checked(
    df: DataFrame,
    target: Table,
    schema: T.StructType,
    rules: Sequence[quality.Rule] = (),
    max_error_ratio: float = 0.0,
    mode: str = "append",
    condition: str | None = None,
    partition_by: Sequence[str] | None = None,
    table: str = "",
    widenings: Sequence[quality.Widening] = (),
    batch: str | None = None,
    fit: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> LoadReport:
    """Check and write in one pass, then gate, then publish.

    Accepted and rejected rows go to sibling folders of one staged write; the
    rule counts are observed on the way. Only when the gate is passed does the
    accepted folder become part of the table. Rejected rows stay where they were
    written, with the names of the rules they broke. Rows added to a table have
    its partitions; others are refused. ``fit`` gives the rows their declared
    columns (see ``Table.stage``).
    """
    if mode not in ("replace", "slice", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    started = time.monotonic()
    stored = target.commits()
    own = stored[-1].partitions if stored else None
    if mode != "replace" and own is not None:
        if partition_by is not None and tuple(partition_by) != own:
            raise ValueError(f"the table is partitioned by {own}, not {tuple(partition_by)}")
        partition_by = own
    partition_by = tuple(partition_by or ())
    seen = Observation()
    flagged = lambda rows: quality.flag(fit(rows), rules).withColumn(REJECTED, quality.rejected(rules))
    path, good = target.stage(df, partition_by, (seen, quality.count_columns(rules)), flagged)
    counts = observed(seen)
    quality.gate(counts, rules, max_error_ratio)
    bad = counts.get("rejected", 0)
    if mode == "replace" or not stored:
        version = target.commit("replace", path, good, schema, partition_by, batch=batch)
    elif mode == "slice":
        version = target.exchange(path, good, condition, schema, batch)
    else:
        version = target.commit("append", path, good, schema, partition_by, batch=batch)
    return LoadReport(
        table,
        good + bad,
        good,
        bad,
        version,
        path.replace(f"{REJECTED}=false", f"{REJECTED}=true") if bad else None,
        time.monotonic() - started,
        {k.removeprefix("rule:"): v for k, v in counts.items() if k.startswith("rule:")},
        list(widenings),
    )


#: Declared size of an added text column; longer values widen it like any other.
ADDED_TEXT = 255


def with_added(df: DataFrame, spec: TableSpec, stored: T.StructType | None) -> TableSpec:
    """The table's declaration with the columns that earlier drops added and those that this one brings.

    Added columns come last and may be null. They are named as the feed names
    them, in lower case with underscores for what a name may not hold.
    """
    fields = list(spec.schema.fields) + [f for f in stored or () if f.name not in spec.schema.names]
    known = dataclasses.replace(spec, schema=T.StructType(fields))
    named, _ = align.rename_mapped(df, known.mapping)
    overrides, taken = dict(spec.overrides), set(named.columns)
    for f in named.schema.fields:
        if f.name in {x.name for x in fields}:
            continue
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise quality.QualityError(f"{spec.name}: {f.name} is no plain column")
        name = names.safe_name(re.sub(r"[^a-z0-9_]+", "_", names.unquoted(f.name).lower()))
        if name in taken - {f.name} or name in spec.schema.names:
            raise quality.QualityError(f"{spec.name}: {f.name} cannot be added, {name} is there already")
        if name not in {x.name for x in fields}:
            text = isinstance(f.dataType, T.StringType)
            fields.append(ddl.field(name, f"VARCHAR({ADDED_TEXT})" if text else ddl.declared(f)))
        overrides[f.name] = name
        taken.add(name)
    return dataclasses.replace(spec, schema=T.StructType(fields), overrides=overrides)


def run_table(
    df: DataFrame,
    spec: TableSpec,
    config: PipelineConfig,
    target: Table,
    rules: Sequence[quality.Rule] = (),
    mode: str = "append",
    condition: str | None = None,
    batch: str | None = None,
) -> LoadReport:
    """A raw drop through transformation, conformance and the checked load, which the log keeps under ``batch``."""
    if config.extra_columns == "add":
        spec = with_added(df, spec, target.schema() if target.exists() else None)
    done = transform(df, spec, config)
    if done.mapping_problems:
        raise quality.QualityError(f"{spec.name}: {done.mapping_problems}")
    if done.extra and config.extra_columns == "refuse":
        raise quality.QualityError(f"{spec.name}: columns that the table does not have: {done.extra}")
    lost = {c: m for c, m in done.computed_skipped.items() if c in spec.schema.names}
    if lost:
        raise quality.QualityError(f"{spec.name}: keys without their columns: {lost}")
    schema = quality.widened(spec.schema, done.widenings)
    if spec.name.startswith("dim_"):
        fitted, _ = transform_dimension(done.frame, spec)
    else:
        fitted = done.frame
    unfit = ddl.type_mismatches(fitted.schema, spec.schema)
    if unfit:
        raise quality.QualityError(f"{spec.name}: types do not fit {unfit}")
    return load_checked(
        fitted,
        target,
        schema,
        [*quality.declared_required(schema), *rules],
        config.max_error_ratio,
        mode,
        condition,
        spec.partition_by,
        spec.name,
        done.widenings,
        batch,
        lambda rows: align.conform(rows, schema),
    )


def daily_run(
    spark: SparkSession,
    config: PipelineConfig,
    specs: Mapping[str, TableSpec],
    drops: Mapping[str, DataFrame],
    run_date: dt.date,
    modes: Mapping[str, tuple[str, str | None]] | None = None,
    rules: Mapping[str, Sequence[quality.Rule]] | None = None,
    ledger: Ledger | None = None,
) -> dict[str, LoadReport]:
    """Dimensions, facts, derived records, then everything computed from them.

    ``modes`` gives a fact's load mode and slice condition; dimensions are
    replaced. Order matters: views read what the loads before them published.

    A fact that is appended goes in once a day: its load is committed under the
    day and the table, and a run repeated for that day leaves it out. With a
    ``ledger`` a run that broke goes on where it stopped; what is returned are
    the loads carried out now.
    """
    modes, rules = modes or {}, rules or {}

    def table(name: str) -> Table:
        return Table(spark, config.path("tables", name))

    def load(name: str) -> LoadReport | None:
        mode, condition = modes.get(name, ("append", None) if name.startswith("fact_") else ("replace", None))
        batch = f"{run_date:%Y-%m-%d} {name}" if mode == "append" else None
        if batch and table(name).holds(batch):
            return None
        if mode == "slice" and not table(name).exists():
            mode, condition = "replace", None
        return run_table(drops[name], specs[name], config, table(name), rules.get(name, ()), mode, condition, batch)

    def derived() -> None:
        if table("fact_invoice_details").exists():
            refresh_dd(table("fact_invoice_details").read(), table("fact_invoice_secondary"), config, run_date)

    def grants() -> None:
        if table("dim_hierarchy").exists():
            hierarchy = table("dim_hierarchy").read()
            table("rls_map").replace(access.access_map(hierarchy))
            table("rls_master").replace(access.hierarchy_paths(hierarchy))

    def current() -> dict[str, DataFrame]:
        found = {n: table(n).read() for n in specs if table(n).exists()}
        dims = {n for n in specs if n.startswith("dim_")}
        return found if dims and dims <= set(found) else {}

    def snapshot() -> None:
        tables = current()
        if "fact_invoice_secondary" in tables:
            lines, shown = secondary_in_parts(tables, config.secondary_cutoff, config.material_types)
            refresh_snapshot(lines, table("secondary_sales_mat_view"), shown=shown)

    def constants() -> None:
        tables, views = current(), {}
        if "fact_invoice_secondary" in tables:
            views[SECONDARY] = table("secondary_sales_mat_view").read()
        if "fact_invoice_details" in tables:
            views[PRIMARY] = primary_sales(tables)
        if views:
            found = business_constants(views, config.sales_threshold)
            table("business_constants").insert_missing(found, ["group_name", "display_name", "value"])

    ordered = sorted(drops, key=lambda n: (n.startswith("fact_"), specs[n].order))
    steps = [(f"load {n}", lambda n=n: load(n)) for n in ordered]
    steps += [("derived records", derived), ("access map", grants), ("snapshot", snapshot), ("constants", constants)]
    if ledger is None:
        results = {step: job() for step, job in steps}
    else:
        results = ledger.run(f"{run_date:%Y-%m-%d}", steps)
    return {n: results[f"load {n}"] for n in ordered if results.get(f"load {n}") is not None}


def drop_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders that a drop consists of; contents are not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def run_drops(
    spark: SparkSession,
    config: PipelineConfig,
    specs: Mapping[str, TableSpec],
    folder: str,
    rules: Mapping[str, Sequence[quality.Rule]] | None = None,
) -> list[LoadReport]:
    """Load each drop of a folder where its name says: the table, and the slice of its sales groups.

    Dimensions are replaced. A fact drop replaces the groups it names, derived
    records or the others as the name says, so that a drop sent again is not
    counted twice; one without groups replaces all rows of its kind.
    """
    reports = []
    for name in drop_names(spark, folder):
        stem = name.split(".")[0]
        spec = specs[routing.table_for_stem(stem)]
        target = Table(spark, config.path("tables", spec.name))
        path = f"{folder.rstrip('/')}/{name}"
        drop = read_csv_text(spark, path) if ".csv" in name else spark.read.parquet(path)
        mode, condition = "replace", None
        if spec.name.startswith("fact_") and target.exists():
            groups = routing.sales_groups(stem)
            kind = "record_type = 'DD'" if routing.is_dd_drop(stem) else "coalesce(record_type, '') <> 'DD'"
            has_kind = "record_type" in spec.schema.names
            mode, condition = "slice", kind if has_kind else "true"
            if groups:
                condition += " AND " + group_slice(groups, keep_dd=False)
        reports.append(run_table(drop, spec, config, target, (rules or {}).get(spec.name, ()), mode, condition))
    return reports
