"""Reference data delivered as CSV files next to the tenant settings."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TableSpec
from ..functions.names import snake_case, squash
from ..functions.text import strip_all
from ..operators.align import conform
from ..operators.load import Table
from .files import read_csv_text


@dataclasses.dataclass(frozen=True)
class Seed:
    table: str
    csv_file: str
    enabled: bool = True
    truncate_before_load: bool = True


def seed_frame(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Seed file in the table's columns and types; blank cells are NULL.

    Headers match in any case; an unmapped one is taken in snake case.
    """
    raw = read_csv_text(spark, path)
    mapping = spec.mapping
    named = {c: mapping.get(squash(c), snake_case(c)) for c in raw.columns}
    cells = [
        F.when(strip_all(f"`{c}`") != "", F.col(f"`{c}`")).alias(target) for c, target in named.items()
    ]
    return conform(raw.select(cells), spec.schema)


def load_seed(
    spark: SparkSession,
    seeds: Mapping[str, Seed],
    table: str,
    folder: str,
    spec: TableSpec,
    target: Table,
    truncate: bool = False,
) -> int:
    """Load one seed; returns the rows loaded. Disabled seeds load nothing."""
    seed = seeds.get(table)
    if seed is None:
        raise KeyError(f"no seed is declared for {table}")
    if not seed.enabled:
        return 0
    df = seed_frame(spark, f"{folder.rstrip('/')}/{seed.csv_file}", spec)
    if truncate or seed.truncate_before_load:
        target.replace(df)
    else:
        target.append(df)
    return target.commits()[-1].rows
