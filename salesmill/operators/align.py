"""Renaming columns and fitting frames to a declared schema."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TableSpec
from ..functions import names


@dataclasses.dataclass(frozen=True)
class Alignment:
    """A fitted frame and what it took."""

    frame: DataFrame
    missing: tuple[str, ...]
    extra: tuple[str, ...]


def rename_mapped(df: DataFrame, mapping: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Apply a rename map; returns the frame and the source columns not present."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    absent = [k for k in mapping if k not in df.columns]
    return df.withColumnsRenamed(present), absent


def rename_squashed(df: DataFrame) -> DataFrame:
    """Every column under its squashed name; collisions are an error."""
    new = [names.squash(c) for c in df.columns]
    twice = {n for n in new if new.count(n) > 1}
    if twice:
        raise ValueError(f"names collide after normalisation: {sorted(twice)}")
    return df.toDF(*new)


def rename_reserved(df: DataFrame, suffix: str = "_raw") -> tuple[DataFrame, dict[str, str]]:
    """Give reserved words a suffix."""
    renamed = {c: names.safe_name(c, suffix) for c in df.columns if names.is_reserved(c)}
    return df.withColumnsRenamed(renamed), renamed


def rename_matched(df: DataFrame, targets: Mapping[str, str], aliases: Mapping[str, str] | None = None, prefixes: Sequence[str] = ()) -> DataFrame:
    """Rename by the column matcher: exact names first, no target twice; other columns keep their names."""
    taken = names.assign([(f.name, f.dataType) for f in df.schema.fields], targets, aliases, prefixes)
    left = {c.lower() for c in df.columns if c not in taken} & {t.lower() for t in taken.values()}
    if left:
        raise ValueError(f"columns without a target have the name of one: {sorted(left)}")
    return df.withColumnsRenamed({k: v for k, v in taken.items() if k != v})


def align(df: DataFrame, schema: T.StructType) -> Alignment:
    """All declared columns in declared order: missing ones NULL, extra ones dropped.

    Names match in any case. Types of present columns are left alone.
    """
    have = {c.lower(): c for c in df.columns}
    want = {f.name.lower() for f in schema.fields}
    missing = tuple(f.name for f in schema.fields if f.name.lower() not in have)
    extra = tuple(c for c in df.columns if c.lower() not in want)
    picked = [
        F.col(f"`{have[f.name.lower()]}`").alias(f.name)
        if f.name.lower() in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return Alignment(df.select(picked), missing, extra)


def reorder(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Declared columns that the frame has, in declared order."""
    have = {c.lower(): c for c in df.columns}
    return df.select([F.col(f"`{have[c.lower()]}`").alias(c) for c in order if c.lower() in have])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align, then cast to the declared types, keeping the declarations.

    A value that does not fit its type is an error.
    """
    return align(df, schema).frame.select(
        [F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in schema.fields]
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def mapping_problems(spec: TableSpec, mapping: Mapping[str, str], required: Iterable[str] = ()) -> list[dict]:
    """Mapped targets the table lacks, and required columns nothing maps to."""
    declared = {f.name.lower() for f in spec.schema.fields}
    problems = [
        {"source": s, "target": t, "problem": "target column is not declared"}
        for s, t in mapping.items()
        if t.lower() not in declared
    ]
    covered = {t.lower() for t in mapping.values()}
    problems += [
        {"source": None, "target": r, "problem": "required column is not mapped"}
        for r in required
        if r.lower() not in covered
    ]
    return problems
