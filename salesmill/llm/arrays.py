"""Running sums and pattern places inside one row, in built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64


def with_starts(df: DataFrame, sizes: str, out: str) -> DataFrame:
    """``out``: for each element of the long array ``sizes`` the sum of those before it.

    Sums are taken over blocks first, and over blocks of blocks, so that an
    element of a long array costs a few blocks' steps and not all before it.
    """
    blocks, wide = f"_{out}_blocks", f"_{out}_wide"
    total = "aggregate({}, 0L, (a, x) -> a + x)"
    sums = lambda of: F.expr(f"transform(sequence(0, size({of}) div {BLOCK}), b -> " + total.format(f"slice({of}, b * {BLOCK} + 1, {BLOCK})") + ")")
    # Sums named once only would be moved into the function and taken anew for each element, hence the bounds.
    parts = (
        f"slice({wide}, 1, least(i div {BLOCK * BLOCK}, size({wide})))",
        f"slice({blocks}, (i div {BLOCK * BLOCK}) * {BLOCK} + 1, least((i div {BLOCK}) % {BLOCK}, size({blocks})))",
        f"slice({sizes}, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK})",
    )
    # A short array needs no blocks.
    few = f"transform({sizes}, (x, i) -> " + total.format(f"slice({sizes}, 1, i)") + ")"
    many = f"transform({sizes}, (x, i) -> " + " + ".join(map(total.format, parts)) + ")"
    summed = df.withColumn(blocks, sums(sizes))
    return summed.withColumn(wide, sums(blocks)).withColumn(out, F.expr(f"if(size({sizes}) <= {BLOCK}, {few}, {many})")).drop(blocks, wide)


def literal(pattern: str) -> str:
    """A pattern as a SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_places(df: DataFrame, text: str, pattern: str, out: str, only: str = "true") -> DataFrame:
    """``out``: structs (start, end, value) of the leftmost non-overlapping matches of ``pattern``.

    Places are code points, the end exclusive. Built-in functions give the
    matches and the text between them but no places; those are running sums of
    lengths. ``only`` is a cheap condition without which nothing matches.
    """
    p, found, gaps, sizes = literal(pattern), f"_{out}_found", f"_{out}_gaps", f"_{out}_sizes"
    df = (
        df.withColumn(found, F.expr(f"if({only}, regexp_extract_all(`{text}`, {p}, 0), array())"))
        .withColumn(
            gaps,
            F.expr(f"if(size({found}) > 0, transform(split(`{text}`, {p}), g -> cast(length(g) as bigint)), array())"),
        )
        .withColumn(
            sizes, F.expr(f"transform({found}, (v, i) -> cast(length(v) as bigint) + element_at({gaps}, i + 1))")
        )
    )
    df = with_starts(df, sizes, f"_{out}_before")
    return df.withColumn(
        out,
        F.expr(
            f"transform({found}, (v, i) -> struct("
            f"_{out}_before[i] + {gaps}[i] as start, _{out}_before[i] + {gaps}[i] + length(v) as end, v as value))"
        ),
    ).drop(found, gaps, sizes, f"_{out}_before")
