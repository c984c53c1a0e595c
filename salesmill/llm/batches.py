"""What operators that run Python in tasks need: batches of bounded size, and the package itself."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import SparkSession

#: Rows handed to Python at once. Texts of a few megabytes each still fit a worker then.
ROWS = 512


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def bounded(spark: SparkSession, rows: int = ROWS) -> None:
    """Hand at most so many rows at once to Python workers of this session, which know this package."""
    shipped(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows of sorted batches again, in frames that never cut a group of equal ``keys``."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (rest[list(keys)] == rest[list(keys)].iloc[-1]).all(axis=1).to_numpy()
        done = 0 if last.all() else len(rest) - int(last[::-1].argmin())
        if done:
            yield rest.iloc[:done]
            rest = rest.iloc[done:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest
