"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest derived table sent whole to every executor; beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys: oversized shuffle partitions are split at run time, also where
    # that costs one more exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
_TUNED = "salesmill.tuned"


def tune(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on, made once per session.

    Adaptive execution is on by default; sizes and partition counts stay the
    cluster's.
    """
    if spark.conf.get(_TUNED, None) is None:
        for key, value in _RUNTIME.items():
            spark.conf.set(key, value)
        spark.conf.set(_TUNED, "true")
    return spark


def build(app: str = "salesmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is an error, since a driver-local folder would be lost.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="salesmill-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _bytes(df: DataFrame) -> Column:
    """Size of a row: text by length, other columns as eight bytes."""
    texts = [f"coalesce(octet_length(`{f.name}`), 0)" for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 8 * (len(df.columns) - len(texts))
    return F.expr(" + ".join([f"{fixed}L", *texts]))


def is_small(df: DataFrame, driving: DataFrame | None = None) -> bool:
    """Whether a derived table's measured size allows its broadcast.

    ``driving`` is an input that bounds the table from below: when that is too
    big already, nothing else is measured.
    """
    if driving is not None and driving.count() > BROADCAST_ROWS:
        return False
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_bytes(df))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, driving: DataFrame | None = None) -> DataFrame:
    """Mark a derived table for broadcast if its measured size allows it.

    The planner cannot size the result of a join or aggregation and would
    shuffle the big side to be safe.
    """
    return F.broadcast(df) if is_small(df, driving) else df


def small_side(df: DataFrame) -> DataFrame:
    """Compute a derived table once, then mark it for broadcast if it is small.

    For tables that are expensive to compute: the checkpoint makes measuring
    and reuse cheap, and lost executors do not cause a recomputation.
    """
    shared_dir(df.sparkSession)
    return broadcast_if_small(df.checkpoint())
