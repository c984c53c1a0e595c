"""Runs that can be repeated: a ledger of steps, tenants side by side, metrics from run to run."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig, run_order
from ..operators.load import Table
from ..operators.quality import VOLUME_LIMITS, error_level

_STEPS = "run string, step string, state string, message string, seconds double, at timestamp"
_METRICS = "run string, table_name string, row_count bigint, loaded bigint, rejected bigint, seconds double, at timestamp"


class Ledger:
    """Which steps of which runs are done, as small files in a folder.

    A run that broke is started again under its name: steps that are done are
    not, the others are. A step must leave nothing behind when it fails, or
    come out the same when repeated, as the loads of ``Table`` do.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        spark.createDataFrame([], _STEPS).write.mode("ignore").json(self.root)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(_STEPS).json(self.root)

    def done(self, run: str) -> set[str]:
        rows = self.entries().filter((F.col("run") == run) & (F.col("state") == "done")).select("step").collect()
        return {r["step"] for r in rows}

    def _note(self, run: str, step: str, state: str, message: str, seconds: float) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            *[F.lit(v).alias(n) for n, v in (("run", run), ("step", step), ("state", state), ("message", message), ("seconds", seconds))],
            F.current_timestamp().alias("at"),
        )
        row.write.mode("append").json(self.root)

    def run(self, run: str, steps: Iterable[tuple[str, Callable[[], object]]]) -> dict[str, object]:
        """Results of the steps carried out now, in order; stops at the first failure, which is noted."""
        done, results = self.done(run), {}
        for step, job in steps:
            if step in done:
                continue
            start = time.monotonic()
            try:
                results[step] = job()
            except Exception as err:
                self._note(run, step, "failed", f"{type(err).__name__}: {err}"[:500], time.monotonic() - start)
                raise
            self._note(run, step, "done", "", time.monotonic() - start)
        return results


def run_tenants(
    spark: SparkSession, tenants: Iterable[PipelineConfig], job: Callable[[PipelineConfig], object], fail_fast: bool = False, at_once: int = 4
) -> dict[str, object]:
    """Run a job per enabled tenant, several side by side; a failure is kept as the result.

    Tenants start in order of priority. Each has a scheduler pool and a job tag
    of its own: with ``spark.scheduler.mode=FAIR`` they share the cluster evenly,
    and what a failed tenant still has running is cancelled without touching the
    others. ``fail_fast`` starts no further tenant after a failure and raises it.
    """
    context, failed = spark.sparkContext, []

    def one(config: PipelineConfig) -> object:
        if failed and fail_fast:
            return None
        tag = f"tenant-{config.tenant}"
        context.setLocalProperty("spark.scheduler.pool", config.tenant)
        context.addJobTag(tag)
        try:
            return job(config)
        except Exception as err:  # noqa: BLE001 - one tenant must not stop the others
            context.cancelJobsWithTag(tag)
            failed.append(err)
            return err
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    ordered = run_order(tenants)
    with ThreadPoolExecutor(max(1, at_once)) as threads:
        running = [(c.tenant, threads.submit(inheritable_thread_target(spark)(one), c)) for c in ordered]
        results = {tenant: r.result() for tenant, r in running}
    if failed and fail_fast:
        raise failed[0]
    return results


def keep_metrics(spark: SparkSession, history: Table, run: str, reports: Iterable) -> None:
    """Add the load reports of a run to the stored history, once per run."""
    if history.exists() and history.holds(run):
        return
    rows = [(run, r.table, r.rows, r.loaded, r.rejected, r.seconds) for r in reports]
    frame = spark.createDataFrame(rows, _METRICS.rsplit(",", 1)[0]).withColumn("at", F.current_timestamp())
    history.append(frame.coalesce(1), run)


def compared(history: DataFrame, back: int = 4) -> DataFrame:
    """Each run of a table against those before it.

    ``ratio`` to the run before, ``usual`` (mean rows of up to ``back`` earlier
    runs), an alert where the ratio leaves the limits, and the level of the share
    of rejected rows.
    """
    low, high = VOLUME_LIMITS
    order = Window.partitionBy("table_name").orderBy("run")
    before = F.lag("row_count").over(order)
    ratio = F.col("row_count") / F.nullif("previous_rows", F.lit(0))
    alert = F.when(F.col("ratio") > high, "increase").when(F.col("ratio") < low, "decrease").otherwise("none")
    return (
        history.withColumn("previous_rows", before)
        .withColumn("usual", F.avg("row_count").over(order.rowsBetween(-back, -1)))
        .withColumn("ratio", ratio)
        .withColumn("alert", alert)
        .withColumn("level", error_level(F.col("rejected"), F.col("row_count")))
    )
