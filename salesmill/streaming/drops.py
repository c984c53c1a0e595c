"""Load new drops into stored tables, each once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import PipelineConfig, TableSpec
from ..operators import quality
from ..operators.load import Table
from ..plans.ingest import LoadReport, run_table

#: Loads a batch under an id and tells about it.
Job = Callable[[DataFrame, str], object]


def ingest_new(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: Table,
    checkpoint: str,
    file_format: str = "parquet",
    pattern: str = "*",
    job: Job | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> list[object]:
    """Load files that arrived since the last call; returns what ``job`` said of each batch.

    A stream may run its last batch again after a failure. Each batch is
    therefore committed to the table's log under an id of the stream and the
    batch, and one that the log holds already is skipped, so every file ends up
    in the table exactly once. ``job`` must commit under the id it is given;
    without one the rows are appended as they are.
    """
    job = job or (lambda batch, name: target.append(batch, name))
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    said = []

    def load(batch: DataFrame, number: int) -> None:
        name = f"{checkpoint}#{number}"
        if not target.holds(name):
            said.append(job(batch, name))

    query = (
        reader.load(folder)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
    return said


def ingest_drops(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    spec: TableSpec,
    config: PipelineConfig,
    target: Table,
    checkpoint: str,
    rules: Sequence[quality.Rule] = (),
    **options,
) -> list[LoadReport]:
    """New text drops of a table through its whole job: renaming, cut-off, conversion, checks, quarantine and gate.

    A batch that the job refuses fails the stream, and with it comes again at
    the next call.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def job(batch: DataFrame, name: str) -> LoadReport:
        return run_table(batch, spec, config, target, rules, "append", batch=name)

    return ingest_new(spark, folder, text, target, checkpoint, job=job, **options)
