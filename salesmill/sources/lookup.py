"""Small shared tables (access map, filter facets): Parquet, or a database by option."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.load import Table


def read_lookup(spark: SparkSession, name: str, root: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """``options`` with a ``url`` select the JDBC source; otherwise the Parquet table is read."""
    if options and "url" in options:
        return spark.read.format("jdbc").options(**options).option("dbtable", name).load()
    return Table(spark, f"{root.rstrip('/')}/{name}").read()


def write_lookup(df: DataFrame, name: str, root: str, options: Mapping[str, str] | None = None) -> None:
    """Replace the lookup table's content."""
    if options and "url" in options:
        df.write.format("jdbc").options(**options).option("dbtable", name).option("truncate", True).mode(
            "overwrite"
        ).save()
    else:
        Table(df.sparkSession, f"{root.rstrip('/')}/{name}").replace(df)
