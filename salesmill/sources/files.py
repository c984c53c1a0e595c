"""CSV, JSON and Parquet files as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.align import union_all

# NULL markers of incoming and outgoing text files, field separator.
NULL_IN = "\x00"
NULL_OUT = "\\N"
SEPARATOR_OUT = "\x01"
ROWS_PER_FILE = 5_000_000


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files behind paths that may be files, folders or globs; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return [r[0] for r in found.where("length > 0").select("path").orderBy("path").collect()]


def _header(spark: SparkSession, file: str, options: dict[str, object]) -> tuple[str, ...]:
    return tuple(spark.read.options(**options).csv(file).columns)


def read_csv_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    spread: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with header, every column as text; a malformed row fails the job.

    Each file is read by its own header, so columns may stand in any order;
    files with other columns give NULL for those they lack, or fail if
    ``columns`` are asked for. Quotes inside quoted values are doubled, a
    backslash is a character like any other. ``multi_line`` allows line breaks
    inside quoted values, at the price of one task per file. Compressed files
    are one task too, so ``spread`` redistributes rows for the work that follows.
    """
    options = {
        "header": True,
        "nullValue": NULL_IN,
        "mode": "FAILFAST",
        "quote": '"',
        "escape": '"',
        "enforceSchema": False,
        "multiLine": multi_line,
    }
    groups: dict[tuple[str, ...], list[str]] = {}
    found = _files(spark, [paths] if isinstance(paths, str) else paths)
    # One line of each file; the drops of a day are few.
    with ThreadPoolExecutor(8) as pool:
        for file, header in zip(found, pool.map(lambda f: _header(spark, f, options), found)):
            groups.setdefault(header, []).append(file)
    if columns is not None:
        for header, files in groups.items():
            if set(header) != set(columns):
                raise ValueError(f"{files[0]}: header {list(header)} is not {list(columns)}")
    frames = [
        spark.read.options(**options).schema(text_schema(header)).csv(files).select([F.col(f"`{c}`") for c in columns or header])
        for header, files in groups.items()
    ]
    df = union_all(frames) if frames else spark.createDataFrame([], text_schema(columns or ()))
    return df.repartition(spread) if spread else df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


CORRUPT = "_malformed"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of JSON files with a column ``_malformed``: the text of one that cannot be read, NULL for the others.

    Mark rows with it as rejected, and a load keeps them apart.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def parquet_columns(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file and column (path, column_name, kind) from the footers, which are read in tasks."""
    from pyspark.sql.pandas.types import from_arrow_type

    def read(batches):
        from urllib.parse import quote

        import pandas as pd
        from pyarrow import fs, parquet

        for batch in batches:
            rows = []
            for path in batch["path"]:
                system, place = fs.FileSystem.from_uri(quote(path, safe=":/"))
                rows += [(path, f.name, from_arrow_type(f.type).simpleString()) for f in parquet.read_schema(place, filesystem=system)]
            yield pd.DataFrame(rows, columns=["path", "column_name", "kind"])

    files = listing(spark, folder, pattern).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    return files.repartition("path").mapInPandas(read, "path string, column_name string, kind string")


def schema_problems(columns: DataFrame, declared: T.StructType | None = None) -> DataFrame:
    """(path, column_name, kind, expected, problem) where a file of a folder differs from the others.

    Expected is the declared type, or what most files have (of equally many,
    the first by name); a column that more than half of the files have is
    missing in the others. Only counts meet in one place.
    """
    spark, files = columns.sparkSession, columns.select("path").distinct()
    if declared is not None:
        usual = [(f.name, f.dataType.simpleString(), True) for f in declared.fields]
    else:
        counts = columns.groupBy("column_name", "kind").agg(F.count(F.lit(1)).alias("n"))
        order = [F.desc("n"), F.asc("kind")]
        first = F.row_number().over(Window.partitionBy("column_name").orderBy(*order))
        of = F.sum("n").over(Window.partitionBy("column_name"))
        many = files.count()
        # As many rows as there are column names.
        rows = counts.select("column_name", "kind", first.alias("i"), of.alias("of")).filter("i = 1").collect()
        usual = [(r["column_name"], r["kind"], 2 * r["of"] > many) for r in rows]
    known = spark.createDataFrame(usual, "column_name string, expected string, needed boolean")
    joined = columns.join(F.broadcast(known), "column_name", "left")
    differ = joined.filter("needed and kind <> expected").withColumn("problem", F.lit("type differs"))
    extra = joined.filter("not coalesce(needed, false)").withColumn("problem", F.lit("column of few files" if declared is None else "not declared"))
    needed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("expected")) for c, k, n in usual if n])
    lacking = (
        columns.groupBy("path").agg(F.collect_set("column_name").alias("have"))
        .select("path", "have", F.explode(needed).alias("w"))
        .filter(~F.array_contains("have", F.col("w.column_name")))
        .select("path", "w.column_name", F.lit(None).cast("string").alias("kind"), "w.expected", F.lit("missing").alias("problem"))
    )
    out = ["path", "column_name", "kind", "expected", "problem"]
    return differ.select(out).unionByName(extra.select(out)).unionByName(lacking)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_folders(spark: SparkSession, *paths: str) -> DataFrame:
    """One table fed by several folders whose columns may differ."""
    return union_all([spark.read.parquet(p) for p in paths])


def row_count(spark: SparkSession, *paths: str) -> int:
    """Rows according to the Parquet footers; no column is read."""
    return spark.read.parquet(*paths).count()


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partition_by).parquet(path)


_DELIMITED = {
    "sep": SEPARATOR_OUT,
    "header": "false",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_delimited(df: DataFrame, path: str) -> None:
    """Headerless text export with a control-character separator and ``\\N`` for NULL.

    Values holding a separator, quote or line break are quoted. Files are kept
    to a size one task can read, since such files cannot be split.
    """
    out = df.write.options(**_DELIMITED).option("nullValue", NULL_OUT).option("emptyValue", "")
    out.option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_delimited`` wrote; empty text and NULL stay apart."""
    reader = spark.read.options(**_DELIMITED).option("multiLine", True).option("mode", "FAILFAST")
    cells = reader.schema(text_schema(schema.names)).option("nullValue", NULL_IN).csv(path)
    values = [
        F.nullif(F.coalesce(F.col(f"`{f.name}`"), F.lit("")), F.lit(NULL_OUT)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return cells.select(values)


def csv_to_parquet(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    day_column: str | None = None,
    after: int | None = None,
    columns: Sequence[str] | None = None,
) -> None:
    """Convert CSV text to Parquet, keeping only rows after a day where one is given.

    The day column becomes an integer; a day that is not a number fails the job.
    """
    df = read_csv_text(spark, source, columns)
    if day_column is not None:
        df = df.withColumn(day_column, F.col(day_column).cast("int")).filter(F.col(day_column) > after)
    write_parquet(df, target)


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder: path, stem, size. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    stem = F.regexp_extract("path", r"([^/]+?)(\.(csv|parquet|json|gz))*$", 1)
    return files.select("path", stem.alias("stem"), F.col("length").alias("size"))


def pending(sources: DataFrame, outputs: DataFrame) -> DataFrame:
    """Source files for which no output of the same stem exists; empty files never qualify."""
    return sources.filter(F.col("size") > 0).join(outputs.select("stem"), "stem", "left_anti")


def inventory(df: DataFrame) -> DataFrame:
    """Files behind a frame with size and row count; dimensions first, facts last."""
    files = df.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
    rank = F.when(F.lower("file_name").startswith("dim"), 0).when(F.lower("file_name").startswith("fact"), 2)
    return files.withColumn("load_rank", F.coalesce(rank, F.lit(1))).orderBy("load_rank", "file_name")
