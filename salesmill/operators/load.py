"""Loading tables: append, replace, upsert, slice replacement, compaction.

A table is a folder with Parquet data and a commit log. Data is written to a
fresh path, counted, and only then named in the log; a failed or interrupted
load leaves the table as it was. Slices of a partitioned table are exchanged by
moving the folders of their partitions from such a path into the table, as a
dynamic partition overwrite ends, but with nothing written again; the next use
of the table finishes what was interrupted.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Collection, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .align import conform
from .quality import within_retention
from .records import first_per_key

_LOG = "version bigint, kind string, path string, emptied array<string>, rows bigint, table_schema string, partitions array<string>, batch string"


REJECTED = "_rejected"
#: Codec of the files: reads about as fast as Spark's default and writes fewer bytes.
CODEC = "zstd"


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


class LoadError(RuntimeError):
    """The written data is not what was to be written."""


@dataclasses.dataclass(frozen=True)
class Commit:
    """``kind``: replace, append, schema (new types only), publish (partitions about to be exchanged), published."""

    version: int
    kind: str
    path: str
    emptied: tuple[str, ...]
    rows: int
    table_schema: str
    partitions: tuple[str, ...]
    batch: str | None


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row of a batch per key: the first in ``order``, of equal ones the one with the largest values."""
    return first_per_key(rows, keys, [*order, *[F.col(f"`{c}`").desc_nulls_last() for c in rows.columns if c not in keys]])


def upserted(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Updates replace target rows with the same key; the rest stays. A key repeated in the batch is stored once."""
    updates = one_per_key(updates, keys, order)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(target.columns).unionByName(updates.select(target.columns))


def new_only(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Rows whose key the target does not hold yet, one per key."""
    return one_per_key(rows, keys, order).join(target.select(*keys), list(keys), "left_anti").select(rows.columns)


def slice_replaced(target: DataFrame, rows: DataFrame, slice_: str | Column) -> DataFrame:
    """Target without the slice, plus the new rows.

    As in a SQL DELETE, target rows for which the condition is NULL stay.
    """
    condition = F.expr(slice_) if isinstance(slice_, str) else slice_
    return target.filter(~F.coalesce(condition, F.lit(False))).unionByName(rows, allowMissingColumns=True)


def dd_slice() -> str:
    return "record_type = 'DD'"


def group_slice(codes: Sequence[str], keep_dd: bool = True) -> str:
    """Condition for the given sales groups, optionally sparing derived records."""
    listed = ", ".join(str(int(c)) for c in codes)
    text = f"sales_group_code IN ({listed})"
    return f"{text} AND record_type <> 'DD'" if keep_dd else text


def observed(observation: Observation) -> dict[str, int]:
    """Metrics of a finished write; none when the planner saw that there was nothing to write."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


class Table:
    """A table folder with its commit log. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._opened = False

    # -- reading --

    def _log(self) -> DataFrame:
        log = f"{self.root}/log"
        if not self._opened:
            # A first use leaves an empty log, later ones find it.
            self.spark.range(0).select(*self._entry()).write.mode("ignore").json(log)
            self._opened = True
        return self.spark.read.schema(_LOG).json(log)

    def commits(self) -> list[Commit]:
        """Commits that make up the table now, oldest first: from the last replacement or exchange on."""
        rows = [r.asDict() for r in self._log().collect()]
        found = [Commit(**(r | {"emptied": tuple(r["emptied"] or ()), "partitions": tuple(r["partitions"])})) for r in rows]
        found.sort(key=lambda c: c.version)
        starts = [i for i, c in enumerate(found) if c.kind in ("replace", "published")]
        found = found[starts[-1] :] if starts else found
        if found and found[-1].kind == "publish":
            return [self._publish(found)]
        return found

    def holds(self, batch: str) -> bool:
        """Whether a load with this id has been committed."""
        return not self._log().filter(F.col("batch") == batch).isEmpty()

    def exists(self) -> bool:
        return bool(self.commits())

    def _known(self) -> list[Commit]:
        found = self.commits()
        if not found:
            raise LoadError(f"{self.root} holds no table")
        return found

    def schema(self) -> T.StructType:
        return _schema(self._known())

    def read(self) -> DataFrame:
        """Current content, one scan however many loads and exchanges there were."""
        return self._frame(self._known())

    def _frame(self, found: list[Commit]) -> DataFrame:
        return self._files([c.path for c in found if c.rows], _schema(found))

    def _files(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*[f"`{n}`" for n in schema.names])

    # -- writing --

    def stage(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        watch: tuple[Observation, Sequence[Column]] | None = None,
        fit: Callable[[DataFrame], DataFrame] = _as_is,
    ) -> tuple[str, int]:
        """Write to a fresh path and check the row count against what was sent.

        ``fit`` gives the rows their final columns, row by row. It runs behind
        the shuffle, so that constant and derived columns are not sent; of
        ``partition_by``, columns that ``df`` has must keep their values.
        ``watch`` is observed on the way. Counts are taken in the writing tasks,
        behind the shuffle, where a task that is run again counts once.
        Rows marked ``_rejected`` go to their own folder of the same write. The
        path and the count returned are those of the other rows.
        """
        load = f"{self.root}/data/load=v{uuid.uuid4().hex}"
        sent = Observation()
        good = F.count_if(~F.col(REJECTED)).alias("good")
        # Even-sized files per partition value; oversized values are split.
        known = [c for c in partition_by if c in df.columns]
        if known:
            out = fit(df.hint("rebalance", *known))
        else:
            out = fit(df).hint("rebalance", *partition_by) if partition_by else fit(df)
        if REJECTED not in out.columns:
            out = out.withColumn(REJECTED, F.lit(False))
        schema = out.schema
        if watch is not None:
            out = out.observe(watch[0], *watch[1])
        out = out.observe(sent, F.count(F.lit(1)).alias("rows"), good)
        out.write.partitionBy(REJECTED, *partition_by).option("compression", CODEC).parquet(load)
        counts = observed(sent)
        self.check(load, schema, counts.get("rows", 0))
        return f"{load}/{REJECTED}=false", counts.get("good", 0)

    def check(self, path: str, schema: T.StructType, rows: int) -> None:
        written = self.spark.read.schema(schema).parquet(path).count()
        if written != rows:
            raise LoadError(f"{path}: {written} rows written, {rows} expected")

    @staticmethod
    def _entry(values: Sequence[object] | None = None) -> list[Column]:
        fields = T.StructType.fromDDL(_LOG).fields
        values = values if values is not None else [None] * len(fields)
        return [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields)]

    def commit(
        self,
        kind: str,
        path: str,
        rows: int,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        emptied: Sequence[str] = (),
        found: list[Commit] | None = None,
        batch: str | None = None,
    ) -> int:
        """Make a staged path part of the table: one small file added to the log."""
        found = self.commits() if found is None else found
        version = (found[-1].version if found else 0) + 1
        entry = self._entry([version, kind, path, list(emptied), rows, schema.json(), list(partition_by), batch])
        self.spark.range(1, numPartitions=1).select(*entry).write.mode("append").json(f"{self.root}/log")
        return version

    def replace(self, df: DataFrame, partition_by: Sequence[str] | None = None, fit: Callable[[DataFrame], DataFrame] = _as_is) -> int:
        """New content for the whole table, in the columns that ``fit`` gives it (see ``stage``). May read the table it replaces."""
        return self._replace(df, self.commits(), partition_by, fit=fit)

    def _replace(
        self,
        df: DataFrame,
        found: list[Commit],
        partition_by: Sequence[str] | None = None,
        batch: str | None = None,
        fit: Callable[[DataFrame], DataFrame] = _as_is,
    ) -> int:
        parts = tuple(partition_by) if partition_by is not None else _partitions(found)
        path, rows = self.stage(df, parts, fit=fit)
        return self.commit("replace", path, rows, fit(df).schema, parts, found=found, batch=batch)

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        found = self.commits()
        if not found:
            return self._replace(df, found, batch=batch)
        schema, parts = _schema(found), _partitions(found)
        path, rows = self.stage(df, parts, fit=lambda rows: conform(rows, schema))
        return self.commit("append", path, rows, schema, parts, found=found, batch=batch)

    def replace_slice(self, df: DataFrame, condition: str, fit: Callable[[DataFrame], DataFrame] = _as_is) -> int:
        """Exchange the rows meeting a condition; in a partitioned table only the partitions involved are written.

        ``fit`` gives the new rows their columns (see ``stage``).
        """
        found = self.commits()
        if not found:
            return self._replace(df, found, fit=fit)
        schema = _schema(found)
        path, rows = self.stage(df, _partitions(found), fit=lambda rows: conform(fit(rows), schema))
        return self.exchange(path, rows, condition)

    def exchange(self, path: str, rows: int, condition: str, schema: T.StructType | None = None, batch: str | None = None) -> int:
        """``replace_slice`` with rows that have been staged."""
        found = self._known()
        schema = schema or _schema(found)
        current, staged = self._files([c.path for c in found if c.rows], schema), self._files([path] * bool(rows), schema)
        meant = F.coalesce(F.expr(condition), F.lit(False))
        return self._exchange(found, path, rows, schema, current.filter(~meant), [current.filter(meant), staged], batch)

    def _exchange(
        self, found: list[Commit], path: str, rows: int, schema: T.StructType, kept: DataFrame, involved: Sequence[DataFrame], batch: str | None = None
    ) -> int:
        """Staged rows and those ``kept``, in place of the partitions that the rows ``involved`` stand in.

        Loads appended since the last exchange move along, so that afterwards
        the table is one folder again. Without partitions all of it is written.
        """
        parts = _partitions(found)
        if not parts:
            new = self._files([path] * bool(rows), schema)
            return self._replace(kept.unionByName(new).hint("rebalance"), found, batch=batch)
        late = self._files([c.path for c in found[1:] if c.rows], schema)
        # Partition values meet on the driver, as they do whenever Spark lists a table's files.
        values = T.StructType([f for f in schema.fields if f.name in parts])
        touched = set(reduce(DataFrame.union, [df.select(values.names).distinct() for df in (*involved, late)]).distinct().collect())
        stays = _among(kept, self.spark.createDataFrame(list(touched), values))
        if not stays.isEmpty():
            path, rows = self.stage(stays.unionByName(self._files([path] * bool(rows), schema)), parts)
        empty = list(touched - set(self._files([path] * bool(rows), schema).select(values.names).distinct().collect()))
        emptied = []
        if empty and found[0].rows:
            lost = _among(self.spark.read.schema(schema).parquet(found[0].path).select(*values.names, "_metadata.file_path"), self.spark.createDataFrame(empty, values))
            emptied = [r[0] for r in lost.select(F.regexp_extract("file_path", "^(.*)/[^/]+$", 1)).distinct().collect()]
        self.commit("publish", path, rows, schema, parts, emptied, found, batch)
        return self.commits()[-1].version

    def _publish(self, found: list[Commit]) -> Commit:
        """Put the partitions of a staged path in place of those of the base. Done again, it moves what is left to move."""
        base, last = found[0].path, found[-1]
        hadoop, uri = self.spark._jvm.org.apache.hadoop.fs.Path, self.spark._jvm.java.net.URI
        files = hadoop(base).getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(hadoop(base))
        if last.rows and files.exists(hadoop(last.path)):
            self._move(files, hadoop(last.path), hadoop(base), len(last.partitions))
        for folder in last.emptied:
            files.delete(hadoop(uri(folder)), True)
        done = dataclasses.replace(last, version=last.version + 1, kind="published", path=base, emptied=(), rows=-1, batch=None)
        self.commit(done.kind, done.path, done.rows, _schema(found), done.partitions, found=found)
        return done

    def _move(self, files, staged, base, depth: int) -> None:
        """Folders of partition values, ``depth`` levels down, from one path to another."""
        for folder in [s.getPath() for s in files.listStatus(staged) if s.isDirectory() and "=" in s.getPath().getName()]:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(base, folder.getName())
            if depth > 1:
                files.mkdirs(place)
                self._move(files, folder, place, depth - 1)
                continue
            files.delete(place, True)
            if not files.rename(folder, place):
                raise LoadError(f"{folder.toString()} could not be moved to {place.toString()}")

    def upsert(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> int:
        """Replace rows by key. In a partitioned table only the partitions involved are rewritten.

        A key that the batch repeats is stored once, the first in ``order``.
        Partition by ``hash_part`` of the key where nothing else is at hand: one
        key then rewrites one of the parts.
        """
        found = self.commits()
        if not found:
            return self._replace(one_per_key(df, keys, order), found)
        schema, current = _schema(found), self._frame(found)
        path, rows = self.stage(one_per_key(conform(df, schema), keys, order), _partitions(found))
        staged = self._files([path] * bool(rows), schema)
        changed = staged.select(*keys)
        kept = current.join(changed, list(keys), "left_anti").select(current.columns)
        return self._exchange(found, path, rows, schema, kept, [current.join(changed, list(keys), "left_semi"), staged])

    def delete(self, condition: str) -> int:
        """Drop the rows meeting a condition."""
        return self.exchange("", 0, condition)

    def retain(self, column: str, as_of: dt.date, days: int) -> int:
        """Rewrite the table without rows older than the retention period; undated rows stay.

        The files of the removed rows go with the next ``vacuum``.
        """
        found = self._known()
        kept, parts = within_retention(self._frame(found), column, as_of, days), _partitions(found)
        return self._replace(kept if parts else kept.hint("rebalance"), found, parts)

    def insert_missing(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> int:
        """Add rows with new keys; of a key that the batch repeats, the first in ``order``."""
        found = self.commits()
        return self.append(new_only(self._frame(found), df, keys, order) if found else one_per_key(df, keys, order))

    def compact(self, partition_by: Sequence[str] | None = None) -> int:
        """Rewrite small files into evenly sized files."""
        found = self._known()
        current = self._frame(found)
        parts = tuple(partition_by) if partition_by is not None else _partitions(found)
        return self._replace(current if parts else current.hint("rebalance"), found, parts)

    def vacuum(self, age: dt.timedelta) -> list[str]:
        """Remove the data that no commit names any more and that is older than ``age``; returns the folders.

        Whoever reads the table should be done with the older state by then.
        """
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        data = path(f"{self.root}/data")
        files = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        used = {c.path.rsplit(f"/{REJECTED}=", 1)[0].rsplit("/", 1)[-1] for c in self.commits()}
        limit = (time.time() - age.total_seconds()) * 1000
        old = [s.getPath() for s in files.listStatus(data) if s.getPath().getName() not in used and s.getModificationTime() < limit]
        for folder in old:
            files.delete(folder, True)
        return [folder.toString() for folder in old]

    def evolve(self, schema: T.StructType) -> int:
        """Wider column types. Files stay as they are where the reader promotes what they hold, else all is rewritten."""
        found = self._known()
        parts, old = _partitions(found), _schema(found)
        if schema.names == old.names and all(_promoted(a.dataType, b.dataType) and (a.name not in parts or a.dataType == b.dataType) for a, b in zip(old, schema)):
            return self.commit("schema", "", 0, schema, parts, found=found)
        return self._replace(conform(self._frame(found), schema), found)


# Whole numbers by size; Parquet holds the first three in 32 bits.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def _promoted(old: T.DataType, new: T.DataType) -> bool:
    """Whether files with the old type can be read as the new one."""
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE.index(old) <= _WHOLE.index(new)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale == old.scale and new.precision >= old.precision
    return old == new or (isinstance(old, T.FloatType) and isinstance(new, T.DoubleType))


def hash_part(keys: Sequence[str], parts: int) -> Column:
    """Partition number of a key, for tables that are changed by key and have no other partitions."""
    return F.pmod(F.xxhash64(*[f"`{k}`" for k in keys]), F.lit(parts)).cast("int")


def _among(df: DataFrame, values: DataFrame) -> DataFrame:
    """Rows of ``df`` in the given partitions, nulls included; the others are not read."""
    renamed = F.broadcast(values.select([F.col(f"`{c}`").alias(f"_v_{c}") for c in values.columns]))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_v_{c}`")) for c in values.columns]
    return df.join(renamed, reduce(lambda a, b: a & b, same), "left_semi")


def _schema(found: list[Commit]) -> T.StructType:
    return T.StructType.fromJson(json.loads(found[-1].table_schema))


def _partitions(found: list[Commit]) -> tuple[str, ...]:
    return found[-1].partitions if found else ()


def save_bucketed(
    df: DataFrame, name: str, columns: Sequence[str], buckets: int, mode: str = "overwrite", path: str | None = None
) -> DataFrame:
    """Catalog table hashed into buckets, one file each: joins and aggregations on the columns then need no shuffle.

    ``path`` is where the files go, by default the warehouse.
    """
    out = df.repartition(buckets, *[F.col(f"`{c}`") for c in columns]).write.mode(mode).bucketBy(buckets, *columns).sortBy(*columns)
    (out.option("path", path) if path else out).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def register(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    views: dict[str, tuple[int, object]],
    protected: Collection[str] = (),
) -> list[str]:
    """Temp views for tables, then for views in their declared order.

    ``views`` maps a name to (order, function of the registered frames). Views
    that are ``protected`` are built for those after them but get no name in
    the session, where any query could read them.
    """
    done = dict(tables)
    for name, (_, build) in sorted(views.items(), key=lambda kv: kv[1][0]):
        done[name] = build(done)
    for name, df in done.items():
        if name not in protected:
            df.createOrReplaceTempView(name)
    return [name for name in done if name not in protected]
