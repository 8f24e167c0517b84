"""Writers: staged and published slices, whole-table snapshots, appends. All paths are on shared storage."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.types import void_to_string
from tillhouse.operators.scd import is_versioned, scd2_apply, scd2_initial


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below a path that begin with a prefix, without it."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]
    return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def new_run() -> str:
    """Name of a write; names sort in the order in which they were given out."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def staged_path(path: str, run: str) -> str:
    # folders that begin with an underscore are no part of the table to Spark
    return f"{path}/_staged/{run}"


def stage_slices(df: DataFrame, path: str, column: str, slices: Iterable[date | str], run: str) -> set[str]:
    """Write the named slices beside the table, where no reader of it looks. Returns the slices that got rows.

    A row outside the named slices fails the write instead of being dropped. Rows are rebalanced by slice, so a large
    slice gets several files and small ones stay whole.
    """
    names = sorted({str(s) for s in slices})
    if not names:
        raise ValueError("no slices named")
    text = F.col(column).cast("string")
    outside = F.raise_error(F.concat(F.lit(f"row outside the written slices: {column}="),
                                     F.coalesce(text, F.lit("null"))))
    checked = df.withColumn(column, F.when(F.coalesce(text.isin(names), F.lit(False)), F.col(column))
                            .otherwise(outside.cast(df.schema[column].dataType)))
    seen = Observation(f"slices-{uuid.uuid4().hex}")
    (void_to_string(checked).observe(seen, F.collect_set(text).alias("written"))
     .hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(staged_path(path, run)))
    return set(seen.get["written"] or [])


def publish_slices(spark: SparkSession, path: str, column: str, run: str, slices: Iterable[date | str],
                   written: Iterable[str]) -> None:
    """Put the staged state of some slices in the table's place: their new rows, or none.

    What is to be done is recorded first, in one atomic rename. A run that dies on the way leaves the record, and the
    next one finishes it: each step may be repeated, and slices that are through are left alone.
    """
    fs, target = _fs(spark, f"{path}/_intents/{run}.json")
    record = {"column": column, "run": run, "filled": sorted({str(s) for s in slices} & set(written)),
              "cleared": sorted({str(s) for s in slices} - set(written))}
    _, draft = _fs(spark, f"{path}/_intents/.{run}.tmp")
    out = fs.create(draft, True)
    out.write(json.dumps(record).encode())
    out.close()
    fs.rename(draft, target)
    _carry_out(spark, path, record)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finish what earlier runs recorded and did not complete, in their order. Returns their names.

    Writers of one table take turns; two at a time on the same slices are not told apart.
    """
    fs, root = _fs(spark, f"{path}/_intents")
    if not fs.exists(root):
        return []
    records = sorted(f.getPath().getName() for f in fs.listStatus(root) if f.getPath().getName().endswith(".json"))
    for name in records:
        stream = fs.open(_fs(spark, f"{path}/_intents/{name}")[1])
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        _carry_out(spark, path, json.loads(text))
    return [name.removesuffix(".json") for name in records]


def _carry_out(spark: SparkSession, path: str, record: dict) -> None:
    fs, _ = _fs(spark, path)
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    place = lambda root, name: _fs(spark, f"{root}/{record['column']}={escaped(name)}")[1]
    staged = staged_path(path, record["run"])
    for name in record["filled"]:
        if fs.exists(place(staged, name)):
            fs.delete(place(path, name), True)
            fs.rename(place(staged, name), place(path, name))
    for name in record["cleared"]:
        fs.delete(place(path, name), True)
    discard(spark, path, record["run"])
    fs.delete(_fs(spark, f"{path}/_intents/{record['run']}.json")[1], False)


def discard(spark: SparkSession, path: str, run: str) -> None:
    """Drop what a run has staged and not published."""
    fs, target = _fs(spark, staged_path(path, run))
    fs.delete(target, True)


def discard_unrecorded(spark: SparkSession, path: str, run: str) -> None:
    """Drop what a run has staged, unless a recorded intent still needs it."""
    if not exists(spark, f"{path}/_intents/{run}.json"):
        discard(spark, path, run)


def write_slices(df: DataFrame, path: str, column: str, slices: Iterable[date | str]) -> set[str]:
    """Replace exactly the named slices of a partitioned table; safe to repeat. Returns the slices that got rows.

    A named slice without rows is removed. Rows are staged, then published slice by slice behind a record of the
    intent, so a write that fails changes nothing and one that dies while publishing is finished by the next.
    """
    spark, names, run = df.sparkSession, list(slices), new_run()
    recover(spark, path)
    try:
        written = stage_slices(df, path, column, names, run)
    except Exception:
        discard(spark, path, run)
        raise
    publish_slices(spark, path, column, run, names, written)
    return written


def read_slices(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Partitioned table under its declared schema, also while it has no partitions yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else empty(spark, schema)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """Typed empty target, for the first run."""
    return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    void_to_string(df).write.mode("append").parquet(path)


class SnapshotTable:
    """A table replaced as a whole, whose next state may be computed from its current one.

    Every state is a numbered folder; the newest one Spark has marked complete is the table. Readers keep the
    state they started with, the schema may change from one state to the next, and a failed write is never seen.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _states(self) -> list[str]:
        fs, root = _fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        return sorted(f.getPath().getName() for f in fs.listStatus(root) if f.getPath().getName().startswith("state-"))

    def current(self) -> str | None:
        complete = [name for name in self._states() if exists(self.spark, f"{self.path}/{name}/_SUCCESS")]
        return complete[-1] if complete else None

    def read(self) -> DataFrame | None:
        name = self.current()
        return None if name is None else self.spark.read.parquet(f"{self.path}/{name}")

    def replace(self, df: DataFrame) -> DataFrame:
        states = self._states()
        number = int(states[-1].removeprefix("state-")) + 1 if states else 0
        void_to_string(df).write.parquet(f"{self.path}/state-{number:08d}")
        return self.read()


def advance_dimension(table: SnapshotTable, incoming: DataFrame, keys: Sequence[str], day: str | date) -> DataFrame:
    """Next state of a versioned dimension. A missing table, or one without version columns, is started afresh."""
    state = table.read()
    versioned = state is not None and is_versioned(state)
    return table.replace(scd2_apply(state, incoming, keys, day) if versioned else scd2_initial(incoming))
