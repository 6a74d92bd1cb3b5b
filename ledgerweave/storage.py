"""Intermediate tables that several results read.

A table that is asked for one key again and again is stored in buckets of that key: what groups
or joins by it later finds the rows of a key together and needs no shuffle. Keys that hold too
many rows for one task are kept apart, as plain files that any number of tasks read, so that
they are still combined ahead of a shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from typing import NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Made = TypeVar("Made")

# Rows of one key that a task reads without trouble.
HOT_ROWS = 100_000
CHECKPOINT_DIR = "spark.checkpoint.dir"
# Folders of local sessions that name none, by application.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="ledgerweave-")
    return _own_folders[context.applicationId]


class _Scope(NamedTuple):
    """Where the tables of an open scope lie, and which of them the catalog knows."""

    folder: str
    tables: list[str]


_scope: ContextVar[_Scope | None] = ContextVar("intermediates", default=None)


def _base(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/ledgerweave"


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """A scope for intermediate tables: they lie in one folder and go when it ends, on failure too.

    Results made within read these tables, so read or write them before the scope ends. Result
    tables that a run or a merge published stay. A scope within another has a folder of its own.
    A process that is killed cannot clear its folder; the folder's name is what the scope gives,
    to be cleared by whoever notices.
    """
    scope = _Scope(f"{_base(spark)}/{uuid.uuid4().hex}", [])
    outer = _scope.set(scope)
    try:
        yield scope.folder
    finally:
        _scope.reset(outer)
        for name in scope.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, scope.folder)


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has used yet, within the open scope if there is one."""
    scope = _scope.get()
    return f"{_base(spark) if scope is None else scope.folder}/{uuid.uuid4().hex}"


def _reached(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _reached(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    files, place = _reached(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to one that does not exist; one step where the file system has such a step."""
    files, place = _reached(spark, path)
    if exists(spark, target) or not files.rename(place, _reached(spark, target)[1]):
        raise FileExistsError(f"[RESULT_ALREADY_EXISTS] cannot move results to {target}")


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to ``path``, or to a new table in the shared folder, and read it back.

    Cuts the lineage, outlives lost executors, and unlike a checkpoint keeps the
    columns apart: each reader scans only what it needs and the planner knows
    the size. Existing tables are never overwritten.
    """
    spark = df.sparkSession
    path = path or new_path(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_passing(
    df: DataFrame, figures: Mapping[str, Column], write: Callable[[DataFrame], Made]
) -> tuple[Made, dict[str, int]]:
    """What ``write`` makes of ``df``, and aggregates over the rows of ``df`` it read for that.

    The aggregates cost no scan of their own. ``write`` has to run one action over all rows, first
    thing, and may filter and project but not shuffle them: Spark then takes the figures of each
    task of the last stage once, however often executors are lost and tasks repeated.
    """
    seen = Observation()
    made = write(df.observe(seen, *(column.alias(name) for name, column in figures.items())))
    return made, seen.get


def one_row(spark: SparkSession, figures: Mapping[str, int]) -> DataFrame:
    """Known figures as a table of one row."""
    return spark.range(1).select(
        *(F.lit(value).cast("bigint").alias(name) for name, value in figures.items())
    )


class Keyed(NamedTuple):
    """A stored table: its rows in buckets of a key, and those of hot keys, if there are any."""

    regular: DataFrame
    hot: DataFrame | None

    def each(self, make: Callable[[DataFrame, bool], DataFrame]) -> list[DataFrame]:
        """What ``make(rows, bounded)`` makes of each part; ``bounded`` is true of the regular one."""
        made = [make(self.regular, True)]
        return made if self.hot is None else [*made, make(self.hot, False)]

    def union(self, make: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
        """The same in one table: the result of an operator that looks at each key alone."""
        return reduce(DataFrame.unionByName, self.each(make))


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_by_key(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> Keyed:
    """Store ``df`` in as many buckets of ``key`` as there are shuffle partitions.

    Keys with more than ``hot_rows`` rows are hot, the most frequent ones, at most one a bucket.
    ``df`` is read twice, the first time only for its keys.
    """
    spark = df.sparkSession
    buckets = _buckets(spark)
    frequent = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    names = [row[key] for row in frequent.orderBy(F.desc("_rows"), key).limit(buckets).collect()]
    names = [name for name in names if name is not None]
    hot = None
    if names:
        # No more names than buckets.
        listed = spark.createDataFrame([(name,) for name in names], df.select(key).schema)
        hot = materialise(df.join(F.broadcast(listed), key, "left_semi").select(*df.columns))
        df = df.join(F.broadcast(listed), key, "left_anti").select(*df.columns)
    return Keyed(store_in_buckets([df.repartition(buckets, key)], key), hot)


def store_in_buckets(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Write ``parts`` of one table to buckets of ``key`` and read it back.

    What was made of a bucketed part lies by bucket already and is written without a shuffle.
    The first part should be such; others are small ones.
    """
    first, *rest = parts
    spark = first.sparkSession
    path, buckets = new_path(spark), _buckets(spark)
    name = f"ledgerweave_{path.rpartition('/')[2]}"
    scope = _scope.get()
    if scope is not None:
        scope.tables.append(name)
    first.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    for part in rest:
        placed = part.select(*first.columns).repartition(buckets, key)
        placed.write.mode("append").format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)
