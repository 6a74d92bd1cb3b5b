"""What the operators share: reading tables and running Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerweave.storage import materialise

__all__ = ["add_columns", "bit_table", "column", "giving_back", "in_table", "map_batches", "materialise", "table"]

TABLE_BITS = 1 << 25  # of a bit table, 4 MB however many keys there are
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000  # texts that travel to a Python worker together, unless the session says otherwise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _small_batches(spark: SparkSession) -> None:
    """Spark's own batches are made for numbers: ten thousand texts fill both ends of the pipe."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` on batches, after which the memory it freed goes back to the system.

    Python workers outlive their tasks, and each stage with several of them in a row leaves
    more; without this every one keeps the most that any task took.
    """

    @wraps(run)
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def map_batches(
    df: DataFrame, schema: str | StructType, start: Callable[[], Callable], rows: int = 1 << 30
) -> DataFrame:
    """Rows made from Arrow batches.

    ``start()`` runs once per task, so that it can load a model; what it returns
    takes a batch, of ``rows`` rows at most, and returns the columns of the result.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                made = work(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    _small_batches(df.sparkSession)
    return df.mapInArrow(giving_back(run), schema)


def add_columns(df: DataFrame, made: StructType, start: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns ``made``; columns of these names (in any case) are replaced."""
    names = {name.lower() for name in made.names}
    kept = [field for field in df.schema.fields if field.name.lower() not in names]

    def begin() -> Callable:
        work = start()

        def step(batch: pa.RecordBatch) -> dict:
            return {field.name: column(batch, field.name) for field in kept} | work(batch)

        return step

    return map_batches(df, StructType(kept + made.fields), begin)


def bit_table(keys: DataFrame, key: str) -> np.ndarray:
    """A bit table of the values of a long column, by their hash.

    It lets through all keys and a few others, more of them the more keys there are; so
    it only ever saves work ahead of a join.
    """
    words = (
        keys.select(F.pmod(F.xxhash64(key), F.lit(TABLE_BITS)).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits"))
    )
    found = np.zeros(TABLE_BITS // 64, np.int64)
    for word, bits in words.toLocalIterator():
        found[word] = bits
    return found.view(np.uint64)


def in_table(df: DataFrame, key: str, bits: np.ndarray, inside: bool = True) -> DataFrame:
    """The rows whose ``key`` may be in a bit table, or those where it cannot be."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    place = "_place"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = column(batch, place).to_numpy().astype(np.uint64)
            hit = (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
            yield batch.filter(pa.array(hit == inside)).drop_columns([place])

    placed = df.withColumn(place, F.pmod(F.xxhash64(key), F.lit(TABLE_BITS)))
    return placed.mapInArrow(giving_back(run), df.schema)
