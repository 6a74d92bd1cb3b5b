"""Environments as bits.

Sets of environments are what presence and gaps are about. Numbering the
environments turns a set into one long per chunk of 63: it aggregates with
``bit_or``, takes eight bytes, and answers "is it in there" and "which of the
members is it" in one step, however many environments there are.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions.text import env_company, env_datalib
from ledgerweave.storage import materialise

CHUNK, BIT = "_chunk", "_bit"
# Bits of a non-negative long.
CHUNK_SIZE = 63
# Up to this many environments their table is small enough to broadcast.
BROADCAST_LIMIT = 50_000


class Axis(NamedTuple):
    """The numbered environments.

    ``frame`` has ``ENV``, its chunk and bit, and any further columns. ``few``
    says whether it may be broadcast.
    """

    frame: DataFrame
    size: int
    chunk_size: int
    few: bool

    @property
    def chunks(self) -> int:
        return max(1, -(-self.size // self.chunk_size))

    def locate(self, df: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
        """``df`` with chunk and bit of its ``ENV``, and ``columns`` of the axis."""
        side = self.frame.select("ENV", CHUNK, BIT, *columns)
        return df.join(F.broadcast(side) if self.few else side, "ENV", how)

    def with_names(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_names``, the ``ENV, DATALIB, COMPANY`` of its chunk by bit."""
        env = F.col("ENV")
        parts = env_datalib(env).alias("DATALIB"), env_company(env).alias("COMPANY")
        listed = F.collect_list(F.struct(BIT, F.struct("ENV", *parts).alias("name")))
        names = self.frame.groupBy(CHUNK).agg(F.array_sort(listed)["name"].alias("_names"))
        return df.join(F.broadcast(names) if self.few else names, CHUNK)

    def full(self) -> Column:
        """The set of all environments of a chunk."""
        last = self.size - (self.chunks - 1) * self.chunk_size
        return F.when(F.col(CHUNK) == self.chunks - 1, F.lit((1 << last) - 1)).otherwise(
            F.lit((1 << self.chunk_size) - 1)
        )


def named_axis(
    spark: SparkSession, rows: list[tuple], schema: str = "ENV string", chunk_size: int = CHUNK_SIZE
) -> Axis:
    """Number ``rows``, which start with the environment and come in order."""
    numbered = [(*row, i // chunk_size, i % chunk_size) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, f"{schema}, {CHUNK} int, {BIT} int")
    return Axis(frame, len(rows), chunk_size, True)


def numbered_axis(
    frame: DataFrame, chunk_size: int = CHUNK_SIZE, broadcast_limit: int = BROADCAST_LIMIT
) -> Axis:
    """Number the distinct ``ENV`` of ``frame`` in order without bringing them together.

    They are stored by range, each with its place in its range. Only the sizes of the ranges, at
    most one a shuffle partition, come to the driver; the rest is a projection. Up to
    ``broadcast_limit`` environments may be broadcast, joins with more are left to Spark.
    """
    place = F.monotonically_increasing_id()  # the partition above 33 bits of the row's place in it
    ranges = frame.repartitionByRange("ENV").sortWithinPartitions("ENV")
    stored = materialise(ranges.withColumn("_place", place))
    part = F.shiftright("_place", 33).cast("int")
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).collect()
    starts, size = [0] * (1 + max((row.part for row in sizes), default=0)), 0
    for row in sorted(sizes):
        starts[row.part], size = size, size + row["size"]
    index = F.get(F.lit(starts).cast("array<bigint>"), part) + F.col("_place").bitwiseAND((1 << 33) - 1)
    numbered = stored.withColumns(
        {CHUNK: F.floor(index / chunk_size).cast("int"), BIT: (index % chunk_size).cast("int")}
    )
    return Axis(numbered.drop("_place"), size, chunk_size, size <= broadcast_limit)


def sparse_set(chunk: Column, members: Column) -> Column:
    """Aggregate: the sets of the chunks that have members, in order."""
    return F.array_sort(F.collect_list(F.struct(chunk.alias("chunk"), members.alias("members"))))


def each_chunk(df: DataFrame, sparse: str, axis: Axis, members: str) -> DataFrame:
    """One row per row of ``df`` and chunk of the axis, with the ``members`` that ``sparse`` has there.

    Every listed chunk brings the empty ones ahead of it, the end of the axis those after the last,
    so that the work is what comes out, with nothing to look up.
    """
    end = F.struct(F.lit(axis.chunks).alias("chunk"), F.lit(0).cast("bigint").alias("members"))
    listed = F.concat(F.coalesce(F.col(sparse), F.array()), F.array(end))
    runs = F.transform(
        "_listed",
        lambda item, i: F.struct(
            F.coalesce(F.get("_listed", i - 1)["chunk"] + 1, F.lit(0)).alias("start"), item.alias("item")
        ),
    )
    run, item = F.col("_run"), F.col("_run.item")
    last = F.least(item["chunk"], F.lit(axis.chunks - 1))
    return (
        df.withColumn("_listed", listed)
        .withColumn("_run", F.explode(runs))
        .filter(run["start"] <= last)
        .withColumn(CHUNK, F.explode(F.sequence(run["start"], last)))
        .withColumn(members, F.when(F.col(CHUNK) == item["chunk"], item["members"]).otherwise(F.lit(0)))
        .drop("_listed", "_run", sparse)
    )


def single(bit: Column) -> Column:
    """The set with one member."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def has(members: Column, bit: Column) -> Column:
    """Whether ``bit`` is in ``members``; null sets have none."""
    return F.coalesce(members.bitwiseAND(single(bit)) != 0, F.lit(False))


def entry(entries: Column, members: Column, bit: Column) -> Column:
    """The one of ``entries`` that belongs to ``bit``; null when it is not in ``members``.

    ``entries`` hold one element per member, in bit order.
    """
    rank = F.bit_count(members.bitwiseAND(single(bit) - 1))
    return F.when(has(members, bit), F.get(entries, rank))
