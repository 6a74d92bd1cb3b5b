"""Which description exists in which environment.

The long form, one row per present ``(DESC_KEY, ENV)``, is the working result.
The wide matrices have one column set per environment and are made from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.functions.firsts import first_by, first_value
from ledgerweave.operators.axis import (
    BIT,
    CHUNK,
    CHUNK_SIZE,
    Axis,
    entry,
    has,
    named_axis,
    numbered_axis,
    single,
)
from ledgerweave.operators.joins import shuffle_anew

CELL = ("DESC_KEY", "ENV")
# Columns a wide matrix may have at most per kind; shards and the long form have no such limit.
WIDE_LIMIT = 10_000
# Environments of a shard, in chunks.
SHARD_CHUNKS = 16


def presence_cells(cleaned: DataFrame, comp: Component, ordinal: str = "_ord") -> DataFrame:
    """One row per present ``(DESC_KEY, ENV)``.

    Carries the number of rows, the first non-null value of each attribute and,
    in ``_described``, the position of the first description, which lets coarser
    levels pick their own first without the ledger. One shuffle; rows of a hot
    cell combine before it.
    """
    order = F.col(ordinal)
    picks = [
        first_value(F.col(name), order).alias(name)
        for name in comp.attributes
        if name != "DESCRIPTION" and name in cleaned.columns
    ]
    return (
        cleaned.groupBy(*CELL)
        .agg(
            F.count(F.lit(1)).alias("Rows"),
            first_by(F.col("DESCRIPTION"), order).alias("_described"),
            *picks,
        )
        .withColumn("DESCRIPTION", F.col("_described.value"))
    )


def presence_totals(cells: DataFrame) -> DataFrame:
    """``DESC_KEY, DESCRIPTION, Count_Present, Pct_Present`` for every description."""
    total = cells.agg(F.count_distinct("ENV")).scalar()
    present = F.count(F.lit(1))
    return (
        cells.groupBy("DESC_KEY")
        .agg(F.min("_described")["value"].alias("DESCRIPTION"), present.alias("Count_Present"))
        .withColumn("Pct_Present", _share(F.col("Count_Present"), total))
    )


def environments(cells: DataFrame, limit: int = WIDE_LIMIT) -> list[str]:
    """Sorted environment names, brought to the driver to become columns.

    More than ``limit`` raise ``ValueError`` before they are all fetched.
    """
    found = few_environments(cells, limit)
    if found is None:
        raise ValueError(f"more than {limit:,} environments: use shards or the long form instead")
    return found


def few_environments(cells: DataFrame, limit: int = WIDE_LIMIT) -> list[str] | None:
    """Sorted environment names, or None if there are more than ``limit``."""
    found = cells.select("ENV").distinct().limit(limit + 1).collect()
    return sorted(row.ENV for row in found) if len(found) <= limit else None


def presence_binary(cells: DataFrame, envs: list[str]) -> DataFrame:
    """``DESC_KEY`` and a 0/1 column for each of the :func:`environments` of ``cells``."""
    axis = named_axis(cells.sparkSession, [(env,) for env in envs])
    wide = _by_chunk(cells, axis, {})
    return wide.select("DESC_KEY", *_marks(envs, axis))


def language_variants(cleaned: DataFrame) -> DataFrame:
    """The distinct long descriptions of every ``DESC_KEY``, null included."""
    return cleaned.select("DESC_KEY", "DESCRIPTION_LANG").distinct()


def presence_enriched(
    cells: DataFrame, comp: Component, envs: list[str], languages: DataFrame | None = None
) -> DataFrame:
    """The binary matrix with descriptions, numbers and totals.

    Accounts get a number and a type column per environment. Cost centers get a
    number column, and with ``languages`` (the :func:`language_variants` of the
    same ledger) one row per language variant of a description.
    """
    axis = named_axis(cells.sparkSession, [(env,) for env in envs])
    values = [name for name in (comp.number, comp.category) if name]
    wide = _by_chunk(
        cells,
        axis,
        {
            "_values": F.array_sort(F.collect_list(F.struct(BIT, *values))),
            "_described": F.min("_described"),
        },
    )

    def across(name: str, prefix: str) -> list[Column]:
        return [
            entry(_part("_values", chunk), _part("_set", chunk), F.lit(bit))[name].alias(
                f"{prefix}{env}"
            )
            for env, chunk, bit in _places(envs, axis)
        ]

    counts = [
        F.coalesce(F.bit_count(_part("_set", chunk)), F.lit(0)) for chunk in range(axis.chunks)
    ]
    present = reduce(add, counts).cast("bigint")
    described = F.array_min(
        F.array(*(_part("_described", chunk) for chunk in range(axis.chunks)))
    )
    numbers = across(comp.number, comp.number_prefix)
    share = _share(present, F.lit(len(envs)))
    totals = [present.alias("Count_Present"), share.alias("Pct_Present")]
    lead = [described["value"].alias("DESCRIPTION"), *_marks(envs, axis)]
    if comp.category:
        pairs = [c for pair in zip(numbers, across(comp.category, "Type_")) for c in pair]
        return wide.select("DESC_KEY", *lead, *pairs, *totals)
    if languages is None:
        return wide.select("DESC_KEY", *lead, *totals, *numbers)
    # Both sides stem from one ledger, so no key goes unmatched; an inner join lets
    # adaptive execution split a key with very many variants.
    return shuffle_anew(wide, "DESC_KEY").join(languages, "DESC_KEY").select(
        "DESC_KEY", *lead, *totals, "DESCRIPTION_LANG", *numbers
    )


class Shard(NamedTuple):
    """The columns of some environments, for every description."""

    number: int
    envs: list[str]
    binary: DataFrame
    enriched: DataFrame


def presence_shards(
    cells: DataFrame, comp: Component, chunks: int = SHARD_CHUNKS, chunk_size: int = CHUNK_SIZE
) -> Iterator[Shard]:
    """The wide matrices in vertical shards, for any number of environments.

    Shards come in order of the environments, ``chunks`` times ``chunk_size`` of them each, the last
    one fewer. Side by side, joined on ``DESC_KEY``, their columns are those of the matrices; what is
    not of an environment is in :func:`presence_totals`. Only the names of one shard at a time are
    brought to the driver.
    """
    axis = numbered_axis(cells.select("ENV").distinct(), chunk_size)
    values = [name for name in (comp.number, comp.category) if name]
    prefixes = dict(zip(values, (comp.number_prefix, "Type_")))
    for number, first in enumerate(range(0, axis.chunks, chunks)):
        named = axis.frame.filter(F.col(CHUNK).between(first, first + chunks - 1))
        envs = sorted(row.ENV for row in named.select("ENV").collect())
        own = named_axis(cells.sparkSession, [(env,) for env in envs], chunk_size=chunk_size)
        listed = F.array_sort(F.collect_list(F.when(F.col(BIT).isNotNull(), F.struct(BIT, *values))))
        marks = _marks(envs, own)
        entries = [
            entry(_part("_values", chunk), _part("_set", chunk), F.lit(bit))[name].alias(f"{prefixes[name]}{env}")
            for env, chunk, bit in _places(envs, own)
            for name in values
        ]
        binary = _by_chunk(cells, own, {}, every=True).select("DESC_KEY", *marks)
        enriched = _by_chunk(cells, own, {"_values": listed}, every=True)
        yield Shard(number, envs, binary, enriched.select("DESC_KEY", *marks, *entries))


def shard_index(shards: list[tuple[int, list[str]]], comp: Component, spark: SparkSession) -> DataFrame:
    """``SHARD, ENV, COLUMN``: which shard has a column, and of which environment it is."""
    prefixes = ["", comp.number_prefix, *(["Type_"] if comp.category else [])]
    listed = spark.createDataFrame(shards, "SHARD int, ENVS array<string>")
    columns = F.array(*(F.concat(F.lit(prefix), "ENV") for prefix in prefixes))
    by_env = listed.select("SHARD", F.explode("ENVS").alias("ENV"))
    return by_env.select("SHARD", "ENV", F.explode(columns).alias("COLUMN"))


def _by_chunk(
    cells: DataFrame, axis: Axis, aggregates: dict[str, Column], every: bool = False
) -> DataFrame:
    """One row per description with a set of environments, and ``aggregates``, per chunk.

    Only chunks are pivoted, one for 63 environments; the columns of the single
    environments are then read off the sets. ``every`` keeps descriptions that none of the
    axis' environments has.
    """
    named = {"_set": F.bit_or(single(F.col(BIT))), **aggregates}
    return (
        axis.locate(cells, how="left" if every else "inner")
        .groupBy("DESC_KEY", CHUNK)
        .agg(*(value.alias(name) for name, value in named.items()))
        .groupBy("DESC_KEY")
        .agg(
            *(
                F.first(F.when(F.col(CHUNK) == chunk, F.col(name)), ignorenulls=True).alias(
                    f"{name}_{chunk}"
                )
                for chunk in range(axis.chunks)
                for name in named
            )
        )
    )


def _part(name: str, chunk: int) -> Column:
    return F.col(f"{name}_{chunk}")


def _places(envs: list[str], axis: Axis) -> list[tuple[str, int, int]]:
    return [(env, *divmod(i, axis.chunk_size)) for i, env in enumerate(envs)]


def _marks(envs: list[str], axis: Axis) -> list[Column]:
    return [
        has(_part("_set", chunk), F.lit(bit)).cast("int").alias(env)
        for env, chunk, bit in _places(envs, axis)
    ]


def _share(present: Column, environment_count: Column) -> Column:
    return F.bround(present / F.greatest(environment_count, F.lit(1)) * 100, 1)
