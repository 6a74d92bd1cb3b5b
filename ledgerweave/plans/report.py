"""Small tables that describe a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.operators.gaps import CREATE, REVIEW
from ledgerweave.storage import one_row


def _rows(one_row: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` rows from the columns of a one-row table."""
    pairs = F.array(
        *(F.struct(F.lit(name).alias(key), F.col(name).alias(value)) for name in one_row.columns)
    )
    return one_row.select(F.inline(pairs))


def filter_summary(counts: DataFrame) -> DataFrame:
    """``(Filter, Count)`` rows of the filter counters."""
    return _rows(counts, "Filter", "Count")


def run_summary(
    comp: Component,
    counts: DataFrame,
    cells: DataFrame,
    action_counts: DataFrame,
    number_mismatches: DataFrame,
    type_mismatches: DataFrame,
    run_ts: str | None = None,
) -> DataFrame:
    """The headline figures as ``(Metric, Value)`` text rows, in report order.

    Each source is reduced to one row before the figures are put together.
    Without ``run_ts`` the time stamp row is left out.
    """
    return _in_order(
        [
            *_ledger_parts(comp, counts, cells, run_ts),
            action_counts.select(
                *_figures({"Create Actions": F.col(CREATE), "Review Actions": F.col(REVIEW)})
            ),
            number_mismatches.agg(*_figures({"Number Mismatches": F.count(F.lit(1))})),
            type_mismatches.agg(*_figures({"Type Mismatches": F.count(F.lit(1))})),
        ]
    )


def written_summary(
    comp: Component,
    counts: DataFrame,
    cells: DataFrame,
    written: Mapping[str, int],
    run_ts: str | None = None,
) -> DataFrame:
    """:func:`run_summary` for a run that has ``written`` its tables: their numbers of rows."""
    known = one_row(cells.sparkSession, written)
    return _in_order(
        [
            *_ledger_parts(comp, counts, cells, run_ts),
            known.select(*_figures({name: F.col(name) for name in written})),
        ]
    )


def _ledger_parts(
    comp: Component, counts: DataFrame, cells: DataFrame, run_ts: str | None
) -> list[DataFrame]:
    # Metric names, in report order.
    head = {"Component": F.lit(comp.code)}
    if run_ts is not None:
        head["Run Timestamp"] = F.lit(run_ts)
    flags = {
        f"Removed {flag.removesuffix('_JN')}": F.col(f"Removed_{flag.removesuffix('_JN')}")
        for flag in comp.flags
    }
    return [
        counts.select(
            *_named(head),
            *_figures(
                {
                    "Rows Loaded": F.col("Kept") + F.col("Removed"),
                    "Rows Kept": F.col("Kept"),
                    "Rows Removed": F.col("Removed"),
                    **flags,
                }
            ),
        ),
        cells.agg(
            *_figures(
                {
                    "Environments": F.count_distinct("ENV"),
                    "Unique Descriptions": F.count_distinct("DESC_KEY"),
                }
            )
        ),
    ]


def _in_order(parts: Sequence[DataFrame]) -> DataFrame:
    rows = [
        _rows(part, "Metric", "Value").withColumn("_part", F.lit(i)) for i, part in enumerate(parts)
    ]
    # A dozen rows: one partition holds them, in order.
    return reduce(DataFrame.unionAll, rows).coalesce(1).sortWithinPartitions("_part").drop("_part")


def _named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _figures(columns: Mapping[str, Column]) -> list[Column]:
    return [F.format_number(column, 0).alias(name) for name, column in columns.items()]


def config_echo(spark: SparkSession, parameters: Mapping[str, object]) -> DataFrame:
    """One row holding the parameters of a run as text."""
    texts = {
        name: ",".join(map(str, value)) if isinstance(value, (list, tuple)) else value
        for name, value in parameters.items()
    }
    columns = [
        F.lit(None if value is None else str(value)).cast("string").alias(name)
        for name, value in texts.items()
    ]
    return spark.range(1).select(*columns)
