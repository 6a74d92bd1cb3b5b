"""Checks of the declared input schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.functions.text import is_blank

SHOWN_CASES = 10


class SchemaViolations(ValueError):
    """A table breaks its declared schema; ``total`` cases, the first few in ``cases``."""

    def __init__(self, comp: Component, total: int, cases: list) -> None:
        listing = "\n".join(f"  {case.COLUMN}: {case.CHECK} ({case.VALUE!r})" for case in cases)
        super().__init__(
            f"{comp.code} schema check failed with {total:,} errors, the first ones:\n{listing}"
        )
        self.total = total
        self.cases = cases


def require_columns(df: DataFrame, comp: Component) -> None:
    """Raise ``ValueError`` unless every declared column is there."""
    missing = [name for name in comp.required if name not in df.columns]
    if missing:
        raise ValueError(f"{comp.code} table lacks the columns {missing}")


def _rules(comp: Component) -> list[tuple[str, str, Column]]:
    """``(column, check, broken)`` for every rule; ``broken`` is never null."""
    rules = [
        (name, "not null", F.col(name).isNull()) for name in ("DATALIB", "COMPANY", "DESCRIPTION")
    ]
    rules += [
        (name, "not blank", F.coalesce(is_blank(F.col(name).cast("string")), F.lit(False)))
        for name in ("DATALIB", "DESCRIPTION")
    ]
    for name in comp.flags:
        known = F.upper(F.col(name).cast("string")).isin("J", "N")
        rules.append((name, "J or N", F.coalesce(~known, F.lit(False))))
    return rules


def schema_violations(df: DataFrame, comp: Component, ordinal: str = "_ord") -> DataFrame:
    """One row ``(ordinal, COLUMN, CHECK, VALUE)`` per broken rule, in a single pass."""
    cases = [
        F.when(
            broken,
            F.struct(
                F.lit(name).alias("COLUMN"),
                F.lit(check).alias("CHECK"),
                F.col(name).cast("string").alias("VALUE"),
            ),
        )
        for name, check, broken in _rules(comp)
    ]
    return df.select(ordinal, F.explode(F.array_compact(F.array(*cases))).alias("case")).select(
        ordinal, "case.*"
    )


def violation_figures(comp: Component) -> dict[str, Column]:
    """One aggregate per rule, named after column and check: the rows that break it."""
    return {f"{name} {check}": F.count_if(broken) for name, check, broken in _rules(comp)}


def require_none(
    found: Mapping[str, int], df: DataFrame, comp: Component, ordinal: str = "_ord"
) -> None:
    """Raise :class:`SchemaViolations` if the figures ``found`` in ``df`` show any case.

    Only then is ``df`` read, for the first cases.
    """
    total = sum(found.values())
    if total:
        first = schema_violations(df, comp, ordinal).orderBy(ordinal, "COLUMN", "CHECK").limit(SHOWN_CASES)
        raise SchemaViolations(comp, total, first.collect())


def require_valid(df: DataFrame, comp: Component, ordinal: str = "_ord") -> None:
    """Check the whole table in one job; raise :class:`SchemaViolations` on any case."""
    figures = [column.alias(name) for name, column in violation_figures(comp).items()]
    require_none(df.agg(*figures).first().asDict(), df, comp, ordinal)
