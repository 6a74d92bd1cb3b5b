"""Which ledger rows take part in the comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import Component

# Descriptions of unused entries (the word is Dutch for "empty"),
# and the flag value that excludes a row, in both cases.
EMPTY_DESCRIPTIONS = ("", "leeg")
EXCLUDED_FLAG = ("J", "j")
FLAGS = ("DOORTREK_JN", "VERDREK_JN")


@dataclass(frozen=True)
class FilterRules:
    """Parameters of the filter; empty lists and ``None`` switch a rule off.

    ``as_of`` is the moment recency is counted back from. It defaults to the
    moment the rules are created; give it to make runs repeatable.
    """

    datalibs: Sequence[str] = ()
    companies: Sequence[str] = ()
    lastused_days: int | None = None
    excluded_flags: Sequence[str] = FLAGS
    as_of: datetime | None = None

    def __post_init__(self) -> None:
        for name in ("datalibs", "companies", "excluded_flags"):
            if isinstance(getattr(self, name), str):
                raise ValueError(f"{name} must be a list")
            object.__setattr__(self, name, tuple(str(v) for v in getattr(self, name)))
        unknown = set(self.excluded_flags) - set(FLAGS)
        if unknown:
            raise ValueError(f"unknown flags: {', '.join(sorted(unknown))}")
        if self.lastused_days is not None:
            if self.lastused_days < 1:
                raise ValueError("lastused_days must be at least 1")
            if self.as_of is None:
                object.__setattr__(self, "as_of", datetime.now())


class Split(NamedTuple):
    """Kept rows, rejected rows and the one-row counters over both."""

    cleaned: DataFrame
    filtered: DataFrame
    counts: DataFrame


def _excluded(flag: str) -> Column:
    return F.col(flag).isNotNull() & F.col(flag).isin(*EXCLUDED_FLAG)


def keep_rule(df: DataFrame, comp: Component, rules: FilterRules) -> Column:
    """Condition a kept row meets; null, like false, means rejected."""
    tests = [
        F.col("DESCRIPTION").isNotNull(),
        ~F.lower("DESCRIPTION").isin(*EMPTY_DESCRIPTIONS),
    ]
    if rules.datalibs:
        tests.append(F.col("DATALIB").isin(*rules.datalibs))
    if rules.companies:
        tests.append(F.col("COMPANY").cast("string").isin(*rules.companies))
    if rules.lastused_days is not None and "LASTUSED_DATE" in df.columns:
        cutoff = rules.as_of - timedelta(days=rules.lastused_days)
        tests.append(
            F.col("LASTUSED_DATE") >= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")
        )
    tests += [
        ~_excluded(flag)
        for flag in comp.flags
        if flag in df.columns and flag in rules.excluded_flags
    ]
    return reduce(and_, tests)


def keep_reject(df: DataFrame, comp: Component, rules: FilterRules | None = None) -> Split:
    """Split ``df`` into kept and rejected rows.

    The kept side is a plain conjunction, so tests on stored columns reach a
    parquet scan; the rejected side also takes the rows where the condition is
    null. The counters need one aggregate. Flag counters cover all rows, whatever
    else removed them and whether or not the flag rule is on.
    """
    rule = keep_rule(df, comp, rules or FilterRules())
    keep = F.coalesce(rule, F.lit(False))
    counts = df.agg(
        *(column.alias(name) for name, column in filter_figures(df, comp, rules).items())
    )
    return Split(df.filter(rule), df.filter(~keep), counts)


def filter_figures(
    df: DataFrame, comp: Component, rules: FilterRules | None = None
) -> dict[str, Column]:
    """The counters of :func:`keep_reject` as aggregates over all rows."""
    keep = F.coalesce(keep_rule(df, comp, rules or FilterRules()), F.lit(False))
    found = {"Removed": F.count_if(~keep), "Kept": F.count_if(keep)}
    for flag in comp.flags:
        excluded = _excluded(flag) if flag in df.columns else F.lit(False)
        found[f"Removed_{flag.removesuffix('_JN')}"] = F.count_if(excluded)
    return found
