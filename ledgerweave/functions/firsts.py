"""Order-dependent "first" values without windows or sorted input.

``min`` over ``(position, value)`` pairs picks the value at the smallest position
and, unlike a window, combines on the map side: a hot group costs one row per
task. The pairs can be aggregated again at a coarser level.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_by(value: Column, *position: Column, skip_null: bool = True) -> Column:
    """Aggregate: the pair ``(position..., value)`` with the smallest position."""
    named = [p.alias(f"p{i}") for i, p in enumerate(position)]
    pair = F.struct(*named, value.alias("value"))
    return F.min(F.when(value.isNotNull(), pair) if skip_null else pair)


def first_value(value: Column, *position: Column) -> Column:
    """Aggregate: the first non-null ``value`` by ``position``."""
    return first_by(value, *position)["value"]
