"""Lists in one text, joined in order.

The text of a group is one value and comes together in one place, but its list need not. Rows
are dealt out by ranges of group and order; each range's part of a group is sorted and joined
to a text, and the parts, already in order, are joined by the number of their range. So a task
holds the list of one range, and of a hot group only the texts of its parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART, _TEXT = "_part", "_text"


def _joined(order: Sequence[str], text: str, separator: str) -> Column:
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias(_TEXT))))
    return F.array_join(listed[_TEXT], separator).alias(_TEXT)


def ordered_texts(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    text: str,
    separator: str,
    least: Mapping[str, Column] | None = None,
    most: Mapping[str, Column] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """``group`` with ``text``: the texts of its rows by ``order``, joined with ``separator``.

    ``least`` and ``most`` are further results, the least and the greatest of a value in the
    group. Null texts are left out. ``bounded`` says that no group is larger than what a task may
    hold, and that rows already lie by group: then they are joined where they are.
    """
    extremes = [(F.min, name, value) for name, value in (least or {}).items()]
    extremes += [(F.max, name, value) for name, value in (most or {}).items()]
    found = [fold(value).alias(name) for fold, name, value in extremes]
    if bounded:
        parts = rows.groupBy(*group).agg(_joined(order, text, separator), *found)
        return parts.withColumnRenamed(_TEXT, text)
    ranged = rows.repartitionByRange(*group, *order).withColumn(_PART, F.spark_partition_id())
    parts = ranged.groupBy(*group, _PART).agg(_joined(order, text, separator), *found)
    again = [fold(name).alias(name) for fold, name, _ in extremes]
    whole = parts.groupBy(*group).agg(_joined([_PART], _TEXT, separator), *again)
    return whole.withColumnRenamed(_TEXT, text)
