"""Who uses a number: its first holder, and the first one beside that.

A description collides with a number that another description holds. The first holder says so
to every description but itself, and to that one the second holder does. So two holders are
all that is ever asked, whatever their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def two_holders(
    rows: DataFrame, group: Sequence[str], key: str, ordinal: str, *payload: str
) -> DataFrame:
    """``group`` with ``first`` and ``second``, the holders ``(at, key, *payload)`` with the least positions.

    A holder is a distinct ``key`` at its first position; ``second`` is null where there is
    only one. Rows are folded to one a holder, and every task keeps two holders a group before
    they are shuffled by group, so a group costs two rows a task.
    """
    holder = F.struct(F.col(ordinal).alias("at"), key, *payload)
    folded = rows.groupBy(*group, key).agg(F.min(holder).alias("_holder"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_holder"))
    two = folded.select(*group, "_holder", rank.alias("_rank")).filter(F.col("_rank") <= 2)
    second = F.when(F.count(F.lit(1)) > 1, F.max("_holder"))
    return two.groupBy(*group).agg(F.min("_holder").alias("first"), second.alias("second"))


def rival(first: Column, second: Column, key: str) -> Column:
    """The holder that ``key`` collides with; null when only ``key`` itself, or nobody, is one."""
    return F.when(first[key] != F.col(key), first).otherwise(second)
