"""Joins that stand keys holding much of the data.

Adaptive execution splits a skewed partition of a join only when both inputs come
straight from a shuffle, and in a left join only on the left side. These helpers
give it plans it can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffle_anew(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the same text ``key``, in a form it is not yet partitioned by.

    A side just grouped by the key would enter the join straight from its
    aggregate, and then neither side is split. Such a side has one row per key, so
    that its second shuffle is the cheap part of the join.
    """
    return df.withColumn(key, F.concat(key, F.lit("")))


def even_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` left-joined to ``right`` on text ``key``, which both may repeat.

    The matches come from an inner join, where either side can be split; the rows
    without one are added by an anti join on the distinct keys.
    """
    left = shuffle_anew(left, key)
    matched = left.join(right, key)
    alone = left.join(shuffle_anew(right.select(key).distinct(), key), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
