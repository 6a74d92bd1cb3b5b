"""Descriptions that carry several numbers or several types.

The long form, one row per description, value and environment, is the result that has
no limits. The text form joins a description's rows into one value, which has to come
together in one place; it is one row per description whatever their number, joined part by
part, so that no task holds the list of a description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.functions.firsts import first_by
from ledgerweave.functions.numbers import format_number
from ledgerweave.functions.text import null_like_to_null, strip
from ledgerweave.operators.texts import ordered_texts


def _valued(cleaned: DataFrame, column: str, value: Column, ordinal: str) -> DataFrame:
    """``DESC_KEY, VALUE, ENV, POSITION, DESCRIPTION`` of the rows that have a value."""
    return cleaned.filter(F.col(column).isNotNull()).select(
        "DESC_KEY", value.alias("VALUE"), "ENV", F.col(ordinal).alias("POSITION"), "DESCRIPTION"
    )


def _numbers(cleaned: DataFrame, comp: Component, ordinal: str) -> DataFrame:
    return _valued(cleaned, comp.number, format_number(F.col(comp.number)), ordinal)


def _types(cleaned: DataFrame, comp: Component, ordinal: str) -> DataFrame:
    category = F.col(comp.category)
    typed = cleaned.filter(null_like_to_null(category).isNotNull())
    return _valued(typed, comp.category, strip(category), ordinal)


def number_details(cleaned: DataFrame, comp: Component, ordinal: str = "_ord") -> DataFrame:
    """``DESC_KEY, VALUE, ENV, POSITION`` where one description has several numbers."""
    return _differing(_numbers(cleaned, comp, ordinal))


def type_details(cleaned: DataFrame, comp: Component, ordinal: str = "_ord") -> DataFrame:
    """``DESC_KEY, VALUE, ENV, POSITION`` where one description has several types."""
    if comp.category is None:
        schema = "DESC_KEY string, VALUE string, ENV string, POSITION bigint"
        return cleaned.sparkSession.createDataFrame([], schema)
    return _differing(_types(cleaned, comp, ordinal))


def _differing(valued: DataFrame) -> DataFrame:
    """One row per distinct value and environment; ``POSITION`` is where it is seen first."""
    details = valued.groupBy("DESC_KEY", "VALUE", "ENV").agg(F.min("POSITION").alias("POSITION"))
    several = details.groupBy("DESC_KEY").agg(
        (F.min("VALUE") < F.max("VALUE")).alias("_differ")
    )
    return details.join(several.filter("_differ"), "DESC_KEY").select(
        "DESC_KEY", "VALUE", "ENV", "POSITION"
    )


def number_mismatches(
    cleaned: DataFrame, comp: Component, ordinal: str = "_ord", bounded: bool = False
) -> DataFrame:
    """``DESCRIPTION, Details`` where one description has several numbers.

    ``bounded`` says that the ledger is stored by description and none of them is hot.
    """
    detail = F.concat("VALUE", F.lit(" ("), "ENV", F.lit(")"))
    return _report(_numbers(cleaned, comp, ordinal), detail, ", ", bounded)


def type_mismatches(
    cleaned: DataFrame, comp: Component, ordinal: str = "_ord", bounded: bool = False
) -> DataFrame:
    """``DESCRIPTION, Details`` where one description has several types.

    A component without a type column has no such mismatches. ``bounded`` is as for numbers.
    """
    if comp.category is None:
        return cleaned.sparkSession.createDataFrame([], "DESCRIPTION string, Details string")
    detail = F.concat("VALUE", F.lit(": "), "ENV")
    return _report(_types(cleaned, comp, ordinal), detail, " | ", bounded)


def _report(valued: DataFrame, detail: Column, separator: str, bounded: bool) -> DataFrame:
    """One text per description with more than one value, details in input order."""
    named = valued.groupBy("DESC_KEY", detail.alias("Details")).agg(
        F.min("POSITION").alias("POSITION"),
        F.min("VALUE").alias("_least"),
        F.max("VALUE").alias("_most"),
        first_by(F.col("DESCRIPTION"), F.col("POSITION")).alias("_described"),
    )
    texts = ordered_texts(
        named,
        ["DESC_KEY"],
        ["POSITION", "Details"],
        "Details",
        separator,
        least={"_least": F.col("_least"), "_described": F.col("_described")},
        most={"_most": F.col("_most")},
        bounded=bounded,
    )
    return texts.filter(F.col("_least") < F.col("_most")).select(
        F.col("_described.value").alias("DESCRIPTION"), "Details"
    )
