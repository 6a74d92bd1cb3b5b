"""Account and cost-center numbers, which arrive as integers, decimals or text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions.text import strip

# Spark reads "10D" or "0x1p3" as numbers; only these spellings count as one.
_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Integers that already have their final spelling and survive a double exactly.
_PLAIN_INTEGER = "^(0|-?[1-9][0-9]{0,14})$"
# Whole doubles are printed through a long; larger ones keep their own spelling.
_WHOLE_BOUND = float(2**63)


def _whole_text(value: Column) -> Column:
    """Digits of a double that is a whole number, else null."""
    return F.when(
        (F.abs(value) < _WHOLE_BOUND) & (value % F.lit(1.0) == 0),
        value.cast("bigint").cast("string"),
    )


def as_double(c: Column) -> Column:
    """``c`` as a double; anything that is no plain decimal number gives null."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def format_number(c: Column) -> Column:
    """Display form: whole numbers as plain digits, everything else unchanged."""
    text = c.cast("string")
    spelled = F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "")
    return F.when(text.rlike(_PLAIN_INTEGER), text).otherwise(
        F.coalesce(_whole_text(as_double(spelled)), text)
    )


def format_double(c: Column) -> Column:
    """Display form of a double column."""
    return F.coalesce(_whole_text(c), c.cast("string"))


def number_text(c: Column, data_type: str) -> Column:
    """Text identity of a number column of Spark type ``data_type``.

    Numeric columns lose a ``.0`` tail, so that a number reads the same whether
    or not blanks elsewhere turned its column into floats; a float that is no
    number counts as missing. Text is kept as is.
    """
    if data_type in ("double", "float"):
        whole = _whole_text(c.cast("double"))
        return F.when(~F.isnan(c), F.coalesce(whole, c.cast("string")))
    if data_type.startswith("decimal"):
        return F.regexp_replace(c.cast("string"), r"\.0+$", "")
    return c.cast("string")
