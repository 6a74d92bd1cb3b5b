"""The last-used date, which source systems write in five different ways."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions.text import strip

# Spellings of "no date", the century pivot of two-digit years, the
# spreadsheet serial-day range and origin, the range of nanosecond time stamps.
BLANK_DATES = ("", "nan", "none", "nat", "null")
CENTURY_PIVOT = "69"
SERIAL_FIRST, SERIAL_LAST = 1, 60000
SERIAL_ORIGIN = "1899-12-30"
EARLIEST, LATEST = "1677-09-22", "2262-04-11 23:47:16"


def parse_last_used(c: Column, data_type: str, date_formats: Sequence[str] = ()) -> Column:
    """``c`` of Spark type ``data_type`` as a zone-free time stamp; unreadable gives null.

    Text is read by shape: six digits ``yyMMdd``, eight digits ``yyyyMMdd``, other
    digits a spreadsheet day number, the rest ISO date or date-time, then each of
    ``date_formats`` in turn.
    """
    if data_type in ("date", "timestamp", "timestamp_ntz"):
        return _in_range(c.cast("timestamp_ntz"))

    text = strip(c.cast("string"))
    # Columns with blanks often arrive as floats: 20240115.0 means 20240115.
    whole = F.regexp_replace(text, r"\.0$", "")
    text = F.when(text.endswith(".0") & _all_digits(whole), whole).otherwise(text)
    century = F.when(F.substring(text, 1, 2) >= CENTURY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    serial = text.try_cast("int")
    free = F.coalesce(
        text.try_cast("timestamp_ntz"),
        *(
            F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
            for pattern in date_formats
        ),
    )
    parsed = (
        F.when(F.lower(text).isin(*BLANK_DATES), None)
        .when(~_all_digits(text), free)
        .when(F.length(text) == 6, _calendar_day(F.concat(century, text)))
        .when(F.length(text) == 8, _calendar_day(text))
        .when(
            serial.between(SERIAL_FIRST, SERIAL_LAST),
            F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), serial).cast("timestamp_ntz"),
        )
    )
    return _in_range(parsed)


def _in_range(moment: Column) -> Column:
    """``moment``, null outside the range that counts as a date."""
    inside = moment.between(
        F.lit(EARLIEST).cast("timestamp_ntz"), F.lit(LATEST).cast("timestamp_ntz")
    )
    return F.when(inside, moment)


def _all_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", "") == ""


def _calendar_day(text: Column) -> Column:
    return F.try_to_date(text, "yyyyMMdd").cast("timestamp_ntz")
