from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import parse_last_used


def parse(spark, value, kind="string", formats=()):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(parse_last_used(F.col("v"), kind, formats).alias("d")).first().d


@pytest.mark.parametrize(
    "text, day",
    [
        ("680101", datetime(2068, 1, 1)),
        ("690101", datetime(1969, 1, 1)),
        ("991231", datetime(1999, 12, 31)),
        ("20240115", datetime(2024, 1, 15)),
        (" 20240115 ", datetime(2024, 1, 15)),
        ("20240230", None),
        ("99991231", None),
        ("16770921", None),
        ("1", datetime(1899, 12, 31)),
        ("45000", datetime(2023, 3, 15)),
        ("60000", datetime(2064, 4, 8)),
        ("60001", None),
        ("0", None),
        ("123456789012", None),
        ("20240115.0", datetime(2024, 1, 15)),
        ("45000.0", datetime(2023, 3, 15)),
        ("2024-01-15", datetime(2024, 1, 15)),
        ("2024-01-15 10:11:12", datetime(2024, 1, 15, 10, 11, 12)),
        ("", None),
        ("  ", None),
        ("NaT", None),
        ("None", None),
        ("null", None),
        ("nan", None),
        ("soon", None),
        (None, None),
    ],
)
def test_text(spark, text, day):
    assert parse(spark, text) == day


def test_extra_formats_come_in_order(spark):
    assert parse(spark, "03/04/2024") is None
    assert parse(spark, "03/04/2024", formats=["dd/MM/yyyy"]) == datetime(2024, 4, 3)
    both = ["MM/dd/yyyy", "dd/MM/yyyy"]
    assert parse(spark, "03/04/2024", formats=both) == datetime(2024, 3, 4)
    assert parse(spark, "31/04/2024", formats=both) is None
    assert parse(spark, "30/04/2024", formats=both) == datetime(2024, 4, 30)


@pytest.mark.parametrize(
    "kind, value, day",
    [
        ("date", date(2024, 1, 15), datetime(2024, 1, 15)),
        ("timestamp_ntz", datetime(2024, 1, 15, 8), datetime(2024, 1, 15, 8)),
        ("int", 20240115, datetime(2024, 1, 15)),
        ("double", 45000.0, datetime(2023, 3, 15)),
    ],
)
def test_typed_columns(spark, kind, value, day):
    assert parse(spark, value, kind) == day


def test_typed_dates_have_the_same_range(spark):
    assert parse(spark, datetime(9999, 12, 31), "timestamp_ntz") is None
    assert parse(spark, datetime(2024, 1, 15), "timestamp_ntz") == datetime(2024, 1, 15)
