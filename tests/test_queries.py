"""Every query against its SQL counterpart; those of the training data are in tests/llm."""

import compare
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.fixture(scope="module")
def engine():
    return compare.engine(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, engine, name):
    count, wrong = compare.differences(spark, engine, SF_DIR, name)
    assert wrong == []
    assert count > 0


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["DESC_KEY", "DESCRIPTION", "Count_Present", "Pct_Present"]
    assert found.count() == 186
