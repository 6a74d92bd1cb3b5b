"""The training-data queries that SQL can say, against their counterparts."""

import compare
import pytest

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def engine():
    return compare.engine(SF_DIR)


def test_counterparts_belong_to_queries():
    assert set(corpus_pipeline.ORACLES) < set(corpus_pipeline.QUERIES)


@pytest.mark.parametrize("name", sorted(corpus_pipeline.ORACLES))
def test_query(spark, engine, name):
    count, wrong = compare.differences(spark, engine, SF_DIR, name)
    assert wrong == []
    assert count > 0
