"""Tables stored by key: the rows stay, and what groups by the key needs no shuffle."""

import re
import sys

import pytest
from pyspark.sql import functions as F

from ledgerweave.component import GL
from ledgerweave.operators.merge import merge_conflicts, merge_mappings, number_folds, unify
from ledgerweave.operators.mismatches import number_mismatches, type_mismatches
from ledgerweave.operators.presence import presence_binary, presence_cells, presence_totals
from ledgerweave.plans import run_component
from ledgerweave.plans.merge_plan import component_merge
from ledgerweave.storage import store_by_key, store_in_buckets
from test_skew import SPEC, hot_rows


def shuffles(df) -> list[str]:
    """The keys of the plan's exchanges."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*)\)", plan)


def by_description(df) -> list[str]:
    return [keys for keys in shuffles(df) if "DESC_KEY" in keys]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_stay_and_hot_keys_lie_apart(spark):
    frame = hot_rows(spark, 6_000)
    work = store_by_key(frame, "DESC_KEY", hot_rows=500)
    assert {r[0] for r in work.hot.select("DESC_KEY").distinct().collect()} == {""}
    assert work.regular.filter("DESC_KEY = ''").isEmpty()
    whole = work.union(lambda rows, _: rows)
    assert whole.columns == frame.columns
    assert sorted(whole.collect()) == sorted(frame.collect())
    assert store_by_key(frame, "DESC_KEY").hot is None


def test_missing_keys_stay(spark):
    frame = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v long")
    work = store_by_key(frame, "k", hot_rows=1)
    assert work.hot is None and sorted(r.v for r in work.regular.collect()) == [1, 2, 3]
    assert store_by_key(frame.limit(0), "k").regular.count() == 0


def test_nothing_is_shuffled_by_description_again(no_broadcast):
    frame = hot_rows(no_broadcast, 6_000)
    rows = store_by_key(frame, "DESC_KEY").regular
    cells = presence_cells(rows, GL)
    unified = store_in_buckets([unify(number_folds(rows, GL, SPEC), GL, SPEC)], "DESC_KEY")
    stored = store_in_buckets([cells], "DESC_KEY")
    for made in (
        cells,
        number_folds(rows, GL, SPEC),
        unify(number_folds(rows, GL, SPEC), GL, SPEC),
        number_mismatches(rows, GL, bounded=True),
        type_mismatches(rows, GL, bounded=True),
        presence_totals(stored),
        presence_binary(stored, [f"L-{i}" for i in range(7)]),
        merge_conflicts(rows, number_folds(rows, GL, SPEC), unified, GL, SPEC, bounded=True),
        merge_mappings(rows, unified, GL, SPEC, bounded=True),
    ):
        assert by_description(made) == []
        assert made.count() >= 0


def test_a_run_shuffles_by_description_only_to_store(no_broadcast):
    found = run_component(hot_rows(no_broadcast, 6_000).withColumns(
        {"DOORTREK_JN": F.lit("N"), "VERDREK_JN": F.lit("N")}), GL)
    for made in (found.presence_binary, found.presence_enriched, found.actions, found.number_mismatches,
                 found.type_mismatches, found.action_counts):
        assert by_description(made) == []
    assert found.cells.count() > 0


@pytest.mark.parametrize("hot", [200, 10**9])
def test_a_merge_gives_the_same_with_and_without_hot_descriptions(spark, monkeypatch, hot):
    frame = hot_rows(spark, 3_000)
    plan = sys.modules["ledgerweave.plans.merge_plan"]  # the package has a function of that name
    monkeypatch.setattr(plan, "store_by_key", lambda df, key: store_by_key(df, key, hot))
    tables = component_merge(frame, GL, SPEC)
    folds = number_folds(frame, GL, SPEC)
    plain = unify(folds, GL, SPEC)
    assert sorted(tables["Unified_GL"].collect()) == sorted(plain.collect())
    want = merge_conflicts(frame, folds, plain, GL, SPEC)
    assert sorted(tables["Conflicts_GL"].collect()) == sorted(want.collect())
    want = merge_mappings(frame, plain, GL, SPEC)
    assert sorted(map(str, tables["Mappings_GL"].collect())) == sorted(map(str, want.collect()))
