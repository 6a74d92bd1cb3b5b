from datetime import datetime, timedelta

import pytest
from frames import ledger, rows

from ledgerweave.component import CC, GL
from ledgerweave.operators import FilterRules, keep_reject
from ledgerweave.plans import filter_summary

NOW = datetime(2024, 6, 1, 12)


def entry(description, days=5, **given):
    return {
        "ENV": "LIB-1",
        "DESCRIPTION": description,
        "ACCOUNT": "1000",
        "DOORTREK_JN": "N",
        "VERDREK_JN": "N",
        "LASTUSED_DATE": None if days is None else NOW - timedelta(days=days),
        **given,
    }


def names(df):
    return {row["DESCRIPTION"] for row in rows(df)}


def test_flags_and_recency(spark):
    frame = ledger(
        spark,
        GL,
        [
            entry("KEEP"),
            entry("DOORTREK", DOORTREK_JN="J"),
            entry("VERDREK", VERDREK_JN="j"),
            entry("OLD", days=90),
        ],
    )
    rules = FilterRules(["LIB"], ["1"], lastused_days=30, as_of=NOW)
    cleaned, filtered, counts = keep_reject(frame, GL, rules)
    assert names(cleaned) == {"KEEP"}
    assert names(filtered) == {"DOORTREK", "VERDREK", "OLD"}
    assert rows(counts) == [
        {"Removed": 3, "Kept": 1, "Removed_DOORTREK": 1, "Removed_VERDREK": 1}
    ]
    assert [tuple(r) for r in filter_summary(counts).collect()] == [
        ("Removed", 3),
        ("Kept", 1),
        ("Removed_DOORTREK", 1),
        ("Removed_VERDREK", 1),
    ]


def test_empty_lists_do_not_filter(spark):
    frame = ledger(
        spark, GL, [entry("A"), entry("B", ENV="OTHER-1"), entry("C", ENV="LIB-2", days=None)]
    )
    assert names(keep_reject(frame, GL).cleaned) == {"A", "B", "C"}
    assert names(keep_reject(frame, GL, FilterRules(datalibs=["LIB"])).cleaned) == {"A", "C"}
    assert names(keep_reject(frame, GL, FilterRules(companies=[1])).cleaned) == {"A", "B"}


def test_null_and_blank_values_are_rejected_not_lost(spark):
    frame = ledger(
        spark,
        GL,
        [
            entry(None, DESC_KEY=""),
            entry(""),
            entry("Leeg"),
            entry("no lib", DATALIB=None),
            entry("no company", COMPANY=None),
            entry("no date", days=None),
            entry("no flags", DOORTREK_JN=None, VERDREK_JN=None),
        ],
    )
    rules = FilterRules(["LIB"], ["1"], lastused_days=30, as_of=NOW)
    cleaned, filtered, counts = keep_reject(frame, GL, rules)
    assert names(cleaned) == {"no flags"}
    assert filtered.count() == 6
    assert (counts.first().Kept, counts.first().Removed) == (1, 6)


def test_cutoff_keeps_the_time_of_day(spark):
    at = NOW - timedelta(days=30)
    frame = ledger(
        spark,
        GL,
        [entry("in", LASTUSED_DATE=at), entry("out", LASTUSED_DATE=at - timedelta(seconds=1))],
    )
    assert names(keep_reject(frame, GL, FilterRules(lastused_days=30, as_of=NOW)).cleaned) == {"in"}


def test_flag_counters_ignore_switches_and_other_reasons(spark):
    frame = ledger(spark, GL, [entry("A", DOORTREK_JN="J"), entry("leeg", VERDREK_JN="J")])
    split = keep_reject(frame, GL, FilterRules(excluded_flags=[]))
    assert names(split.cleaned) == {"A"}
    assert rows(split.counts) == [
        {"Removed": 1, "Kept": 1, "Removed_DOORTREK": 1, "Removed_VERDREK": 1}
    ]


def test_missing_flag_columns_count_nothing(spark):
    frame = ledger(spark, GL, [entry("A")]).drop("DOORTREK_JN")
    assert rows(keep_reject(frame, GL).counts) == [
        {"Removed": 0, "Kept": 1, "Removed_DOORTREK": 0, "Removed_VERDREK": 0}
    ]


def test_cost_centers_have_no_flag_counters(spark):
    frame = ledger(spark, CC, [{"ENV": "L-1", "DESCRIPTION": "x"}])
    assert rows(keep_reject(frame, CC).counts) == [{"Removed": 0, "Kept": 1}]


@pytest.mark.parametrize("wrong", [{"lastused_days": 0}, {"datalibs": "LIB"}, {"companies": "1"}])
def test_rules_are_checked(wrong):
    with pytest.raises(ValueError):
        FilterRules(**wrong)


def test_column_tests_reach_the_scan(spark, tmp_path):
    ledger(spark, GL, [entry("A")]).write.parquet(f"{tmp_path}/l")
    rules = FilterRules(["LIB"], ["1"], lastused_days=30, as_of=NOW)
    kept = keep_reject(spark.read.parquet(f"{tmp_path}/l"), GL, rules).cleaned
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    for column in ("DATALIB", "COMPANY", "LASTUSED_DATE", "DOORTREK_JN", "VERDREK_JN"):
        assert column in pushed, pushed


@pytest.mark.parametrize("flags", ["DOORTREK_JN", ["DOORTREK"], ["DOORTREK_JN", "x"]])
def test_unknown_flags_are_refused(flags):
    with pytest.raises(ValueError):
        FilterRules(excluded_flags=flags)
