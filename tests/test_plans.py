from datetime import datetime
from types import SimpleNamespace

import pytest
from frames import ledger, rows
from pyspark.sql import functions as F

from ledgerweave import CC, GL, FilterRules, merge_plan, run_component
from ledgerweave.plans import Sink, Steps, config_echo, materialise, run_summary, table_names
from ledgerweave.storage import shared_folder

SPEC = {
    "sources": [{"datalib": "ERP", "company": 1}, {"datalib": "ERP", "company": 2}],
    "target": {"datalib": "ERP", "company": 9},
    "numbering_strategy": "first",
}


def accounts(spark):
    def entry(description, env, number, **given):
        return {
            "DESCRIPTION": description,
            "ENV": env,
            "ACCOUNT": number,
            "TYPE": "W",
            "DOORTREK_JN": "N",
            "VERDREK_JN": "N",
            "LASTUSED_DATE": datetime(2024, 1, 15),
            **given,
        }

    return ledger(
        spark,
        GL,
        [
            entry("Revenue", "ERP-1", "8000"),
            entry("Revenue", "ERP-2", "8001"),
            entry("Cost", "ERP-1", "4000", TYPE="K"),
            entry("Old", "ERP-1", "1", DOORTREK_JN="J"),
        ],
    )


def cost_centers(spark):
    return ledger(
        spark,
        CC,
        [
            {"DESCRIPTION": "X", "ENV": "ERP-1", "COSTCENTER": "10"},
            {"DESCRIPTION": "Y", "ENV": "ERP-2", "COSTCENTER": "20"},
        ],
    )


def test_a_run_returns_all_results(spark):
    result = run_component(lambda: accounts(spark), GL)
    assert result.raw.count() == 4
    assert result.cleaned.count() == 3
    assert result.filtered.count() == 1
    assert result.presence_binary.columns == ["DESC_KEY", "ERP-1", "ERP-2"]
    assert [r["Action"] for r in rows(result.actions)] == [
        "Create in ERP-2 account with 4000 and Cost and <NA>"
    ]
    assert [r["Details"] for r in rows(result.number_mismatches)] == ["8000 (ERP-1), 8001 (ERP-2)"]
    assert rows(result.type_mismatches) == []


@pytest.mark.parametrize("comp, frame", [(GL, accounts), (CC, cost_centers)], ids=["GL", "CC"])
def test_a_run_that_keeps_nothing(spark, tmp_path, comp, frame):
    rules = FilterRules(datalibs=["nowhere"])
    result = run_component(frame(spark), comp, rules, run_ts="t", out=str(tmp_path))
    assert result.cleaned.count() == result.actions.count() == 0
    assert result.presence_binary.columns == ["DESC_KEY"]
    assert result.presence_enriched.count() == 0
    stored = spark.read.parquet(f"{tmp_path}/{comp.code}_output_t/{comp.code}_RunSummary")
    assert {r.Metric: r.Value for r in stored.collect()}["Environments"] == "0"


def test_actions_by_type_and_their_counts(spark):
    result = run_component(accounts(spark), GL)
    assert rows(result.create) == rows(result.actions) and rows(result.review) == []
    assert tuple(result.action_counts.first()) == (1, 0)


def test_a_run_without_wide_tables(spark, tmp_path):
    result = run_component(accounts(spark), GL, run_ts="t", out=str(tmp_path), wide=False)
    assert result.presence_binary is None and result.presence_enriched is None
    assert result.create.count() == 1
    assert not any("resence" in p.name for p in (tmp_path / "GL_output_t").iterdir())


def test_each_step_can_be_replaced(spark):
    seen = []

    def noting(name, function):
        def step(*args, **kwargs):
            seen.append(name)
            return function(*args, **kwargs)

        return step

    usual = Steps()
    swapped = Steps(*(noting(n, f) for n, f in zip(Steps._fields, usual)))
    result = run_component(accounts(spark), GL, steps=swapped)
    assert sorted(seen) == sorted(Steps._fields)
    assert tuple(result.action_counts.first()) == (1, 0)


def test_summary(spark):
    result = run_component(accounts(spark), GL)
    found = run_summary(
        GL,
        result.counts,
        result.cells,
        result.action_counts,
        result.number_mismatches,
        result.type_mismatches,
        run_ts="2024-06-01T12:00:00",
    )
    assert [tuple(r) for r in found.collect()] == [
        ("Component", "GL"),
        ("Run Timestamp", "2024-06-01T12:00:00"),
        ("Rows Loaded", "4"),
        ("Rows Kept", "3"),
        ("Rows Removed", "1"),
        ("Removed DOORTREK", "1"),
        ("Removed VERDREK", "0"),
        ("Environments", "2"),
        ("Unique Descriptions", "2"),
        ("Create Actions", "1"),
        ("Review Actions", "0"),
        ("Number Mismatches", "1"),
        ("Type Mismatches", "0"),
    ]


def test_summary_separates_thousands(spark):
    counts = spark.sql("SELECT 1234567L AS Removed, 1000L AS Kept")
    nothing = spark.createDataFrame([], "ENV string, DESC_KEY string, ActionType string")
    actions = spark.sql("SELECT 0L AS Create, 0L AS Review")
    found = run_summary(CC, counts, nothing, actions, nothing, nothing)
    figures = {r["Metric"]: r["Value"] for r in rows(found)}
    assert len(figures) == 10
    assert (figures["Rows Loaded"], figures["Environments"]) == ("1,235,567", "0")


def test_a_run_writes_eleven_tables_once(spark, tmp_path):
    out = str(tmp_path)
    run_component(accounts(spark), GL, run_ts="20240601_120000", out=out)
    folder = tmp_path / "GL_output_20240601_120000"
    assert {p.name for p in folder.iterdir()} == set(table_names(GL).values())
    assert spark.read.parquet(f"{folder}/GL_Create").count() == 1
    assert spark.read.parquet(f"{folder}/GL_Review").count() == 0
    summary = spark.read.parquet(f"{folder}/GL_RunSummary").collect()
    assert [r.Metric for r in summary][:3] == ["Component", "Run Timestamp", "Rows Loaded"]
    assert len(summary) == 13
    config = spark.read.parquet(f"{folder}/GL_Config").first()
    assert (config.component, config.run_timestamp) == ("GL", "20240601_120000")
    assert (config.datalibs, config.excluded_flags) == ("", "DOORTREK_JN,VERDREK_JN")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        run_component(accounts(spark), GL, run_ts="20240601_120000", out=out)
    with pytest.raises(ValueError, match="run_ts"):
        run_component(accounts(spark), GL, out=out)


@pytest.mark.parametrize("format", ["csv", "json"])
def test_text_runs(spark, tmp_path, format):
    frame = accounts(spark).withColumn("_ord", F.struct(F.lit("f").alias("file"), "_ord"))
    names = {"Create": "ToCreate"}
    run_component(frame, GL, run_ts="t", out=str(tmp_path), names=names, format=format)
    folder = tmp_path / "GL_output_t"
    assert len(list(folder.iterdir())) == 11
    reader = spark.read.option("header", True).format(format)
    found = reader.load(f"{folder}/GL_Cleaned").collect()
    assert {r.LASTUSED_DATE for r in found} == {"15-01-2024"}
    assert {r._ord_file for r in found} == {"f"}
    assert reader.load(f"{folder}/ToCreate").first().ACCOUNT == "4000"


def test_sorted_results(spark, tmp_path):
    table = spark.range(50).select((F.col("id") * 37 % 50).alias("n")).repartition(4)
    Sink(str(tmp_path), {"t": "T"}).write("t", table, ["n"])
    parts = sorted((tmp_path / "T").glob("*.parquet"))
    assert [r.n for p in parts for r in spark.read.parquet(str(p)).collect()] == list(range(50))


def test_merge_plan(spark, tmp_path):
    cleaned = {"GL": accounts(spark), "CC": cost_centers(spark)}
    tables = merge_plan(cleaned, SPEC, run_ts="20240601_120000", out=str(tmp_path))
    names = [f"{kind}_{code}" for code in ("GL", "CC")
             for kind in ("Unified", "Conflicts", "Actions", "Mappings")]
    assert list(tables) == ["Config", "Sources", *names]
    folder = tmp_path / "Merge_Plan_20240601_120000"
    assert {p.name for p in folder.iterdir()} == set(tables)
    assert rows(tables["Config"]) == [
        {
            "Target_ENV": "ERP-9",
            "Scope": "GL,CC",
            "Numbering_Strategy": "first",
            "Preferred_ENV": "",
            "Created_At": "20240601_120000",
        }
    ]
    assert [r["Source_ENV"] for r in rows(tables["Sources"])] == ["ERP-1", "ERP-2"]
    assert spark.read.parquet(f"{folder}/Unified_GL").count() == 3
    assert spark.read.parquet(f"{folder}/Conflicts_GL").count() == 1


def test_merge_plan_scope(spark):
    tables = merge_plan({"CC": cost_centers(spark)}, {**SPEC, "scope": ["cc"]}, run_ts="t")
    assert "Unified_CC" in tables and "Unified_GL" not in tables
    with pytest.raises(ValueError, match="GL"):
        merge_plan({"CC": cost_centers(spark)}, SPEC, run_ts="t")


def test_materialised_tables_live_in_the_shared_folder(spark):
    frame = spark.range(10).withColumn("s", F.struct("id"))
    stored = materialise(frame)
    assert stored.dtypes == frame.dtypes
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in stored.inputFiles())


def test_config_echo_is_text(spark):
    found = config_echo(spark, {"a": None, "b": [1, 2], "c": True}).first()
    assert (found.a, found.b, found.c) == (None, "1,2", "True")


def fake_session(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)


def test_the_shared_folder_is_the_named_one():
    assert shared_folder(fake_session("yarn", "hdfs:///scratch")) == "hdfs:///scratch"
    assert shared_folder(fake_session("local[2]", "/named")) == "/named"


def test_only_local_sessions_make_their_own_folder():
    own = shared_folder(fake_session("local[2]"))
    assert own == shared_folder(fake_session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake_session("spark://host:7077"))
