from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerweave.component import CC, GL, component
from ledgerweave.sources import (
    SchemaViolations,
    conform,
    load,
    normalise_columns,
    read_table,
    require_valid,
    schema_violations,
    table_for,
)
from ledgerweave.sources.ledger import TableLocation, _with_ordinals

RENAMES = {"bedrijf": "company", "GROOTBOEK": "ACCOUNT", "omschrijving": "description", "NOPE": "X"}


def delivered(spark):
    return spark.createDataFrame(
        [
            (" L1 ", "1", 1000.0, "Foo   Bar", "T  1", "20240115", "N", None, "extra"),
            ("L2", "2\t", None, "Baz", None, "45000", "j", "J", None),
        ],
        "` datalib` string, bedrijf string, Grootboek double, `OMSCHRIJVING ` string, "
        "type string, lastused_date string, doortrek_jn string, verdrek_jn string, note string",
    )


def test_column_names_are_normalised_and_renamed(spark):
    names = normalise_columns(delivered(spark), RENAMES).columns
    assert names[:4] == ["DATALIB", "COMPANY", "ACCOUNT", "DESCRIPTION"]
    assert names[-1] == "NOTE"


def test_colliding_names_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="called"):
        normalise_columns(frame, {"A": "B"})


def test_conform_builds_the_ledger(spark):
    ledger = conform(delivered(spark), GL, RENAMES, order_by=F.monotonically_increasing_id())
    first, second = ledger.orderBy("_ord").collect()
    assert (first.DATALIB, first.COMPANY, first.ENV) == ("L1", "1", "L1-1")
    assert (first.DESCRIPTION, first.DESC_KEY, first.TYPE) == ("Foo Bar", "foo bar", "T 1")
    assert (first.ACCOUNT, second.ACCOUNT) == ("1000", None)
    assert first.LASTUSED_DATE == datetime(2024, 1, 15)
    assert second.LASTUSED_DATE == datetime(2023, 3, 15)
    assert (second.ENV, second.DOORTREK_JN, second.TYPE) == ("L2-2", "j", None)
    assert first.DESCRIPTION_LANG is None
    assert first.NOTE == "extra"


def test_declared_columns_must_all_be_there(spark):
    frame = delivered(spark).drop("verdrek_jn")
    with pytest.raises(ValueError, match="VERDREK_JN"):
        conform(frame, GL, RENAMES, order_by=F.lit(0))


def test_an_order_is_required(spark):
    with pytest.raises(ValueError, match="order"):
        conform(delivered(spark), GL, RENAMES)


def broken(spark):
    good = ("L", "1", "100", "A", "T", None, "N", "j")
    rows = [
        good,
        (None, "1", None, "A", None, None, None, None),
        (" ", None, "1", " ", "T", None, " J", "x"),
        ("L", "", "1", None, "T", None, "", "n"),
    ]
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)],
        "DATALIB string, COMPANY string, ACCOUNT string, DESCRIPTION string, TYPE string, "
        "LASTUSED_DATE string, DOORTREK_JN string, VERDREK_JN string, _ord bigint",
    )


def test_every_broken_rule_is_reported(spark):
    found = {(r._ord, r.COLUMN, r.CHECK) for r in schema_violations(broken(spark), GL).collect()}
    assert found == {
        (1, "DATALIB", "not null"),
        (2, "DATALIB", "not blank"),
        (2, "COMPANY", "not null"),
        (2, "DESCRIPTION", "not blank"),
        (2, "DOORTREK_JN", "J or N"),
        (2, "VERDREK_JN", "J or N"),
        (3, "DESCRIPTION", "not null"),
        (3, "DOORTREK_JN", "J or N"),
    }


def test_violations_stop_the_load(spark):
    with pytest.raises(SchemaViolations) as caught:
        conform(broken(spark), GL)
    assert caught.value.total == 8
    assert caught.value.cases[0]._ord == 1
    many = broken(spark).withColumn("_ord", F.explode(F.array(*map(F.lit, range(9)))))
    with pytest.raises(SchemaViolations) as caught:
        require_valid(many, GL)
    assert caught.value.total == 72
    assert len(caught.value.cases) == 10


def test_cost_centers_have_no_flag_rules(spark):
    frame = spark.createDataFrame(
        [("L", "1", 200, "X", None, 0)],
        "DATALIB string, COMPANY string, COSTCENTER int, DESCRIPTION string, "
        "LASTUSED_DATE date, _ord bigint",
    )
    row = conform(frame, CC).first()
    assert (row.COSTCENTER, row.ENV, row.DESC_KEY) == ("200", "L-1", "x")


def test_tables_are_found_by_component():
    here = {"GL": TableLocation("/data", "Accounts")}
    assert table_for(GL, here).table == "Accounts"
    with pytest.raises(ValueError, match="CC"):
        table_for(CC, here)
    with pytest.raises(ValueError, match="unknown"):
        component("XX")


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_load_reads_files_in_order(spark, tmp_path, format):
    frame = spark.range(100).select(
        F.lit("L").alias("DATALIB"),
        F.lit("1").alias("COMPANY"),
        F.col("id").alias("COSTCENTER"),
        F.concat(F.lit("d"), "id").alias("DESCRIPTION"),
        F.lit("20240115").alias("LASTUSED_DATE"),
    )
    frame.coalesce(1).write.format(format).option("header", True).save(f"{tmp_path}/CostCenters")
    where = {"CC": TableLocation(str(tmp_path), "CostCenters", format, {"header": "true"})}
    ledger = load(spark, CC, where)
    assert [int(r.COSTCENTER) for r in ledger.orderBy("_ord").collect()] == list(range(100))
    assert ledger.select("_ord").distinct().count() == 100


def test_parquet_ordinals_do_not_depend_on_splits(spark, tmp_path):
    spark.range(0, 5000, 1, 4).write.parquet(f"{tmp_path}/t")
    where = TableLocation(str(tmp_path), "t")
    before = {r._ord: r.id for r in read_table(spark, where).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        after = {r._ord: r.id for r in read_table(spark, where).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert before == after
    assert len(before) == 5000


def test_conform_needs_no_shuffle_and_no_python(spark):
    ledger = conform(
        delivered(spark), GL, RENAMES, order_by=F.monotonically_increasing_id(), check=False
    )
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Python" not in plan


def test_conform_works_on_a_stream(spark, tmp_path):
    delivered(spark).withColumn("_ord", F.monotonically_increasing_id()).write.parquet(
        f"{tmp_path}/in"
    )
    batch = spark.read.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
    query = (
        conform(stream, GL, RENAMES, check=False)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/out")
    )
    query.awaitTermination(60)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert {r.ENV for r in found.collect()} == {"L1-1", "L2-2"}


@pytest.mark.parametrize("broadcast_files", [0, 100])
def test_parquet_ordinals_number_files_in_order_of_their_paths(spark, tmp_path, broadcast_files):
    folder = tmp_path / "a b%20c \u00e9=1"
    spark.range(90).selectExpr("id", "concat('x/y ', id % 7) AS q").repartition(5).write.partitionBy("q").parquet(
        str(folder)
    )
    raw = spark.read.parquet(str(folder))
    found = _with_ordinals(raw, broadcast_files)
    assert found.columns == ["id", "q", "_ord"] and dict(found.dtypes)["_ord"] == "bigint"
    places = raw.select("id", "_metadata.file_path", "_metadata.row_index").collect()
    in_order = [r.id for r in sorted(places, key=lambda r: (r.file_path, r.row_index))]
    assert [r.id for r in found.orderBy("_ord").collect()] == in_order
    files = sorted({r.file_path for r in places})
    want = {r.id: (files.index(r.file_path) << 38) + r.row_index for r in places}
    assert {r.id: r._ord for r in found.collect()} == want


def test_columns_of_any_name_stay_beside_ordinals(spark, tmp_path):
    names = ["a.b", "x y", "_file", "id"]
    spark.range(3).selectExpr("id AS `a.b`", "id AS `x y`", "id AS _file", "id").write.parquet(f"{tmp_path}/T")
    found = read_table(spark, TableLocation(str(tmp_path), "T"))
    assert found.columns == [*names, "_ord"] and found.count() == 3


def test_an_empty_table_has_ordinals(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/T")
    assert read_table(spark, TableLocation(str(tmp_path), "T")).collect() == []
