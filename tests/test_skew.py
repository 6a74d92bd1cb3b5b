"""Hot keys: the plans split them, and nothing gets lost."""

import pytest
from pyspark.sql import functions as F

from ledgerweave.component import CC, GL
from ledgerweave.operators import (
    MergeSpec,
    gap_actions,
    language_variants,
    merge_actions,
    merge_mappings,
    number_folds,
    presence_cells,
    presence_enriched,
    unify,
)
from ledgerweave.operators.joins import even_left_join

# So small that the test data counts as large.
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def shuffled(spark):
    before = {name: spark.conf.get(name, None) for name in CONF}
    for name, value in CONF.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ran(df):
    """The rows and the plan that adaptive execution ended with."""
    found = df.collect()
    return found, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot_rows(spark, size=60_000, envs=7):
    """A third of the rows in one description and a third in one number."""
    number = F.when(F.col("id") % 3 == 0, F.lit(9999)).otherwise(F.col("id") % 5000)
    other = F.concat(F.lit("k"), F.col("id") % 4000)
    key = F.when(F.col("id") % 3 == 1, F.lit("")).otherwise(other)
    frame = spark.range(0, size, 1, 8).select(
        F.lit("L").alias("DATALIB"),
        (F.col("id") % envs).cast("string").alias("COMPANY"),
        number.cast("string").alias("ACCOUNT"),
        F.concat(key, F.lit("!")).alias("DESCRIPTION"),
        key.alias("DESC_KEY"),
        F.concat(F.lit("L-"), F.col("id") % envs).alias("ENV"),
        F.lit("T").alias("TYPE"),
        F.lit("lang").alias("DESCRIPTION_LANG"),
        F.col("id").alias("_ord"),
    )
    return frame


SPEC = MergeSpec.from_dict(
    {
        "sources": [{"datalib": "L", "company": c} for c in (0, 1, 2)],
        "target": {"datalib": "L", "company": 3},
        "numbering_strategy": "pick_majority",
    }
)


def test_a_hot_key_on_the_right_is_split(shuffled):
    left = shuffled.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("l"))
    right = shuffled.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("r"),
    )
    found, plan = ran(even_left_join(left, right, "k"))
    assert "skew=true" in plan
    assert len(found) == 100_000 + 50
    assert sum(row.r is None for row in found) == 50


def test_mappings_split_a_hot_description(shuffled):
    frame = hot_rows(shuffled)
    unified = unify(number_folds(frame, GL, SPEC), GL, SPEC)
    found, plan = ran(merge_mappings(frame, unified, GL, SPEC))
    assert "skew=true" in plan
    expected = frame.filter(F.col("ENV").isin(SPEC.source_names))
    assert len(found) == expected.select("ENV", "DESCRIPTION", "ACCOUNT").distinct().count()


def test_actions_split_hot_numbers_and_descriptions(shuffled):
    frame = hot_rows(shuffled)
    unified = unify(number_folds(frame, GL, SPEC), GL, SPEC)
    actions = merge_actions(frame, unified, GL, SPEC)
    _, plan = ran(actions.groupBy("ActionType").count())
    assert plan.count("skew=true") >= 2


def test_gaps_split_a_hot_number(shuffled):
    frame = hot_rows(shuffled, envs=37)
    found, plan = ran(gap_actions(frame, GL))
    assert "skew=true" in plan
    keys, cells = frame.select("DESC_KEY").distinct(), frame.select("DESC_KEY", "ENV").distinct()
    assert len(found) == keys.count() * 37 - cells.count() > 50_000


def test_languages_of_a_hot_description(shuffled):
    frame = hot_rows(shuffled).select(
        "DESC_KEY",
        "DESCRIPTION",
        "ENV",
        "_ord",
        F.col("ACCOUNT").alias("COSTCENTER"),
        F.sha2(F.col("_ord").cast("string"), 256).alias("DESCRIPTION_LANG"),
    )
    cells = presence_cells(frame, CC)
    envs = [f"L-{i}" for i in range(7)]
    found, plan = ran(presence_enriched(cells, CC, envs, language_variants(frame)))
    assert "skew=true" in plan
    assert len(found) == frame.count()
