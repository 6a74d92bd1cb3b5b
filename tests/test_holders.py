import random

from pyspark.sql import functions as F

from ledgerweave.operators.holders import rival, two_holders


def test_against_brute_force(spark):
    rng = random.Random(5)
    entries = [
        ("hot" if rng.random() < 0.4 else f"n{rng.randrange(30)}", f"k{rng.randrange(12)}", f"d{i}", i)
        for i in rng.sample(range(2000), 600)
    ] + [("lone", "k1", "d", 5000), ("lone", "k1", "e", 4000)]
    frame = spark.createDataFrame(entries, "num string, key string, name string, at_ long").repartition(7)
    found = {r.num: r for r in two_holders(frame, ["num"], "key", "at_", "name").collect()}
    assert set(found) == {e[0] for e in entries}
    for num, row in found.items():
        first = {}
        for _, key, name, at in sorted((e for e in entries if e[0] == num), key=lambda e: e[3]):
            first.setdefault(key, (at, key, name))
        two = sorted(first.values())[:2]
        assert tuple(row.first) == two[0]
        assert (row.second and tuple(row.second)) == (two[1] if len(two) > 1 else None)
        for key in {*first, "nobody"}:
            others = sorted(h for k, h in first.items() if k != key)
            got = row.first if row.first.key != key else row.second
            assert (got and tuple(got)) == (others[0] if others else None)


def test_rival_in_a_row(spark):
    rows = spark.sql(
        "SELECT key, named_struct('key', f) AS first, IF(s IS NULL, NULL, named_struct('key', s)) AS second "
        "FROM VALUES ('a', 'a', 'b'), ('a', 'b', 'a'), ('a', 'a', NULL), ('a', 'c', NULL) AS t(key, f, s)"
    )
    found = rows.select(rival(F.col("first"), F.col("second"), "key")["key"].alias("r")).collect()
    assert [r.r for r in found] == ["b", "b", None, "c"]


def test_no_more_than_two_rows_a_task_are_shuffled_by_group(spark):
    frame = spark.range(1000).selectExpr("concat('n', id % 3) AS num", "concat('k', id) AS key", "id AS at_")
    plan = two_holders(frame, ["num"], "key", "at_")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "collect_list" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
