import random

import pytest
from frames import ledger, rows

from ledgerweave.component import CC, GL
from ledgerweave.operators import gap_actions, presence_cells
from ledgerweave.operators.axis import Axis, each_chunk, numbered_axis
from ledgerweave.operators.gaps import FREE, TAKEN_OTHER, TAKEN_SAME, action_counts

GL_COLUMNS = [
    "ActionType", "Reason", "ENV", "DATALIB", "COMPANY", "DESCRIPTION", "DESCRIPTION_LANG",
    "ACCOUNT", "TYPE", "Conflicting_Description", "Suggested_Number", "Action",
]


def account(description, env, number, type_="T", lang=None, **given):
    return {
        "DESCRIPTION": description,
        "ENV": env,
        "ACCOUNT": number,
        "TYPE": type_,
        "DESCRIPTION_LANG": lang,
        **given,
    }


def gaps_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), "DESC_KEY string, ENV string")


def test_a_free_number_is_created(spark):
    frame = ledger(spark, GL, [account("A", "L1-1", "1000", lang="A long")])
    found = gap_actions(frame, GL, gaps_of(spark, ("a", "L2-2")))
    assert found.columns == GL_COLUMNS
    assert [tuple(r) for r in found.collect()] == [
        ("Create", FREE, "L2-2", "L2", "2", "A", "A long", "1000", "T", "", None,
         "Create in L2-2 account with 1000 and A and A long")
    ]


def test_a_number_taken_by_another_description_is_reviewed(spark):
    frame = ledger(
        spark,
        GL,
        [account("A", "L1-1", "1000", lang="A long"), account("B", "L2-2", "1000", lang="B long")],
    )
    found = {r["ENV"]: r for r in rows(gap_actions(frame, GL))}
    assert set(found) == {"L1-1", "L2-2"}
    assert {r["ActionType"] for r in found.values()} == {"Review"}
    assert found["L1-1"]["Reason"] == TAKEN_OTHER
    assert found["L1-1"]["Conflicting_Description"] == "A"
    assert found["L1-1"]["Suggested_Number"] == "1001"
    assert found["L1-1"]["Action"] == "Review in L1-1 account with 1000 and B and B long"


def test_a_number_taken_by_the_same_description_is_verified(spark):
    frame = ledger(spark, GL, [account("A", "L1-1", "1000"), account("A", "L2-2", "1000")])
    (found,) = rows(gap_actions(frame, GL, gaps_of(spark, ("a", "L2-2"))))
    assert (found["ActionType"], found["Reason"]) == ("Review", TAKEN_SAME)
    assert found["Action"] == "Verify TYPE in L2-2 — account 1000 already exists for 'A'"
    assert (found["Conflicting_Description"], found["Suggested_Number"]) == ("", None)


def test_cost_centers_have_no_type(spark):
    frame = ledger(spark, CC, [{"DESCRIPTION": "X", "ENV": "L1-1", "COSTCENTER": "200"}])
    found = gap_actions(frame, CC, gaps_of(spark, ("x", "L2-2")))
    assert found.columns == [c.replace("ACCOUNT", "COSTCENTER") for c in GL_COLUMNS if c != "TYPE"]
    assert rows(found)[0]["Action"] == "Create in L2-2 cost center with 200 and X"
    both = ledger(
        spark,
        CC,
        [{"DESCRIPTION": "X", "ENV": env, "COSTCENTER": "200"} for env in ("L1-1", "L2-2")],
    )
    (found,) = rows(gap_actions(both, CC, gaps_of(spark, ("x", "L2-2"))))
    assert found["Action"] == (
        "Verify alignment in L2-2 — cost center 200 already exists for 'X'"
    )


def test_no_gaps_give_an_empty_table(spark):
    frame = ledger(spark, GL, [account("A", "L1-1", "1")])
    found = gap_actions(frame, GL)
    assert (found.columns, rows(found)) == (GL_COLUMNS, [])
    nothing = gap_actions(frame.filter("false"), GL)
    assert (nothing.columns, rows(nothing)) == (GL_COLUMNS, [])


def test_attributes_come_from_the_first_environment_that_has_them(spark):
    frame = ledger(
        spark,
        GL,
        [
            account("later", "C-1", "3", type_="t3", DESC_KEY="k"),
            account("First", "A-1", None, type_=None, lang="long", DESC_KEY="k"),
            account("second", "B-1", "0020", type_=None, DESC_KEY="k"),
            account("z", "D-1", None, type_=None),
        ],
    )
    found = {(r["DESCRIPTION"], r["ENV"]): r for r in rows(gap_actions(frame, GL))}
    one = found["First", "D-1"]
    assert (one["ACCOUNT"], one["TYPE"], one["DESCRIPTION_LANG"]) == ("20", "t3", "long")
    assert one["Action"] == "Create in D-1 account with 0020 and First and long"
    bare = found["z", "A-1"]
    assert (bare["ACCOUNT"], bare["ActionType"]) == (None, "Create")
    assert bare["Action"] == "Create in A-1 account with <NA> and z and <NA>"


def test_several_holders_of_a_number_give_one_row(spark):
    frame = ledger(
        spark,
        GL,
        [
            account("b", "E-1", "5"),
            account("a", "E-1", "5"),
            account("b", "E-1", "x9"),
            account("c", "F-1", "5"),
        ],
    )
    (found,) = [r for r in rows(gap_actions(frame, GL)) if r["DESCRIPTION"] == "c"]
    assert (found["Conflicting_Description"], found["Suggested_Number"]) == ("b", "6")
    given = gaps_of(spark, ("b", "E-1"), ("a", "E-1"), ("c", "E-1"))
    found = rows(gap_actions(frame, GL, given))
    rivals = {r["DESCRIPTION"]: r["Conflicting_Description"] for r in found}
    assert rivals == {"b": "a", "a": "b", "c": "b"}


def brute_force(comp, entries, gaps=None):
    """The same actions from plain loops: ``(key, env, type, rival, suggestion)``."""
    number = comp.number
    envs = sorted({e["ENV"] for e in entries})
    keys = sorted({e["DESC_KEY"] for e in entries})
    present = {(e["DESC_KEY"], e["ENV"]) for e in entries}
    if gaps is None:
        gaps = [(k, v) for k in keys for v in envs if (k, v) not in present]
    out = []
    for key, env in gaps:
        mine = sorted(
            (e for e in entries if e["DESC_KEY"] == key and e[number] is not None),
            key=lambda e: (e["ENV"], e["_ord"]),
        )
        wanted = mine[0][number] if mine else None
        there = [e for e in entries if e["ENV"] == env and e[number] is not None]
        users = [e for e in there if e[number] == wanted]
        rivals = [e for e in users if e["DESC_KEY"] != key]
        top = max((int(e[number]) for e in there), default=None)
        out.append(
            (
                env,
                wanted,
                "Review" if users else "Create",
                rivals[0]["DESCRIPTION"] if rivals else "",
                str(top + 1) if rivals else None,
            )
        )
    return sorted(out, key=str)


def random_entries(seed, comp, envs, size=400):
    rng = random.Random(seed)
    out = []
    for position in range(size):
        hot = rng.random() < 0.34
        key = "hot" if hot else f"k{rng.randrange(60)}"
        number = None if rng.random() < 0.1 else str(rng.choice([7, 7, 7, rng.randrange(40)]))
        out.append(
            {
                "DESCRIPTION": key.upper() if rng.random() < 0.5 else key,
                "DESC_KEY": key,
                "ENV": f"L-{rng.randrange(envs)}" if rng.random() < 0.7 else "L-0",
                comp.number: number,
                "_ord": position,
            }
        )
    return out


@pytest.mark.parametrize("comp", [GL, CC], ids=lambda c: c.code)
@pytest.mark.parametrize(
    "options",
    [
        {},
        {"chunk_size": 4},
        {"chunk_size": 3, "broadcast_limit": 5},
    ],
    ids=["one chunk", "chunks", "joins left to Spark"],
)
@pytest.mark.parametrize("given", [False, True], ids=["missing", "given"])
def test_against_brute_force(spark, comp, options, given):
    entries = random_entries(5, comp, envs=17)
    frame = ledger(spark, comp, entries)
    gaps, pairs = None, None
    if given:
        pairs = sorted({(e["DESC_KEY"], e["ENV"]) for e in entries})
        pairs += [("ghost", "L-0"), ("k1", "N-1")]
        gaps = gaps_of(spark, *pairs)
    found = gap_actions(frame, comp, gaps, **options).select(
        "ENV", comp.number, "ActionType", "Conflicting_Description", "Suggested_Number"
    )
    expected = brute_force(comp, entries, pairs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert {"Review", "Create"} == {e[2] for e in expected}


def test_gaps_and_present_cells_make_the_grid(spark):
    entries = random_entries(9, GL, envs=11)
    frame = ledger(spark, GL, entries)
    keys, envs = ({e[c] for e in entries} for c in ("DESC_KEY", "ENV"))
    cells = presence_cells(frame, GL)
    assert gap_actions(frame, GL, cells=cells).count() + cells.count() == len(keys) * len(envs)


def test_gaps_are_never_shuffled_nor_crossed(spark):
    frame = ledger(spark, GL, random_entries(1, GL, envs=9))
    plan = gap_actions(frame, GL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate posexplode")[0]
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_two_hundred_thousand_environments(spark):
    size = 200_000
    owners = {f"E-{i}": (i % 4, i % 4 if i % 5 else (i + 1) % 4) for i in range(size)}
    frame = spark.range(size).selectExpr(
        "concat('E-', id) AS ENV", "concat('d', id % 4) AS DESC_KEY", "concat('D', id % 4) AS DESCRIPTION",
        "string(if(id % 5 = 0, (id + 1) % 4, id % 4)) AS ACCOUNT", "'W' AS TYPE",
        "CAST(NULL AS string) AS DESCRIPTION_LANG", "id AS _ord",
    )
    first = {}
    for env in sorted(owners):
        first.setdefault(owners[env][0], owners[env][1])
    wanted = {
        (env, f"D{key}", "Review" if number == first[key] else "Create")
        for env, (own, number) in owners.items()
        for key in range(4)
        if key != own
    }
    found = gap_actions(frame, GL).select("ENV", "DESCRIPTION", "ActionType").toPandas()
    pairs = list(found.itertuples(index=False, name=None))
    assert len(pairs) == len(wanted) == 3 * size and set(pairs) == wanted
    counted = action_counts(frame, GL).first()
    assert counted.Review == sum(kind == "Review" for _, _, kind in wanted)


@pytest.mark.parametrize("held", [[], [0], [6], [0, 1, 2, 3, 4, 5, 6], [2, 3, 5]])
def test_sparse_sets_fill_the_axis(spark, held):
    axis = Axis(None, 7 * 63, 63, True)
    listed = [(c, c + 1) for c in held]
    frame = spark.createDataFrame([("k", listed)], "key string, s array<struct<chunk int, members long>>")
    found = each_chunk(frame, "s", axis, "m")
    assert found.columns == ["key", "_chunk", "m"]
    assert [(r._chunk, r.m) for r in found.collect()] == [(c, c + 1 if c in held else 0) for c in range(7)]


def test_the_axis_is_numbered_in_order(spark):
    envs = [f"L-{i}" for i in range(5_000)]
    frame = spark.createDataFrame([(e,) for e in envs], "ENV string").repartition(13)
    axis = numbered_axis(frame, chunk_size=10)
    got = {r.ENV: r._chunk * 10 + r._bit for r in axis.frame.collect()}
    assert axis.size == 5_000 and got == {e: i for i, e in enumerate(sorted(envs))}
    assert numbered_axis(frame.limit(0)).size == 0
