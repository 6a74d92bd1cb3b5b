import random

import pytest
from frames import ledger, rows

from ledgerweave.component import CC, GL
from ledgerweave.operators import (
    environments,
    language_variants,
    presence_binary,
    presence_cells,
    presence_enriched,
    presence_shards,
    presence_totals,
    shard_index,
)

NINE, FIFTEEN = "ERPOMGEVING-9", "ERPOMGEVING-15"


@pytest.fixture
def accounts(spark):
    return ledger(
        spark,
        GL,
        [
            {"DESCRIPTION": "Revenue", "ENV": NINE, "ACCOUNT": "8000", "TYPE": "W"},
            {"DESCRIPTION": "Revenue", "ENV": FIFTEEN, "ACCOUNT": "8000", "TYPE": "W"},
            {"DESCRIPTION": "Cost", "ENV": FIFTEEN, "ACCOUNT": "4000", "TYPE": "K"},
        ],
    )


def by_key(df):
    return {row["DESC_KEY"]: row for row in rows(df)}


def test_environments_sort_as_text(accounts):
    assert environments(presence_cells(accounts, GL)) == [FIFTEEN, NINE]


def test_too_many_environments_are_refused(accounts):
    with pytest.raises(ValueError, match="long form"):
        environments(presence_cells(accounts, GL), limit=1)


def test_binary_matrix(accounts):
    cells = presence_cells(accounts, GL)
    found = presence_binary(cells, environments(cells))
    assert found.columns == ["DESC_KEY", FIFTEEN, NINE]
    assert by_key(found) == {
        "revenue": {"DESC_KEY": "revenue", FIFTEEN: 1, NINE: 1},
        "cost": {"DESC_KEY": "cost", FIFTEEN: 1, NINE: 0},
    }


def test_enriched_matrix(accounts):
    cells = presence_cells(accounts, GL)
    found = presence_enriched(cells, GL, environments(cells))
    assert found.columns == [
        "DESC_KEY",
        "DESCRIPTION",
        FIFTEEN,
        NINE,
        f"Acct_{FIFTEEN}",
        f"Type_{FIFTEEN}",
        f"Acct_{NINE}",
        f"Type_{NINE}",
        "Count_Present",
        "Pct_Present",
    ]
    revenue, cost = by_key(found)["revenue"], by_key(found)["cost"]
    assert (revenue["Count_Present"], revenue["Pct_Present"]) == (2, 100.0)
    assert (cost["Count_Present"], cost["Pct_Present"]) == (1, 50.0)
    assert revenue[f"Acct_{NINE}"] == "8000"
    assert cost[f"Type_{FIFTEEN}"] == "K"
    assert cost[f"Acct_{NINE}"] is None


def test_firsts_follow_input_order_and_skip_nulls(spark):
    frame = ledger(
        spark,
        GL,
        [
            {"DESCRIPTION": "b", "DESC_KEY": "k", "ENV": "Z-1", "ACCOUNT": None, "TYPE": "t1"},
            {"DESCRIPTION": "a", "DESC_KEY": "k", "ENV": "Z-1", "ACCOUNT": "2", "TYPE": None},
            {"DESCRIPTION": "c", "DESC_KEY": "k", "ENV": "A-1", "ACCOUNT": "1", "TYPE": "t2"},
        ],
    )
    cells = presence_cells(frame, GL)
    cell = {r["ENV"]: r for r in rows(cells)}["Z-1"]
    assert (cell["Rows"], cell["ACCOUNT"], cell["TYPE"], cell["DESCRIPTION"]) == (2, "2", "t1", "b")
    wide = by_key(presence_enriched(cells, GL, environments(cells)))["k"]
    assert wide["DESCRIPTION"] == "b"


def test_an_environment_without_numbers_keeps_its_column(spark):
    frame = ledger(spark, CC, [{"DESCRIPTION": "x", "ENV": "A-1"}])
    cells = presence_cells(frame, CC)
    found = presence_enriched(cells, CC, environments(cells))
    totals = ["Count_Present", "Pct_Present"]
    assert found.columns == ["DESC_KEY", "DESCRIPTION", "A-1", *totals, "CC_A-1"]
    assert rows(found)[0]["CC_A-1"] is None


def test_cost_centers_get_a_row_per_language(spark):
    frame = ledger(
        spark,
        CC,
        [
            {"DESCRIPTION": "x", "ENV": "A-1", "COSTCENTER": "1", "DESCRIPTION_LANG": "ex"},
            {"DESCRIPTION": "x", "ENV": "A-1", "COSTCENTER": "2", "DESCRIPTION_LANG": "ex"},
            {"DESCRIPTION": "x", "ENV": "B-1", "COSTCENTER": "3", "DESCRIPTION_LANG": None},
            {"DESCRIPTION": "y", "ENV": "B-1", "COSTCENTER": "4", "DESCRIPTION_LANG": "why"},
        ],
    )
    cells = presence_cells(frame, CC)
    found = presence_enriched(cells, CC, environments(cells), language_variants(frame))
    assert found.columns == [
        "DESC_KEY", "DESCRIPTION", "A-1", "B-1", "Count_Present", "Pct_Present",
        "DESCRIPTION_LANG", "CC_A-1", "CC_B-1",
    ]
    picked = {(r["DESC_KEY"], r["DESCRIPTION_LANG"], r["CC_A-1"], r["CC_B-1"]) for r in rows(found)}
    assert picked == {("x", "ex", "1", "3"), ("x", None, "1", "3"), ("y", "why", None, "4")}


def test_shares_round_half_to_even(spark):
    frame = ledger(
        spark,
        GL,
        [{"DESCRIPTION": "all", "ENV": f"E-{i}"} for i in range(16)]
        + [{"DESCRIPTION": "one", "ENV": "E-0"}]
        + [{"DESCRIPTION": "three", "ENV": f"E-{i}"} for i in range(3)],
    )
    found = rows(presence_totals(presence_cells(frame, GL)))
    assert {r["DESC_KEY"]: r["Pct_Present"] for r in found} == {"all": 100.0, "one": 6.2, "three": 18.8}


def test_names_with_special_characters(spark):
    frame = ledger(spark, GL, [{"DESCRIPTION": "x", "ENV": "A.b`c-1 2", "ACCOUNT": "7"}])
    cells = presence_cells(frame, GL)
    found = presence_enriched(cells, GL, environments(cells))
    assert rows(found)[0]["Acct_A.b`c-1 2"] == "7"


def test_wide_matrices_over_many_environments(spark):
    rng = random.Random(11)
    entries = [
        {
            "DESCRIPTION": rng.choice(["hot", f"k{rng.randrange(30)}"]),
            "ENV": f"L-{rng.randrange(140):03}",
            "ACCOUNT": rng.choice([None, str(rng.randrange(1000))]),
            "TYPE": rng.choice([None, "T", "U"]),
        }
        for _ in range(3000)
    ]
    entries += [{"DESCRIPTION": "all", "ENV": f"L-{i:03}", "ACCOUNT": str(i)} for i in range(140)]
    first, present, described = {}, {}, {}
    for e in entries:
        key = e["DESCRIPTION"]
        described.setdefault(key, key)
        present.setdefault(key, set()).add(e["ENV"])
        for name, prefix in (("ACCOUNT", "Acct_"), ("TYPE", "Type_")):
            if e.get(name) is not None:
                first.setdefault((key, prefix + e["ENV"]), e[name])

    cells = presence_cells(ledger(spark, GL, entries), GL)
    envs = environments(cells)
    assert len(envs) == 140
    expected = {
        key: {"DESC_KEY": key, **{env: int(env in present[key]) for env in envs}} for key in present
    }
    assert by_key(presence_binary(cells, envs)) == expected

    found = by_key(presence_enriched(cells, GL, envs))
    for key, row in expected.items():
        row |= {
            "DESCRIPTION": key,
            "Count_Present": len(present[key]),
            "Pct_Present": pytest.approx(len(present[key]) / 1.4, abs=0.051),
        }
        row |= {p + env: first.get((key, p + env)) for env in envs for p in ("Acct_", "Type_")}
        assert found[key] == row
    assert found["all"]["Pct_Present"] == 100.0


@pytest.mark.parametrize("comp", [GL, CC], ids=lambda c: c.code)
@pytest.mark.parametrize("chunks, size", [(1, 3), (2, 4), (9, 63)])
def test_shards_side_by_side_are_the_matrices(spark, comp, chunks, size):
    rng = random.Random(4)
    entries = [
        {
            "DESCRIPTION": rng.choice(["hot", f"k{rng.randrange(9)}"]),
            "ENV": f"L-{rng.randrange(17):02}",
            comp.number: rng.choice([None, str(rng.randrange(50))]),
            **({"TYPE": rng.choice([None, "T"])} if comp is GL else {}),
        }
        for _ in range(120)
    ] + [{"DESCRIPTION": "lone", "ENV": "L-03", comp.number: None}]
    cells = presence_cells(ledger(spark, comp, entries), comp)
    envs = environments(cells)
    binary, enriched = presence_binary(cells, envs), presence_enriched(cells, comp, envs)
    shards = list(presence_shards(cells, comp, chunks, size))
    assert [env for shard in shards for env in shard.envs] == envs
    assert all(len(shard.envs) == chunks * size for shard in shards[:-1])
    for whole, field, lead in ((binary, "binary", None), (enriched, "enriched", presence_totals(cells))):
        parts = [getattr(shard, field) for shard in shards] + ([] if lead is None else [lead])
        beside = parts[0]
        for part in parts[1:]:
            beside = beside.join(part, "DESC_KEY")
        assert sorted(beside.columns) == sorted(whole.columns)
        assert by_key(beside) == by_key(whole)
    index = shard_index([(s.number, s.envs) for s in shards], comp, spark).collect()
    assert {(r.SHARD, r.COLUMN) for r in index} == {
        (s.number, c) for s in shards for c in s.enriched.columns if c != "DESC_KEY"
    }
    assert all(r.COLUMN.endswith(r.ENV) for r in index)


def test_no_shards_of_nothing(spark):
    cells = presence_cells(ledger(spark, GL, [{"DESCRIPTION": "a", "ENV": "L-1"}]).limit(0), GL)
    assert [(s.envs, s.binary.count(), s.enriched.columns) for s in presence_shards(cells, GL)] == [([], 0, ["DESC_KEY"])]
