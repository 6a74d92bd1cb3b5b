import random
from collections import Counter

import pytest
from frames import ledger, rows

from ledgerweave.component import CC, GL
from ledgerweave.operators import (
    MergeSpec,
    merge_actions,
    merge_conflicts,
    merge_mappings,
    number_folds,
    unify,
)
from ledgerweave.operators.merge import (
    CROSS_CHECK,
    NO_CANONICAL,
    SAME_IN_TARGET,
    SUGGEST_CREATE,
    SUGGEST_KEEP,
    SUGGEST_MAP,
    TAKEN_IN_TARGET,
)

SPEC = {
    "sources": [{"datalib": "L1", "company": 1}, {"datalib": "L2", "company": 2}],
    "target": {"datalib": "L3", "company": 3},
}


def spec(strategy="pick_majority", preferred=None):
    return MergeSpec.from_dict(
        {**SPEC, "numbering_strategy": strategy, "preferred_env": preferred}
    )


def accounts(spark, *entries):
    names = ("DESCRIPTION", "ENV", "ACCOUNT", "TYPE", "DESCRIPTION_LANG")
    return ledger(spark, GL, [dict(zip(names, entry)) for entry in entries])


def unified(frame, comp, rules):
    return unify(number_folds(frame, comp, rules), comp, rules)


def conflicts(frame, comp, rules, **options):
    folds = number_folds(frame, comp, rules)
    return merge_conflicts(frame, folds, unify(folds, comp, rules), comp, rules, **options)


def actions(frame, comp, rules):
    return merge_actions(frame, unified(frame, comp, rules), comp, rules)


def mappings(frame, comp, rules):
    return merge_mappings(frame, unified(frame, comp, rules), comp, rules)


def test_majority(spark):
    frame = accounts(
        spark, ("Rent", "L2-2", "731", "cost", "Rent paid"), ("Rent", "L1-1", "48", "cost", None),
        ("Rent", "L2-2", "48", "cost", None), ("Rent", "L1-1", "9", "sale", None), ("Rent", "L1-1", "48", None, None),
    )
    found = unified(frame, GL, spec())
    assert found.columns == [
        "DESC_KEY", "DESCRIPTION", "ACCOUNT_CANONICAL", "TYPE_CANONICAL",
        "DESCRIPTION_LANG_CANONICAL", "Why_Canonical",
    ]
    assert [tuple(r) for r in found.collect()] == [
        ("rent", "Rent", "48", "cost", "Rent paid", "pick_majority")
    ]
    assert rows(conflicts(frame, GL, spec())) == [
        {"DESC_KEY": "rent", "DESCRIPTION": "Rent", "Numbers": "48, 731, 9", "Types": "cost, sale",
         "Why_Canonical": "pick_majority"}
    ]
    (action,) = rows(actions(frame, GL, spec()))
    assert (action["ActionType"], action["Reason"]) == ("Create", "Target mist nummer")
    assert (action["ENV"], action["DATALIB"], action["COMPANY"]) == ("L3-3", "L3", "3")


def test_cost_centers(spark):
    frame = ledger(
        spark,
        CC,
        [
            {"DESCRIPTION": "A", "ENV": env, "COSTCENTER": "10", "DESCRIPTION_LANG": "A"}
            for env in ("L1-1", "L2-2")
        ],
    )
    found = unified(frame, CC, spec())
    assert [tuple(r) for r in found.collect()] == [("a", "A", "10", "A", "pick_majority")]
    assert "TYPE_CANONICAL" not in found.columns
    assert rows(conflicts(frame, CC, spec())) == []
    assert actions(frame, CC, spec()).columns[-1] == "COSTCENTER"
    found = mappings(frame, CC, spec())
    assert {(r["Source_ENV"], r["Same_Number"], r["Suggested_Action"]) for r in rows(found)} == {
        ("L1-1", True, SUGGEST_KEEP),
        ("L2-2", True, SUGGEST_KEEP),
    }


def test_tied_majority_takes_the_first_seen(spark):
    frame = accounts(
        spark, ("A", "L1-1", "9", None), ("A", "L1-1", "5", None), ("A", "L2-2", "5", None),
        ("A", "L2-2", "9", None), ("A", "L1-1", None, None), ("A", "L1-1", None, None),
        ("A", "L2-2", None, None),
    )
    assert rows(unified(frame, GL, spec()))[0]["ACCOUNT_CANONICAL"] == "9"


@pytest.mark.parametrize(
    "strategy, number, why",
    [
        ("first", "7", "first"),
        ("pick_majority", "8", "pick_majority"),
        ("new_range", None, "new_range"),
        ("keep_preferred", "9", "keep_preferred(L2-2)"),
        (" KEEP_PREFERRED ", "9", "keep_preferred(L2-2)"),
    ],
)
def test_strategies(spark, strategy, number, why):
    frame = accounts(
        spark, ("A", "L1-1", None, None), ("A", "L1-1", "7", None), ("A", "L1-1", "8", None),
        ("A", "L1-1", "8", None), ("A", "L2-2", "9", None), ("A", "L2-2", "8", None),
        ("none", "L1-1", None, None), ("elsewhere", "L9-9", "1", None),
    )
    found = {r["DESC_KEY"]: r for r in rows(unified(frame, GL, spec(strategy, "L2-2")))}
    assert set(found) == {"a", "none"}
    assert (found["a"]["ACCOUNT_CANONICAL"], found["a"]["Why_Canonical"]) == (number, why)
    assert (found["none"]["ACCOUNT_CANONICAL"], found["none"]["Why_Canonical"]) == (
        None,
        "no_number",
    )


def test_preferred_environment_goes_by_its_first_row(spark):
    frame = accounts(
        spark, ("A", "L1-1", "1", None), ("A", "L2-2", None, None), ("A", "L2-2", "2", None),
        ("B", "L1-1", "3", None),
    )
    found = {r["DESC_KEY"]: r for r in rows(unified(frame, GL, spec("keep_preferred", "L2-2")))}
    assert (found["a"]["ACCOUNT_CANONICAL"], found["a"]["Why_Canonical"]) == ("1", "pick_majority")
    assert (found["b"]["ACCOUNT_CANONICAL"], found["b"]["Why_Canonical"]) == ("3", "pick_majority")
    outside = unified(frame, GL, spec("keep_preferred", "L3-3"))
    assert {r["Why_Canonical"] for r in rows(outside)} == {"pick_majority"}


def test_description_falls_back_to_the_key(spark):
    frame = ledger(
        spark,
        GL,
        [
            {"DESC_KEY": "k1", "DESCRIPTION": None, "ENV": "L1-1"},
            {"DESC_KEY": "k2", "DESCRIPTION": "", "ENV": "L1-1"},
            {"DESC_KEY": "k3", "DESCRIPTION": None, "ENV": "L1-1"},
            {"DESC_KEY": "k3", "DESCRIPTION": "K3", "ENV": "L1-1"},
        ],
    )
    assert {r["DESCRIPTION"] for r in rows(unified(frame, GL, spec()))} == {"k1", "k2", "K3"}


def test_conflicts_over_types_alone(spark):
    frame = accounts(
        spark, ("A", "L1-1", None, "u"), ("A", "L2-2", None, "t"), ("B", "L1-1", "1", "t"),
        ("B", "L2-2", "1", None),
    )
    (found,) = rows(conflicts(frame, GL, spec()))
    assert (found["DESC_KEY"], found["Numbers"], found["Types"]) == ("a", "", "t, u")
    assert found["Why_Canonical"] == "no_number"


def test_hot_conflicts_are_one_row(spark):
    frame = accounts(
        spark,
        *(("hot", "L1-1", str(i), f"t{i % 7}") for i in range(300)),
        ("cold", "L1-1", "1", "t"),
        ("cold", "L2-2", "2", "t"),
    )
    numbers = sorted(str(i) for i in range(300))
    found = rows(conflicts(frame, GL, spec()))
    whole = {r["DESC_KEY"]: (r["Numbers"], r["Types"]) for r in found}
    assert whole["hot"] == (", ".join(numbers), ", ".join(f"t{i}" for i in range(7)))
    assert whole["cold"] == ("1, 2", "t")


def test_actions_in_the_target(spark):
    frame = accounts(
        spark,
        ("same", "L1-1", "1", None),
        ("differs", "L1-1", "2", None),
        ("missing", "L1-1", "3", None),
        ("blank", "L1-1", "4", None),
        ("taken", "L1-1", "5", None),
        ("nothing", "L1-1", None, None),
        ("same", "L3-3", "1", None),
        ("differs", "L3-3", "20", None),
        ("blank", "L3-3", None, None),
        ("Other", "L3-3", "5", None),
        ("nothing", "L3-3", "6", None),
    )
    listed = rows(actions(frame, GL, spec()))
    found = {r["DESCRIPTION"]: (r["ActionType"], r["Reason"]) for r in listed}
    assert found == {
        "same": ("Review", SAME_IN_TARGET),
        "differs": ("Review", CROSS_CHECK),
        "missing": ("Create", "Target mist nummer"),
        "blank": ("Create", "Target mist nummer"),
        "taken": ("Review", TAKEN_IN_TARGET + "Other"),
        "nothing": ("Create", NO_CANONICAL),
    }


def test_actions_for_each_own_number_name_the_first_other_holder(spark):
    frame = accounts(
        spark,
        ("a", "L1-1", "1", None),
        ("c", "L2-2", "1", None),
        ("d", "L2-2", "4", None),
        ("a", "L3-3", "1", None),
        ("a", "L3-3", "2", None),
        ("a", "L3-3", "2", None),
        ("b", "L3-3", "1", None),
        ("B", "L3-3", "1", None),
        ("z", "L3-3", "1", None),
        ("d", "L3-3", "4", None),
        ("d", "L3-3", "4", None),
    )
    found = Counter((r["DESCRIPTION"], r["Reason"]) for r in rows(actions(frame, GL, spec())))
    assert found == {
        ("a", TAKEN_IN_TARGET + "b"): 2,
        ("c", TAKEN_IN_TARGET + "a"): 1,
        ("d", SAME_IN_TARGET): 1,
    }


def test_mappings(spark):
    frame = accounts(
        spark,
        ("A", "L1-1", "100", None),
        ("A", "L1-1", "100", None),
        ("A", "L2-2", "200", None),
        ("a", "L2-2", None, None),
        ("B", "L2-2", None, None),
        ("C", "L9-9", "1", None),
    )
    found = mappings(frame, GL, spec())
    assert found.columns == [
        "Source_ENV", "DATALIB", "COMPANY", "DESCRIPTION", "ACCOUNT_SOURCE", "ACCOUNT_CANONICAL",
        "Same_Number", "Suggested_Action", "Target_ENV", "Why_Canonical",
    ]
    picked = {
        (r["Source_ENV"], r["DESCRIPTION"], r["ACCOUNT_SOURCE"], r["ACCOUNT_CANONICAL"],
         r["Same_Number"], r["Suggested_Action"])
        for r in rows(found)
    }
    assert found.count() == 4
    assert picked == {
        ("L1-1", "A", "100", "100", True, SUGGEST_KEEP),
        ("L2-2", "A", "200", "100", False, SUGGEST_MAP),
        ("L2-2", "a", None, "100", False, SUGGEST_MAP),
        ("L2-2", "B", None, None, False, SUGGEST_CREATE),
    }


def test_sources_without_rows_give_empty_tables(spark):
    frame = accounts(spark, ("A", "L9-9", "1", None))
    for build in (unified, conflicts, actions, mappings):
        assert rows(build(frame, GL, spec())) == []


@pytest.mark.parametrize("strategy", ["pick_majority", "first", "keep_preferred"])
def test_choice_against_brute_force(spark, strategy):
    rng = random.Random(3)
    entries = [
        (
            "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}",
            rng.choice(["L1-1", "L2-2", "L4-4"]),
            None if rng.random() < 0.3 else str(rng.randrange(6)),
            None,
        )
        for _ in range(500)
    ]
    expected = {}
    for key in {e[0] for e in entries if e[1] != "L4-4"}:
        mine = [e for e in entries if e[0] == key and e[1] != "L4-4"]
        numbers = [e[2] for e in mine if e[2] is not None]
        preferred = [e[2] for e in mine if e[1] == "L2-2"]
        if not numbers:
            expected[key] = None
        elif strategy == "first":
            expected[key] = numbers[0]
        elif strategy == "keep_preferred" and preferred and preferred[0] is not None:
            expected[key] = preferred[0]
        else:
            expected[key] = max(numbers, key=lambda n: (numbers.count(n), -numbers.index(n)))
    found = unified(accounts(spark, *entries), GL, spec(strategy, "L2-2"))
    assert {r["DESC_KEY"]: r["ACCOUNT_CANONICAL"] for r in rows(found)} == expected


@pytest.mark.parametrize(
    "change",
    [
        {"scope": ["GL", "XX"]},
        {"numbering_strategy": "random"},
        {"numbering_strategy": "keep_preferred"},
        {},
        {"numbering_strategy": "first", "target": {"datalib": "L"}},
    ],
)
def test_invalid_specs(change):
    with pytest.raises(ValueError):
        MergeSpec.from_dict({**SPEC, **change})


def test_specs_are_normalised():
    read = MergeSpec.from_dict(
        {
            "sources": [{"datalib": " T ", "bedrijf": "1"}, {"datalib": "T", "company": 1}],
            "target": {"datalib": "T-B", "bedrijf": "99"},
            "scope": [" gl "],
            "numbering_strategy": " First ",
        }
    )
    assert (read.scope, read.numbering_strategy) == (("GL",), "first")
    assert (read.source_names, read.target.name) == (["T-1"], "T-B-99")
