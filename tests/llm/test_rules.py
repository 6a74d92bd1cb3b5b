"""Quality rules against brute force, robust outliers against numpy."""

import re
from collections import Counter

import numpy as np
import pytest

from ledgerweave.llm import rules
from ledgerweave.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words string"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in rules.SYMBOLS for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_of_odd_texts(spark):
    texts = [
        None, "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "x\n\nx\nx \n\x0bx", "#*$%&|<>",
        "日本 ßß 😀 %", "one two three four five six " * 400, " a  b", "a b c d e f a b c d e g a b c d e",
    ]
    df = spark.createDataFrame([(i, t, "l", "s", "clash") for i, t in enumerate(texts)], SCHEMA)
    for row in rules.judge(df).collect():
        want = counts(texts[row.doc_id])
        assert tuple(row[n] for n in NAMES) == want, texts[row.doc_id]
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (row.base_failed and row.kept)


def test_counts_and_verdicts_of_the_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    found = rules.judge(table(spark, SF, "documents")).collect()
    assert len(found) == len(texts)
    assert all(tuple(r[n] for n in NAMES) == counts(texts[r.doc_id]) for r in found)
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    clean = [r for r in found if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)


def test_outliers_go_even_where_they_are_many(spark):
    chance = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "on", "of", "the", "water", "stones", "light"]

    def text(mark):
        return " ".join(f"{w}{mark}" for w in chance.choice(words, 120)) + f" {chance.integers(1 << 40)}"

    rows = [(i, text("%%%" if i % 5 == 0 else ""), None, "s" if i % 2 else None, "") for i in range(300)]
    found = rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    judged = [r for r in found if not r.base_failed]
    assert len(judged) > 250
    assert {r.kept for r in judged if r.doc_id % 5 == 0} == {False}
    assert {r.kept for r in judged if r.doc_id % 5} == {True}


def test_distances_equal_numpy(spark):
    chance = np.random.default_rng(5)
    rows = chance.normal(size=(400, rules.DIMS)) * 0.3
    names = ", ".join(f"{n} double" for n in rules.STATS)
    df = spark.createDataFrame([("l", "s", i, *map(float, r)) for i, r in enumerate(rows)], f"lang string, source string, i long, {names}")
    found = {r.i: r.distance for r in rules.robust_distances(df).collect()}

    def distances(mean, cov):
        return np.einsum("ni,ij,nj->n", rows - mean, np.linalg.inv(cov), rows - mean)

    floor = np.diag([rules.FLOORS[n] ** 2 for n in rules.STATS])
    order = np.sort(rows, axis=0)
    # quartiles of 400 values as Spark picks them: the last value of each quarter
    low, middle, high = order[99], order[199], order[299]
    spread = np.maximum(np.sqrt(np.diag(floor)), (high - low) / rules.SPREAD)

    def estimate(near):
        return near.mean(axis=0), rules.CONSISTENCY * np.cov(near.T, bias=True) + floor

    def concentrated(mean, cov):
        d = distances(mean, cov)
        place = np.floor(np.log(d + 1e-6) * rules.BINS)
        before = np.array([(place < p).sum() for p in place])
        return estimate(rows[before < rules.SHARE * len(rows)])

    def log_determinant(e):
        return np.linalg.slogdet(e[1])[1]

    tried = [(middle, floor), (middle, np.diag(spread**2)), estimate(rows)]
    for _ in range(rules.MOST_STEPS):
        last, tried = tried, [concentrated(*e) for e in tried]
        if max(abs(log_determinant(x) - log_determinant(y)) for x, y in zip(last, tried)) <= rules.SETTLED:
            break
    d = distances(*min(tried, key=log_determinant))
    best = rules.least_determinants(df.drop("i")).collect()
    assert np.isclose(best[0].determinant, min(map(log_determinant, tried)), atol=0.02)
    assert np.allclose([found[i] for i in range(400)], d, rtol=0.02)


def test_groups_keep_the_start_with_the_least_determinant(spark):
    """A fifth of the rows are a far cluster, which misleads the mean of all of them."""
    chance = np.random.default_rng(8)
    near = chance.normal(size=(400, rules.DIMS)) * 0.3
    far = chance.normal(size=(100, rules.DIMS)) * 0.02 + 6
    names = ", ".join(f"{n} double" for n in rules.STATS)
    rows = [("l", "s", i, *map(float, r)) for i, r in enumerate(np.vstack([near, far]))]
    rows += [(None, None, 1000 + i, *map(float, r)) for i, r in enumerate(near)]
    df = spark.createDataFrame(rows, f"lang string, source string, i long, {names}")
    assert len(rules.least_determinants(df).collect()) == 2
    found = {r.i: r.distance for r in rules.robust_distances(df).collect()}
    assert len(found) == len(rows)
    assert max(found[i] for i in range(400)) < min(found[i] for i in range(400, 500))


@pytest.mark.parametrize("rows", [[], [(1, "only one document of ten words or so, in its group", "x", "y", "")]])
def test_tiny_tables(spark, rows):
    assert rules.judge(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
