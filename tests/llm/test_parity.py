"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from ledgerweave.llm import parity
from ledgerweave.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                above[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(s), least[top(i)]) for i, (d, s) in enumerate(sets))


def documents(seed=3):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1

    line = " ".join(chance.choices(words, k=12))
    for size in (1, 2, 4, 5, 6, 9, 12, 20, 40, 41, 60, 130, 260, 300, 520):
        base = chance.choices(words, k=size)
        add(" ".join(base))
        for edits in (0, 1, 2, 3, 5, 8, 13):
            own = list(base)
            for _ in range(edits):
                at = chance.randrange(len(own) + 1)
                own[at : at + chance.randrange(2)] = chance.choices(words, k=chance.randrange(3))
            add(chance.choice([" ", "\n", "\t "]).join(own).upper())
        add(f"{line}\n{' '.join(chance.choices(words, k=size))}")
    for text in (None, "", " \n\t", " ", line):
        add(text)
    base = chance.choices(words, k=90)  # a crowded group, partly alike
    for _ in range(40):
        own = list(base)
        for _ in range(chance.randrange(8)):
            own[chance.randrange(90)] = chance.choice(words)
        add(" ".join(own))
    return rows


@pytest.mark.parametrize("bucket", [2, 8])
def test_equals_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(parity, "BUCKET", bucket)
    rows = documents()
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, set_id string")
    found = parity.near_duplicates(df.repartition(3)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_similar_sets_share_a_signature():
    chance = np.random.default_rng(1)
    for n in (5, 10, 31, 33, 64, 100, 127, 128, 260, 1000, 2100):
        for _ in range(30):
            base = chance.integers(0, 1 << 63, n, dtype=np.uint64)
            drop = chance.integers(0, n // 10 + 1)
            more = chance.integers(0, 1 << 63, n // 10, dtype=np.uint64)
            other = np.concatenate((base[drop:], more))
            common, every = n - drop, n + len(more)
            if 100 * common < 80 * every:
                continue
            a, b = parity.signatures(base), parity.signatures(other)
            assert np.intersect1d(a, b).size
            x, y = parity.bit_sketch(base), parity.bit_sketch(other)
            words = min(len(x), len(y))
            apart = np.bitwise_count(parity.folded(x, words) ^ parity.folded(y, words)).sum()
            assert apart <= drop + len(more) <= parity.most_apart(len(base), len(other))


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (None, "other words that stand alone here"), (4, text), (4, text), (2, text + " z"), (7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r[0], r[2]) for r in parity.near_duplicates(df).collect()), key=str)
    assert found == sorted([(None, 2), (None, None), (4, 2), (4, 2), (2, 2), (7, 7)], key=str)
    assert parity.near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert found == want


@pytest.mark.parametrize("length", [64, 1024, 4096])
def test_patterned_words_do_not_collide(spark, length):
    turns = [bin(i).count("1") % 2 for i in range(length)]
    rows = [(i, "".join("ab"[t ^ i] for t in turns)) for i in range(2)]
    rows += [(2, "a" * length), (3, "a" * (length + 1)), (4, "a" * (length - 1) + "b"), (5, "A" * length)]
    found = parity.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 2}
