"""Benchmark passages against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from ledgerweave.llm import decontam
from ledgerweave.llm.shingles import as_multiset

WORDS = [f"w{i}" for i in range(300)]


def pieces(words):
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def brute(documents, items):
    found = {}
    for d, text in documents:
        words = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            want, size = pieces(own), min(len(own), len(words))
            for at in range(len(words) - size + 1 if size else 0):
                have = pieces(words[at : at + size])
                if min(5, len(own)) != min(5, size):
                    continue
                s = sum((have & want).values()) / sum((have | want).values())
                if s >= 0.8:
                    found[d, i] = max(found.get((d, i), 0), s)
    return found


def tables(seed=1):
    chance = random.Random(seed)
    items = [(i, " ".join(chance.choices(WORDS, k=n))) for i, n in enumerate((1, 3, 4, 5, 6, 8, 15, 15, 30, 59, 59))]
    items += [(50, "same words same words same words same words same words"), (51, None), (52, " "), (53, items[8][1])]
    documents = []
    for d in range(60):
        _, item = chance.choice(items[2:12])
        own = item.split()
        for _ in range(chance.randrange(3)):
            own[chance.randrange(len(own))] = chance.choice(WORDS)
        around = [" ".join(chance.choices(WORDS, k=chance.randrange(80))) for _ in range(2)]
        documents.append((d, f"{around[0]} {chance.choice([str, str.upper])(' '.join(own))}\n{around[1]}"))
    documents += [(70, None), (71, ""), (72, items[9][1]), (73, " ".join(items[9][1].split()[:55])), (74, items[8][1] * 2), (75, items[10][1] + " ." * 3000)]
    return documents, items


def run(spark, documents, items):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in documents], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, size int")
    return {(r.doc_id, r.item_id): r.similarity for r in decontam.find_leaks(docs, bench).collect()}


def test_equals_brute_force(spark):
    documents, items = tables()
    found, want = run(spark, documents, items), brute(documents, items)
    assert found.keys() == want.keys() and len(want) > 20
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_empty_tables_and_repeated_rows(spark):
    documents, items = tables()
    assert run(spark, [], items) == run(spark, documents, []) == {}
    again = [(None, items[8][1]), (None, items[8][1]), (3, items[8][1])]
    assert set(run(spark, again, items[8:9] * 2)) == {(None, 8), (3, 8)}


def test_blocks_find_all_fingerprints_in_reach():
    reach = decontam.RADIUS // decontam.BLOCKS
    chance = random.Random(2)
    for _ in range(300):
        a = chance.getrandbits(64)
        b = a
        for bit in chance.sample(range(64), decontam.RADIUS):
            b ^= 1 << bit
        apart = [((a ^ b) >> low & ((1 << (high - low)) - 1)).bit_count() for low, high in decontam._block_bounds()]
        assert min(apart) <= reach
    assert len(decontam.changes(9, reach)) == 1 + 9 + 36


def test_similar_multisets_have_near_fingerprints():
    chance = np.random.default_rng(3)
    far = []
    for _ in range(2000):
        base = chance.integers(0, 1 << 63, 45, dtype=np.uint64)
        other = base.copy()
        other[:5] = chance.integers(0, 1 << 63, 5, dtype=np.uint64)  # similarity 0.8
        far.append(((decontam.simhash(base) ^ decontam.simhash(other)) & ((1 << 64) - 1)).bit_count())
    assert np.mean(np.array(far) <= decontam.RADIUS) >= 0.99


def test_multisets_count_copies():
    made = as_multiset(np.array([5, 7, 5, 5], np.uint64))
    assert len(set(made.tolist())) == 4 and made[1] == 7 and made[0] == 5
    assert set(as_multiset(np.array([5, 5], np.uint64)).tolist()) < set(made.tolist())
