"""Mixing sources against the words themselves, in lists."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerweave.llm import mix

SCHEMA = "doc_id long, text string, source string"


def some_rows(seed=1, n=120):
    chance = random.Random(seed)
    names = ["b", "a", "é", "", "Z", None, "zz", "\U0001f600"]
    rows = []
    for i in range(n):
        size = chance.choice([0, 1, 3, 40, 400])
        rows.append((i, " ".join(f"w{j}" for j in range(size)), chance.choices(names, [30, 2, 1, 1, 8, 5, 1, 1])[0]))
    rows += [(5, "  x\x0b\x0cy\x1cz\t", "a"), (None, None, "a"), (None, "one two", None), (None, "one two", None)]
    return rows


def plain_targets(words):
    """Targets by source: excess handed on until no source is above twice its words."""
    names = sorted((s for s in words if s is not None), key=lambda s: s.encode()) + ([None] if None in words else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = 3 * sum(words.values()) - 2 * sum(2 * words[s] for s in capped)
        among = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * left > 2 * among * 2 * words[s]}
        if not over:
            break
        capped |= over
    return {s: float(2 * words[s]) if s in capped else float(weight[s] * left) / float(2 * among) for s in names}


def size_of(text):
    return len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])


@pytest.mark.parametrize("block, shard_slots, fan", [(16, 32, 1024), (7, 10, 2), (256, 8192, 3)])
def test_words_taken_are_those_of_the_slots(spark, block, shard_slots, fan):
    rows = some_rows()
    found = mix.mix(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block, shard_slots=shard_slots, fan=fan)
    documents = found.documents.collect()
    words = Counter()
    for _, text, source in rows:
        words[source] += size_of(text)
    assert sorted((d.key is None, d.key or 0, d.size) for d in documents) == sorted((k is None, k or 0, size_of(t)) for k, t, _ in rows)
    targets = plain_targets(words)
    stream = defaultdict(list)
    for d in sorted(documents, key=lambda d: (d.rank, d.start, d.size)):
        assert (d.source_size, d.target) == (words[d.source], targets[d.source])
        assert d.start == len(stream[d.rank])
        stream[d.rank] += [(d.row, i) for i in range(d.size)]

    pieces = defaultdict(list)
    for p in found.pieces.collect():
        pieces[p.shard, p.slot].append(p)
    taken, of_source, shards = Counter(), Counter(), Counter()
    used = defaultdict(Counter)
    slots = found.slots.collect()
    for s in slots:
        held = stream[s.rank][s.block * block : s.block * block + s.length]
        assert len(held) == s.length > 0
        told = [(p.row, w) for p in sorted(pieces[s.shard, s.slot], key=lambda p: p.place) for w in range(p.first, p.last)]
        assert told == held
        taken.update(row for row, _ in held)
        of_source[s.rank] += s.length
        used[s.rank][s.block] += 1
        shards[s.shard] += 1
    assert sorted(shards) == list(range(-(-len(slots) // shard_slots)))
    assert all(n == shard_slots for shard, n in shards.items() if shard < max(shards))
    assert sorted((s.shard, s.slot) for s in slots) == [(i // shard_slots, i % shard_slots) for i in range(len(slots))]
    ranks = {d.rank: d.source for d in documents}
    for rank, source in ranks.items():
        assert of_source[rank] == min(int(targets[source] + 0.5), 2 * words[source])
        if used[rank]:
            assert max(used[rank].values()) <= 2 and max(used[rank].values()) - (min(used[rank].values()) if len(used[rank]) * block >= words[source] else 0) <= 1
    totals = sorted((r.key is None, r.key or 0, r.size, r.taken) for r in mix.words_taken(found).collect())
    assert totals == sorted((d.key is None, d.key or 0, d.size, taken[d.row]) for d in documents)
    assert all(t <= 2 * size for *_, size, t in totals)


def test_reruns_agree_on_other_partitions(spark):
    rows = spark.createDataFrame(some_rows(2), SCHEMA)

    def told(frame):
        return sorted(map(str, mix.words_taken(mix.mix(frame, block=16, shard_slots=8)).collect()))

    assert told(rows.repartition(5)) == told(rows.coalesce(1))


def test_shards_draw_by_target(spark):
    rows = [(i, "w " * 100, "ab"[i % 2]) for i in range(400)]
    found = mix.mix(spark.createDataFrame(rows, SCHEMA), block=10, shard_slots=500)
    share = {s.rank: s.slots for s in found.sources.collect()}
    counts = Counter((s.shard, s.rank) for s in found.slots.collect())
    assert share == {0: 4000, 1: 2000}
    for shard in range(11):  # the last takes what evens the sources out
        want = mix.draw(1, shard, 0, 0, 500, [4000, 2000])
        assert abs(counts[shard, 0] - want[0]) <= 60
    same = sum(counts[shard, 0] == mix.draw(1, shard, 0, 0, 500, [4000, 2000])[0] for shard in range(12))
    assert same >= 9
    assert len({counts[shard, 0] for shard in range(12)}) > 6


def test_permutations():
    for size in (1, 2, 3, 4, 5, 16, 17, 1000, 4097):
        index = np.arange(size)
        orders = []
        for key in (1, 2**63 + 5):
            at = mix.permuted(index, np.full(size, size), np.full(size, key, np.uint64))
            assert sorted(at) == list(range(size))
            orders.append(at.tolist())
        assert size < 16 or orders[0] != orders[1]


def test_tables_without_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mix.words_taken(mix.mix(none)).collect() == []
    blank = spark.createDataFrame([(1, " \n", "a", 1), (2, None, None, 2)], SCHEMA + ", taken int")
    assert sorted((r.key, r.size, r.source_size, r.target, r.taken) for r in mix.words_taken(mix.mix(blank)).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
