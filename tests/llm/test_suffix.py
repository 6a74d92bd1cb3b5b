"""Repeated passages against brute force."""

import random

import numpy as np
import pytest

from ledgerweave.llm import suffix


def brute(rows):
    seen, found = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - suffix.LENGTH + 1):
            piece = data[p : p + suffix.LENGTH]
            if piece in seen:
                gone[p : p + suffix.LENGTH] = b"\1" * suffix.LENGTH
            seen.add(piece)
        found[doc] = bytes(b for b, g in zip(data, gone) if not g)
    return found


def documents(seed=2):
    chance = random.Random(seed)

    def prose(n):
        return "".join(chance.choices("abcdefgh ijß日\n", k=n))

    passages = [prose(n) for n in (60, 95, 99, 100, 101, 103, 130, 400)]
    rows = [(i, prose(chance.randrange(400)) + chance.choice(passages) + prose(chance.randrange(300))) for i in range(60)]
    base = prose(900)
    for i in range(12):
        own = list(base)
        for _ in range(chance.randrange(12)):
            own[chance.randrange(len(own))] = chance.choice("xyz")
        rows.append((100 + i, "".join(own)))
    rows += [(200, base), (201, base), (202, "a" * 700), (203, "ab" * 300 + "a" * 150), (204, None), (205, ""), (206, "a" * 100)]
    rows += [(300 + i, prose(80) + "the very same line of some ninety-six letters, in more surroundings than fit one bucket, so." + prose(80)) for i in range(30)]
    return rows


@pytest.mark.parametrize("setting", [{}, {"STRINGS": 3}, {"BATCH": 1000, "BLOCK": 3000, "SHARDS": 2}])
def test_equals_brute_force(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(suffix, name, value)
    rows = documents()
    df = spark.createDataFrame([(i, t, 0, "clash") for i, t in rows], "doc_id long, text string, start int, spans string")
    found = suffix.remove_repeats(df.repartition(4)).collect()
    assert {r.doc_id: bytes(r.kept) for r in found} == brute(rows)
    for r in found:
        assert sum(s["stop"] - s["start"] for s in r.spans) == r.n_bytes - len(r.kept)
        assert all(a["stop"] < b["start"] for a, b in zip(r.spans, r.spans[1:]))
    assert found[0].start == 0


def test_suffix_arrays():
    for text in (b"mississippi", b"aaaaaaaaaaaaaaaaaaaaaaaaa", b"abcabcabcabcabcabcabcabc", b"z"):
        symbols = np.concatenate((np.frombuffer(text, np.uint8) + suffix.SHIFT, [0])).astype(np.uint8)
        want = sorted(range(len(symbols)), key=lambda i: symbols[i:].tobytes())
        assert suffix.suffix_array(symbols).tolist() == want


def test_merged_transforms_are_in_order():
    chance = random.Random(4)
    texts = [bytes(chance.choices(b"abc", k=n)) for n in (40, 1, 25, 60)]
    transforms, suffixes = [], []
    for text in texts:
        symbols = np.concatenate((np.frombuffer(text, np.uint8) + suffix.SHIFT, [0])).astype(np.uint8)
        order = suffix.suffix_array(symbols)
        transforms.append(symbols[order - 1])
        suffixes += [symbols[i:].tobytes() for i in order]
    merged, block = suffix.merge_transforms(transforms, 6)
    heads = [suffixes[i][:6] for i in merged]
    every = [x[:6] for x in suffixes if len(x) > 6]
    assert heads == sorted(x for x in every if every.count(x) > 1)
    for i in range(len(heads) - 1):
        assert (block[i] == block[i + 1]) == (heads[i] == heads[i + 1])


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    rows = [(None, text), (None, text), (5, text), (5, text), (9, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id is not None, len(r.kept)) for r in suffix.remove_repeats(df).collect()))
    assert found == [(False, 300), (False, 300), (True, 0), (True, 0), (True, 5)]
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_texts_without_ids_of_their_own(spark):
    chance = random.Random(7)

    def prose(n):
        return "".join(chance.choices("abcdefgh", k=n))

    passage, shared = prose(150), prose(120)
    rows = [(None, prose(n) + passage + prose(n)) for n in (5, 300, 20, 900)] + [(None, prose(400)), (None, prose(30)), (None, None)]
    rows += [(-(1 << 63), prose(50) + shared), (3, prose(700) + shared + prose(9)), (3, prose(150)), (3, shared + prose(3)), (8, passage + prose(200))]
    rows += [rows[1], rows[8]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffix.remove_repeats(df).collect()
    assert len(found) == len(rows)
    # In order of doc_id, null first, then of the text's hash; copies are one document.
    number = {r.text: r.number for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS number").collect()}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, number[r[1]]))
    want = brute(list(enumerate(t for _, t in order)))
    assert {(r.doc_id, r.text, bytes(r.kept)) for r in found} == {(*r, want[i]) for i, r in enumerate(order)}
    assert sum(len(w) < len(t or "") for w, (_, t) in zip(want.values(), order)) == 6


def test_strings_of_one_core_are_merged_without_it(spark, monkeypatch):
    """What all strings of a core share is dealt out and merged as a few symbols, not byte for byte."""
    chance = random.Random(9)

    def prose(n):
        return "".join(chance.choices("abcdefgh", k=n))

    middle = prose(160)
    rows = [(i, prose(40) + middle + prose(40), [(100, 255), (110, 24)]) for i in range(30)]
    rows.append((99, "", []))
    places = spark.createDataFrame(rows, "doc long, text string, places array<struct<start:bigint,ranges:int>>")
    strings = suffix._strings(places.repartition(2)).sort("core", "doc", "start")
    assert {f.dataType.typeName() for f in strings.schema} <= {"long", "integer"}
    seen = []
    merge = suffix.merge_transforms
    monkeypatch.setattr(suffix, "merge_transforms", lambda t, n: seen.append((sum(map(len, t)), n)) or merge(t, n))
    table = strings.toArrow()
    suffix._chunk_repeats(table)
    (symbols, passes), = seen
    assert symbols <= 3 * suffix.SLACK * len(table) and passes <= 2 * suffix.SLACK


def test_documents_without_repeats_need_no_python(spark):
    chance = random.Random(11)
    rows = [(i, "".join(chance.choices("abcdß", k=200)), "own") for i in range(6)] + [(7, None, "own")]
    rows.append((8, rows[2][1] + "end", "own"))
    df = spark.createDataFrame(rows, "doc_id long, text string, `a column` string")
    found = {r.doc_id: r for r in suffix.remove_repeats(df).collect()}
    assert {i: len(r.spans) for i, r in found.items()} == dict.fromkeys([*range(6), 7], 0) | {8: 1}
    assert all(bytes(found[i].kept) == (t or "").encode() and found[i].n_bytes == len(found[i].kept) for i, t, _ in rows[:7])
    assert bytes(found[8].kept) == b"end" and found[8]["a column"] == "own"
