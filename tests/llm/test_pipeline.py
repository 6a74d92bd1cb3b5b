"""The pipeline: each stage against brute force on what its predecessor kept."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerweave.llm.common import materialise, table

from .test_decontam import brute as brute_leaks
from .test_parity import brute as brute_groups
from .test_suffix import brute as brute_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(materialise(stage(spark, results[-1], SF)))
    return results


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_return_documents(stages):
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[:-1])
    assert set(stages[0].columns) < set(stages[-1].columns)


def test_clean_documents_have_a_language(stages):
    assert {d for d, _ in pairs(stages[0])} == {d for d, _ in pairs(stages[1])}


def test_one_document_of_each_group_stays(stages):
    groups = brute_groups(pairs(stages[1]))
    assert sorted(d for d, _ in pairs(stages[2])) == sorted(d for d, _, top in groups if d == top)


def test_repeats_go(stages):
    left = brute_repeats(pairs(stages[2]))
    want = {d: b.decode("utf-8", errors="replace") for d, b in left.items()}
    want = {d: t for d, t in want.items() if t or not dict(pairs(stages[2]))[d]}
    assert dict(pairs(stages[3])) == want
    assert all(r.n_chars == len(r.text) for r in stages[3].select("text", "n_chars").collect())


def test_leaks_go(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    given = pairs(stages[3])
    leaks = {d for d, _ in brute_leaks(given, items)}
    assert leaks
    assert {d for d, _ in pairs(stages[4])} == {d for d, _ in given} - leaks


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r.round_trip and r.ids == library.encode(r.text, add_special_tokens=False).ids


def test_run_gives_the_same(spark, stages):
    def digest(df):
        return sorted(hashlib.sha256(repr((r.doc_id, r.text, r.ids)).encode()).hexdigest() for r in df.collect())

    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages[5])


def test_odd_documents_pass_through(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "the and of the", "en", "s", 3), (2, "the and of the", "en", "s", 3), (3, "word " * 30_000, "en", "s", 1), (4, "123", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS ids", "2 AS component_id")
    for source in (docs, docs.limit(0)):
        found = source
        for _, stage in corpus_pipeline.STAGES:
            found = materialise(stage(spark, found, SF))
        assert {r.doc_id for r in found.collect()} == ({2, 3} if source is docs else set())
        assert found.count() == (2 if source is docs else 0)


def test_repeats_that_end_inside_a_character_leave_the_rest(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(90)) + " the passage that all of these share"
    rows = [
        (1, f"first ũ{passage}é one", "", "", 0),
        (2, f"second {passage}è two", "", "", 0),  # the lead byte of its e-grave repeats
        (3, f"third é{passage}è-three", "", "", 0),  # and the last one of its e-acute; the rest makes a letter
        (4, f"é{passage}è", "", "", 0),
        (5, "fifth é", "", "", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.without_repeats(spark, docs, SF).collect()
    assert {r.doc_id: r.text for r in left} == {1: rows[0][1], 2: "second  two", 3: "third -three", 5: "fifth é"}
    assert all(r.n_chars == len(r.text) for r in left)


def test_texts_are_grouped_whatever_their_ids(spark):
    def words(name):
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [
        (None, words("a"), "x"), (None, words("b"), "x"), (None, words("c"), "x"), (None, words("c") + " more", "x"),
        (None, words("d"), "x"), (6, words("d") + " more", "x"), (5, words("d"), "x"),
        (7, words("e"), "x"), (7, words("f"), "x"), (7, words("d") + " other", "x"),
        (8, words("g"), "z"), (8, words("g"), "y"), (None, words("h"), "z"), (None, words("h"), "y"),
        (None, "", "x"), (None, None, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    found = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()]
    group_c = [r for r in found if r[1] and r[1].startswith("c0 ")]
    assert len(group_c) == 1 and group_c[0] in rows
    want = [rows[i] for i in (0, 1, 6, 7, 8, 11, 13, 14, 15)]
    assert sorted(set(found) - set(group_c), key=str) == sorted(want, key=str) and len(found) == 10


def test_documents_leak_for_themselves(spark):
    """Neither a missing doc_id nor a shared one makes a clean document go."""
    item = next(r.text for r in table(spark, SF, "benchmark").collect() if len(r.text.split()) > 12)
    rows = [(None, item), (None, "clean without id"), (7, "clean"), (8, f"so {item}"), (8, "clean beside it"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.without_benchmark(spark, docs, SF).collect()
    assert {(r.doc_id, r.text) for r in left} == {rows[i] for i in (1, 2, 4, 5)} and len(left) == 4


def test_columns_called_like_ours_stay(spark):
    words = " ".join(f"w{i}" for i in range(30))
    names = "_place _doc _found spans kept n_bytes _lang _score told score _row row own again touched _decoded one n component".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, f"the {chr(97 + i) * 40} of {words} and {i}", "en", "s", 1, *(f"{n}{i}" for n in names)) for i in range(2)]
    found = spark.createDataFrame(rows, schema)
    before = found.columns
    for _, stage in corpus_pipeline.STAGES:
        found = materialise(stage(spark, found, SF))
    assert found.columns == [*before, "ids", "n_tokens", "round_trip"]
    for r in found.collect():
        assert all(r[n] == f"{n}{r.doc_id}" for n in names)
