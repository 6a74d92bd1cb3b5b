"""Language ID: profiles by brute force, predictions."""

from collections import Counter

import pytest

from ledgerweave.llm import langid
from ledgerweave.llm.common import table

SF = "/root/testdata/sf0.001"


def grams(text):
    """The n-grams of a text, as packed numbers, by plain means."""
    found = Counter()
    word = "".join(c if c.isalpha() else " " for c in text.lower())
    for w in word.split():
        s = [langid.EDGE, *(ord(c) + 2 for c in w), langid.EDGE]
        for i in range(1, len(s) - 1):
            found[s[i]] += 1
            found[(s[i] << 21) | s[i + 1]] += 1
            if i == 1:
                found[(s[0] << 21) | s[1]] += 1
            found[(s[i - 1] << 42) | (s[i] << 21) | s[i + 1]] += 1
    return found


@pytest.mark.parametrize(
    "text", ["Äpfel, birne!! x", "a", "", "12 _ ?", "éa éa b\n\nc", "İstanbul ǅ 日本語 日", "x" * 50 + " y\u0000z"]
)
def test_counts_equal_brute_force(text):
    is_letter = langid.letters()
    found = {}
    for group, gram, n in langid.count_grams(["zz", text, "y"], [0, 1, 2], is_letter):
        found |= {(int(g), int(x)): int(k) for g, x, k in zip(group, gram, n)}
    assert {x: k for (g, x), k in found.items() if g == 1} == dict(grams(text))
    assert {x: k for (g, x), k in found.items() if g == 2} == dict(grams("y"))


def test_blocks_do_not_matter(monkeypatch):
    is_letter = langid.letters()
    texts = ["hello world", "", "guten tag", "日本 語"] * 5
    want = list(langid.count_grams(texts, list(range(20)), is_letter))
    monkeypatch.setattr(langid, "BLOCK", 12)
    parts = list(langid.count_grams(texts, list(range(20)), is_letter))
    assert len(parts) > 1
    assert [x.tolist() for x in want[0]] == [sum((p[i].tolist() for p in parts), []) for i in range(3)]


def test_profiles_and_distances_equal_brute_force(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "the end", "en"), (4, None, "en"), (5, "x", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.train(labelled)
    want = {}
    for lang in ("en", "de"):
        total = sum((grams(t) for _, t, k in rows if k == lang and t), Counter())
        want[lang] = {g: i for i, (g, _) in enumerate(sorted(total.items(), key=lambda x: (-x[1], x[0]))[: langid.PROFILE])}
    assert {(r.lang, r.gram): r.place for r in profiles.collect()} == {
        (k, g): i for k, p in want.items() for g, i in p.items()
    }
    texts = ["the dog", "und der", "zzz", "", None, "123", "katze the"]
    asked = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    for row in langid.predict(asked, profiles).collect():
        own = sorted(grams(texts[row.doc_id] or "").items(), key=lambda x: (-x[1], x[0]))[: langid.OWN]
        if not own:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        far = {
            k: sum(abs(p[g] - i) if g in p else langid.PROFILE for i, (g, _) in enumerate(own)) for k, p in want.items()
        }
        best = min(sorted(far), key=far.get)
        assert row.lang_pred == best
        assert row.score == pytest.approx(1 - far[best] / (len(own) * langid.PROFILE))


def test_nothing_learned_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    profiles = langid.train(none)
    asked = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [tuple(r) for r in langid.predict(asked, profiles).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert langid.predict(none, profiles).count() == 0


def test_held_out_accuracy(spark):
    from ledgerweave.llm.queries import op2_langid

    told = op2_langid(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = told.filter("held_out").collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
