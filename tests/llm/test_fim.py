"""Fill-in-middle against a plain cut."""

import hashlib
import random
import re

import pytest

from ledgerweave.llm import fim


def plainly(key, text, shares=fim.Shares()):
    digits = hashlib.sha256(f"{shares.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - shares.plain:
        return len(units), "plain", text, None, None
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < shares.suffix_first:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def some_texts():
    chance = random.Random(3)
    wide = "abcXYZ  \n\t<>PSM$\\é́😀中{}()[]"
    texts = ["".join(chance.choice(wide) for _ in range(chance.randrange(60))) for _ in range(400)]
    return [*texts, None, "", "a", "😀", "<", "x <P> y", "ends <S", "<M>", "$1 \\2", "\r\n"]


@pytest.mark.parametrize("shares", [fim.Shares(), fim.Shares(plain=0, suffix_first=50, seed=9)])
def test_equals_a_plain_cut_and_reads_back(spark, shares):
    texts = dict(enumerate(some_texts()))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    done = fim.rearrange(rows, shares=shares)
    done = done.withColumn("again", fim.restore(done.output, done.form)).collect()
    assert len(done) == len(texts)
    for row in done:
        want = plainly(row.doc_id, texts[row.doc_id], shares)
        assert (row.n_units, row.form, row.output, row.prefix_chars, row.middle_chars) == want
        assert row.again == (texts[row.doc_id] or "")
    assert {row.form for row in done} == ({"plain", "psm", "spm"})


def test_very_long_texts(spark):
    texts = ["ab " * 700_000, "x" * 2_000_000, "😀" * 300_000 + "tail"]
    rows = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    done = fim.rearrange(rows, shares=fim.Shares(plain=0))
    for row in done.withColumn("again", fim.restore(done.output, done.form)).collect():
        text = texts[row.doc_id - 1]
        assert row.again == text
        assert row.output == plainly(row.doc_id, text, fim.Shares(plain=0))[2]


def test_null_keys_repeats_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, FORM string, row int, h int, n int, first int"
    rows = spark.createDataFrame([(None, "one two three", "mine", 1, 2, 3, 4)] * 2, schema)
    done = fim.rearrange(rows)
    assert done.columns == ["doc_id", "text", "row", "h", "n", "first", *fim.MADE]
    first, second = done.collect()
    assert first == second and first.output == plainly(None, "one two three")[2]
    assert (first.row, first.h, first.n, first.first) == (1, 2, 3, 4)
    assert fim.rearrange(rows.limit(0)).count() == 0


def test_one_pass_without_shuffle_or_python(spark):
    rows = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = fim.rearrange(rows)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)
