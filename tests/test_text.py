import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerweave import functions as fn


def expected_key(text):
    decomposed = unicodedata.normalize("NFKD", text or "")
    bare = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    return " ".join(re.findall("[0-9a-z]+", bare.casefold()))


def apply(spark, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = frame.select("i", column(F.col("v")).alias("out")).collect()
    return [row.out for row in sorted(found, key=lambda row: row.i)]


def test_key_ignores_case_space_and_punctuation(spark):
    assert apply(spark, ["  Foo   Bar ", "foo bar", "FOO  BAR", "foo-bar!"], fn.canonical_key) == [
        "foo bar"
    ] * 4


@pytest.mark.parametrize(
    "text, key",
    [
        (None, ""),
        ("---", ""),
        ("會計", ""),
        ("Café", "cafe"),
        ("Straße 12", "strasse 12"),
        ("1½ ton", "11 2 ton"),
        ("İstanbul", "istanbul"),
        ("a b", "a b"),
        ("ﬁnance ﬂow", "finance flow"),
        ("𝔊𝔩", "gl"),
        ("Ⅷ/x", "viii x"),
    ],
)
def test_key_folds_unicode(spark, text, key):
    assert apply(spark, [text], fn.canonical_key) == [key]
    assert expected_key(text) == key


def test_key_of_every_character(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF]
    texts = [f"x{chr(p)}Y" for p in points]
    found = apply(spark, texts, fn.canonical_key)
    wrong = [hex(p) for p, text, key in zip(points, texts, found) if key != expected_key(text)]
    assert wrong == []


ANY_TEXT = st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(ANY_TEXT, min_size=200, max_size=400))
def test_key_and_squeeze_of_any_text(spark, texts):
    assert apply(spark, texts, fn.canonical_key) == [expected_key(t) for t in texts]
    assert apply(spark, texts, fn.squeeze) == [" ".join(t.split()) for t in texts]


def test_squeeze_keeps_null_and_empty(spark):
    values = ["  Foo   Bar ", None, "", " \t \x1c", "a\u0085b"]
    assert apply(spark, values, fn.squeeze) == ["Foo Bar", None, "", "", "a b"]


def test_null_like_text_is_exact(spark):
    values = ["nan", "None", "", "<NA>", "NaN", " ", None, "T1"]
    assert apply(spark, values, fn.null_like_to_null) == [None] * 4 + ["NaN", " ", None, "T1"]


def test_environment_splits_at_the_first_hyphen(spark):
    assert apply(spark, ["L1-1", "TEST-B-99", "solo"], fn.env_datalib) == ["L1", "TEST", "solo"]
    assert apply(spark, ["L1-1", "TEST-B-99", "solo"], fn.env_company) == ["1", "B-99", None]


def test_environment_marks_missing_parts(spark):
    frame = spark.createDataFrame([(" L ", "1"), (None, "2")], "a string, b string")
    found = frame.select(fn.environment(F.col("a"), F.col("b")).alias("e")).collect()
    assert [row.e for row in found] == ["L-1", "<NA>-2"]


def test_same_value_is_never_null(spark):
    frame = spark.createDataFrame(
        [("1", "1"), ("1", "2"), (None, "1"), (None, None)], "a string, b string"
    )
    found = frame.select(fn.same_value(F.col("a"), F.col("b")).alias("s")).collect()
    assert [row.s for row in found] == [True, False, False, False]
