"""Chat logs: folding, rendering, reading back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import chat

SCHEMA = "conv_id long, turn long, seq long, kind string, role string, text string, piece string"


def told(spark, rows):
    """conv_id -> (turns read back, masked text, formatted)."""
    log = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    done = chat.render(chat.fold_events(log)).select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_masked(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "formatted",
    )
    return {r[0]: ([tuple(t) for t in r[1]], r[2], r[3]) for r in done.collect()}


def test_streams_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 0, "message", "assistant", ""),
        (1, 1, 1, "delta", None, "one "),
        (1, 1, 2, "delta", None, "two"),
        (1, 1, 3, "regenerate", None, "ignored"),
        (1, 1, 5, "delta", None, "C"),
        (1, 1, 4, "delta", None, "B"),
        (1, 2, 0, "message", "user", "typo"),
        (1, 2, 1, "edit", None, "fixed"),
        (1, 2, 2, "delta", None, "!"),
        (1, 3, 0, "unheard of", "user", "ignored"),
    ]
    turns, loss, _ = told(spark, rows)[1]
    assert turns == [("user", "hi"), ("assistant", "BC"), ("user", "fixed!")]
    assert loss == "BC"


@pytest.mark.parametrize(
    "text",
    ["<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nx", "<\\|", "<\\\\|<|", "<|", "a<", "|b", "\n", "", "日本<|\\|"],
)
def test_control_strings_come_back(spark, text):
    rows = [(7, 0, 0, "message", "user", text), (7, 1, 0, "message", "assistant", text)]
    turns, loss, formatted = told(spark, rows)[7]
    assert turns == [("user", text), ("assistant", text)] and loss == text
    assert formatted.count(chat.START) == formatted.count(chat.END) == 2


def test_roles_with_line_ends_and_backslashes_come_back(spark):
    roles = ["a\nb", "a\\nb", "\\", "\\\n", "<|im_end|>"]
    rows = [(1, i, 0, "message", role, "t") for i, role in enumerate(roles)]
    assert [r for r, _ in told(spark, rows)[1][0]] == roles


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, "message", None, None),
        (2, 0, 0, "message", "user", "b"),
        (2, 0, 0, "message", "user", "a"),
        (2, 0, 0, "message", "user", "a"),
        (3, 0, 0, "delta", "assistant", "lost start"),
    ]
    found = told(spark, rows)
    assert found[None][0] == [("", "")]
    assert [t for _, t in found[2][0]] == ["a", "a", "b"]
    assert found[3][0] == [("assistant", "lost start")]


def test_long_conversation_and_empty_log(spark):
    rows = [(1, i, 0, "message", "assistant", f"{i}<|" * 50) for i in range(300)]
    turns, loss, _ = told(spark, rows)[1]
    want = [r[5] for r in rows]
    assert [t for _, t in turns] == want
    assert hashlib.sha256(loss.encode()).digest() == hashlib.sha256("".join(want).encode()).digest()
    assert told(spark, []) == {}
