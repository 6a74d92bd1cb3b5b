"""Fill-in-middle: a text cut into prefix, middle and suffix, told in another order.

A text is a sequence of units, words of letters or single other characters.
``regexp_count`` gives their number, a hash of the document's key picks two cuts, and a
pattern made for the row, with possessive counted groups ``unit{a}`` and ``unit{b-a}``,
captures the three parts in one match, whose replacement is the rearranged text. A counted
group never gives back what it took, so a match takes one pass over the text.

Every step is a built-in expression over one row: there is no shuffle, and a hot key costs
no more than its rows.

Nulls and empty texts: a null text is an empty one; empty texts, and those that hold one of
the marks, stay plain, so that every output reads back without doubt. A null key is hashed
as an empty one. Rows with equal keys are cut by the same numbers. Columns of the input that
are called like a result are replaced, in any case; all others stay. An empty table gives
no rows. The time for a text grows with its length; while its units are counted they are
held as an array, about 60 bytes each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units, marks and forms.
UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MADE = ("n_units", "form", "output", "prefix_chars", "middle_chars")


class Shares(NamedTuple):
    """Percent of the documents left plain, of the others in suffix-first order, and the seed."""

    plain: int = 10
    suffix_first: int = 20
    seed: int = 1


def _numbers(key: Column, seed: int) -> Column:
    """Four numbers of 32 bits from the key."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.sha2(told, 256)
    return F.array(
        *(F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4))
    )


def _counted(times: Column) -> Column:
    """A group of exactly so many units, which gives none of them back."""
    return F.concat(F.lit("((?:[A-Za-z]++|[^A-Za-z]){"), times.cast("string"), F.lit("}+)"))


def rearrange(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shares: Shares = Shares()
) -> DataFrame:
    """``documents`` with ``n_units``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    The two lengths are in characters, and null for plain texts. :func:`restore` gives the
    text back.
    """
    marks = (PREFIX, SUFFIX, MIDDLE)
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        _numbers(F.col(key), shares.seed).alias("h"),
    )
    counted = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    h, n = F.col("h"), F.col("n")
    cuts = [F.pmod(h[i], n + 1) for i in range(2)]
    plain = F.col("text") == ""
    for mark in marks:
        plain = plain | F.contains("text", F.lit(mark))
    plain = plain | (h[2] % 100 >= 100 - shares.plain)
    formed = counted.withColumns(
        {
            "first": F.least(*cuts),
            "second": F.greatest(*cuts),
            "form": F.when(plain, PLAIN).when(h[3] % 100 < shares.suffix_first, SPM).otherwise(PSM),
        }
    )
    pattern = F.concat(
        F.lit(r"(?s)\A"),
        _counted(F.col("first")),
        _counted(F.col("second") - F.col("first")),
        F.lit(r"(.*)\z"),
    )
    order = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(
        f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"
    )
    told = formed.withColumn(
        "output",
        F.when(F.col("form") == PLAIN, F.col("text")).otherwise(
            F.regexp_replace(F.col("text"), pattern, order)
        ),
    )
    # The text holds no mark, so the first one found is the one that was set.
    at = {mark: F.locate(mark, F.col("output")).cast("long") for mark in marks}
    begins = at[PREFIX] + len(PREFIX)
    ends = F.when(F.col("form") == PSM, at[SUFFIX]).otherwise(at[MIDDLE])
    length = F.length("output").cast("long")
    cut = F.col("form") != PLAIN
    kept = [F.col(f"row.`{c}`").alias(c) for c in documents.columns if c.lower() not in MADE]
    return told.select(
        *kept,
        F.col("n").alias("n_units"),
        "form",
        "output",
        F.when(cut, ends - begins).alias("prefix_chars"),
        F.when(cut, length - (at[MIDDLE] + len(MIDDLE) - 1)).alias("middle_chars"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text an output was made from."""
    first = F.regexp_replace(
        output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"
    )
    last = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == PSM, first).when(form == SPM, last).otherwise(output)
