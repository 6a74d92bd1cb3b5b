"""Text expressions. All of them run inside the JVM, none is a Python UDF."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value".
NULL_LIKE = ("nan", "None", "", "<NA>")
NULL_TEXT = "<NA>"

# Unicode white space plus the four ASCII separators, which Java leaves out.
_SPACE = r"[\s\x1c-\x1f]"
_SPACE_RUN = f"(?U){_SPACE}+"
_EDGE_SPACE = f"(?U)^{_SPACE}+|{_SPACE}+$"


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, the ends are stripped; null stays null."""
    return F.trim(F.regexp_replace(c, _SPACE_RUN, " "))


def is_blank(c: Column) -> Column:
    """Whether ``c`` is empty but for white space; null for null."""
    return ~c.rlike(f"(?U)(?!{_SPACE})(?s:.)")


def strip(c: Column) -> Column:
    """``c`` without white space at either end."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def _fold(char: str) -> str:
    bare = "".join(
        part for part in unicodedata.normalize("NFKD", char) if not unicodedata.combining(part)
    )
    return re.sub("[^0-9a-z]+", " ", bare.casefold())


@cache
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Per-character folding rules ``(one character to at most one, one to several)``.

    Compatibility decomposition, dropping of combining marks and case folding act
    on each character by itself, so the tables follow from the Unicode data of
    the running interpreter. Characters that fold to a separator are left out:
    the final pattern of :func:`canonical_key` turns them into spaces anyway.
    """
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for point in range(sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:  # surrogates are no characters
            continue
        char = chr(point)
        folded = _fold(char)
        if folded in (char, " "):
            continue
        (several if len(folded) > 1 else single)[char] = folded
    return single, several


def canonical_key(c: Column) -> Column:
    """Matching key of a description: blind to accents, case and punctuation.

    Null gives the empty key. Plain ASCII text, the bulk of any ledger, skips the
    Unicode tables.
    """
    single, several = _fold_tables()
    text = F.coalesce(c, F.lit(""))

    # A hash lookup per character; a pattern of all these characters is far slower.
    def expands(part: Column) -> Column:
        return F.length(F.translate(part, "".join(several), "")) < F.length(part)

    rules = F.map_from_arrays(
        F.array(*map(F.lit, several)), F.array(*map(F.lit, several.values()))
    )

    def expand(word: Column) -> Column:
        letters = F.transform(
            F.split(word, ""), lambda ch: F.coalesce(F.try_element_at(rules, ch), ch)
        )
        return F.when(expands(word), F.array_join(letters, "")).otherwise(word)

    expanded = F.when(
        expands(text), F.array_join(F.transform(F.split(text, " "), expand), " ")
    ).otherwise(text)
    # translate() drops the characters that have no counterpart, so deletions go last.
    kept = [char for char, folded in single.items() if folded]
    dropped = [char for char, folded in single.items() if not folded]
    folded = F.translate(expanded, "".join(kept + dropped), "".join(single[ch] for ch in kept))

    foreign = F.octet_length(text) > F.length(text)
    plain = F.when(foreign, folded).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(plain, "[^0-9a-z]+", " "))


def environment(datalib: Column, company: Column) -> Column:
    """Name of one ERP environment, ``DATALIB-COMPANY``, from normalised columns."""
    return F.concat(or_null_text(F.trim(datalib)), F.lit("-"), or_null_text(F.trim(company)))


def env_datalib(env: Column) -> Column:
    """Part of an environment name before the first hyphen."""
    return F.split(env, "-", 2)[0]


def env_company(env: Column) -> Column:
    """Part of an environment name after the first hyphen; null without one."""
    return F.get(F.split(env, "-", 2), 1)


def null_like_to_null(c: Column) -> Column:
    """Text that merely spells a missing value becomes null (exact match)."""
    return F.when(~c.isin(*NULL_LIKE), c)


def or_null_text(c: Column) -> Column:
    """``c``, with the null marker where it is null, for use inside sentences."""
    return F.coalesce(c, F.lit(NULL_TEXT))


def same_value(a: Column, b: Column) -> Column:
    """True where both sides are present and read the same; never null."""
    return F.coalesce(a == b, F.lit(False))
