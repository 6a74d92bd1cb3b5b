"""Column expressions: text, numbers, dates and order-dependent firsts."""

from ledgerweave.functions.dates import parse_last_used
from ledgerweave.functions.firsts import first_by, first_value
from ledgerweave.functions.numbers import as_double, format_double, format_number, number_text
from ledgerweave.functions.text import (
    NULL_TEXT,
    canonical_key,
    env_company,
    env_datalib,
    environment,
    null_like_to_null,
    or_null_text,
    same_value,
    squeeze,
    strip,
)

__all__ = [
    "NULL_TEXT",
    "as_double",
    "canonical_key",
    "env_company",
    "env_datalib",
    "environment",
    "first_by",
    "first_value",
    "format_double",
    "format_number",
    "null_like_to_null",
    "number_text",
    "or_null_text",
    "parse_last_used",
    "same_value",
    "squeeze",
    "strip",
]
