"""What distinguishes one kind of master data from another.

Every operator takes a :class:`Component`, so general-ledger accounts and cost
centers share one code path.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Component:
    """Column roles and wording of one master-data table.

    ``number`` is the identifying number column, ``category`` the optional type
    column, ``flags`` the J/N exclusion columns.
    """

    code: str
    number: str
    category: str | None
    flags: tuple[str, ...]
    required: tuple[str, ...]
    text_columns: tuple[str, ...]
    noun: str
    number_prefix: str
    verify_what: str
    sentence_has_lang: bool

    @property
    def attributes(self) -> tuple[str, ...]:
        """Columns a missing entry inherits from the environments that have it."""
        category = (self.category,) if self.category else ()
        return ("DESCRIPTION", self.number, *category, "DESCRIPTION_LANG")


# Column names and wording that results must carry verbatim.
GL = Component(
    code="GL",
    number="ACCOUNT",
    category="TYPE",
    flags=("DOORTREK_JN", "VERDREK_JN"),
    required=(
        "DATALIB",
        "COMPANY",
        "ACCOUNT",
        "DESCRIPTION",
        "TYPE",
        "LASTUSED_DATE",
        "DOORTREK_JN",
        "VERDREK_JN",
    ),
    text_columns=("DESCRIPTION", "TYPE", "DATALIB", "COMPANY", "DESCRIPTION_LANG"),
    noun="account",
    number_prefix="Acct_",
    verify_what="TYPE",
    sentence_has_lang=True,
)
CC = Component(
    code="CC",
    number="COSTCENTER",
    category=None,
    flags=(),
    required=("DATALIB", "COMPANY", "COSTCENTER", "DESCRIPTION", "LASTUSED_DATE"),
    text_columns=("DESCRIPTION", "DATALIB", "COMPANY", "DESCRIPTION_LANG"),
    noun="cost center",
    number_prefix="CC_",
    verify_what="alignment",
    sentence_has_lang=False,
)


def component(code: str) -> Component:
    """The component called ``code``; an unknown code raises ``ValueError``."""
    known = {c.code: c for c in (GL, CC)}
    if code not in known:
        raise ValueError(f"unknown component {code!r}, expected one of {sorted(known)}")
    return known[code]
