"""Reading, checking and normalising master-data tables."""

from ledgerweave.sources.ledger import (
    ORDINAL,
    PendingLedger,
    TableLocation,
    conform,
    conform_later,
    load,
    load_later,
    normalise_columns,
    read_table,
    table_for,
)
from ledgerweave.sources.quality import (
    SchemaViolations,
    require_valid,
    schema_violations,
    violation_figures,
)

__all__ = [
    "ORDINAL",
    "PendingLedger",
    "SchemaViolations",
    "TableLocation",
    "conform",
    "conform_later",
    "load",
    "load_later",
    "normalise_columns",
    "read_table",
    "require_valid",
    "schema_violations",
    "table_for",
    "violation_figures",
]
