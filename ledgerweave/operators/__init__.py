"""Operators on conformed ledgers. Each takes and returns DataFrames."""

from ledgerweave.operators.filters import FilterRules, keep_reject, keep_rule
from ledgerweave.operators.gaps import action_counts, gap_actions
from ledgerweave.operators.merge import (
    MergeSpec,
    merge_actions,
    conflict_values,
    merge_conflicts,
    merge_mappings,
    number_folds,
    unify,
)
from ledgerweave.operators.mismatches import (
    number_details,
    number_mismatches,
    type_details,
    type_mismatches,
)
from ledgerweave.operators.presence import (
    environments,
    language_variants,
    presence_binary,
    presence_cells,
    presence_enriched,
    presence_shards,
    presence_totals,
    shard_index,
)

__all__ = [
    "FilterRules",
    "MergeSpec",
    "environments",
    "action_counts",
    "gap_actions",
    "keep_reject",
    "keep_rule",
    "language_variants",
    "merge_actions",
    "conflict_values",
    "merge_conflicts",
    "merge_mappings",
    "number_folds",
    "number_details",
    "number_mismatches",
    "presence_binary",
    "presence_cells",
    "presence_enriched",
    "presence_shards",
    "presence_totals",
    "shard_index",
    "type_details",
    "type_mismatches",
    "unify",
]
