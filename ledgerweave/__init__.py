"""Compare, validate and harmonise master data of many ERP environments on Spark.

The usual way through: :func:`load` or :func:`conform` a table per component,
:func:`run_component` it, then :func:`merge_plan` over the cleaned ledgers. Every
step is also an operator of its own in :mod:`ledgerweave.operators`.
"""

from ledgerweave.component import CC, GL, Component, component
from ledgerweave.operators import FilterRules, MergeSpec
from ledgerweave.plans import intermediates, merge_plan, read_results, run_component
from ledgerweave.sources import TableLocation, conform, load, load_later

__all__ = [
    "CC",
    "GL",
    "Component",
    "FilterRules",
    "MergeSpec",
    "TableLocation",
    "component",
    "intermediates",
    "conform",
    "load",
    "load_later",
    "merge_plan",
    "read_results",
    "run_component",
]
