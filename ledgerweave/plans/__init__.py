"""Whole runs: one component end to end, a merge plan, and their result tables."""

from ledgerweave.plans.merge_plan import merge_plan
from ledgerweave.plans.report import config_echo, filter_summary, run_summary
from ledgerweave.plans.run import ComponentResult, Steps, run_component
from ledgerweave.plans.sink import Sink, publishing, read_manifest, read_results, table_names
from ledgerweave.storage import intermediates, materialise

__all__ = [
    "ComponentResult",
    "Sink",
    "config_echo",
    "filter_summary",
    "intermediates",
    "materialise",
    "merge_plan",
    "publishing",
    "read_manifest",
    "read_results",
    "Steps",
    "run_component",
    "run_summary",
    "table_names",
]
