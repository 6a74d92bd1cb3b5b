"""The merge of several environments into one, planned for all components."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import Component, component
from ledgerweave.operators.merge import (
    MergeSpec,
    merge_actions,
    merge_conflicts,
    merge_mappings,
    number_folds,
    unify,
)
from ledgerweave.storage import store_by_key, store_in_buckets
from ledgerweave.plans.report import config_echo
from ledgerweave.plans.sink import publishing


def merge_plan(
    cleaned: Mapping[str, DataFrame],
    spec: MergeSpec | Mapping,
    *,
    run_ts: str,
    out: str | None = None,
    format: str = "parquet",
) -> dict[str, DataFrame]:
    """Result tables of a merge by name, from the cleaned ledgers by component code.

    With ``out`` they are also published below ``<out>/Merge_Plan_<run_ts>``, all together when
    the last is complete; a merge that fails leaves none, one whose results exist is refused.
    """
    if not isinstance(spec, MergeSpec):
        spec = MergeSpec.from_dict(spec)
    missing = [code for code in spec.scope if code not in cleaned]
    if missing:
        raise ValueError(f"the scope names {missing}, but there is no such ledger")

    spark = next(iter(cleaned.values())).sparkSession
    if out is None:
        return _tables(cleaned, spec, run_ts)[0]
    with publishing(spark, f"{out.rstrip('/')}/Merge_Plan_{run_ts}", format=format) as sink:
        tables, order = _tables(cleaned, spec, run_ts)
        for name, table in tables.items():
            sink.write(name, table, order.get(name, ()))
    return tables


def _tables(
    cleaned: Mapping[str, DataFrame], spec: MergeSpec, run_ts: str
) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """The result tables, and the columns that those with an order are sorted by."""
    spark = next(iter(cleaned.values())).sparkSession
    # Table and column names.
    tables = {
        "Config": config_echo(
            spark,
            {
                "Target_ENV": spec.target.name,
                "Scope": spec.scope,
                "Numbering_Strategy": spec.numbering_strategy,
                "Preferred_ENV": spec.preferred_env or "",
                "Created_At": run_ts,
            },
        ),
        "Sources": spark.createDataFrame(
            [(env.name, env.datalib, env.company) for env in spec.sources],
            "Source_ENV string, DATALIB string, COMPANY string",
        ),
    }
    order = {}
    for code in spec.scope:
        comp = component(code)
        tables.update(component_merge(cleaned[code], comp, spec))
        order[f"Unified_{code}"] = order[f"Conflicts_{code}"] = ["DESCRIPTION"]
        order[f"Mappings_{code}"] = ["Source_ENV", "DESCRIPTION", f"{comp.number}_SOURCE"]
    return tables, order


def component_merge(
    cleaned: DataFrame, comp: Component, spec: MergeSpec, ordinal: str = "_ord"
) -> dict[str, DataFrame]:
    """Unified, conflict, action and mapping tables of one component.

    The rows of the environments involved are stored by description once, and the unified table
    beside them; folds, conflicts and mappings find their descriptions together.
    """
    category = [comp.category] if comp.category else []
    columns = ["DESC_KEY", "ENV", "DATALIB", "COMPANY", comp.number, *category]
    involved = cleaned.filter(F.col("ENV").isin([*spec.source_names, spec.target.name])).select(
        *columns, "DESCRIPTION", "DESCRIPTION_LANG", ordinal
    )
    work = store_by_key(involved, "DESC_KEY")
    unified = store_in_buckets(
        work.each(lambda rows, _: unify(number_folds(rows, comp, spec, ordinal), comp, spec)), "DESC_KEY"
    )

    def conflicts(rows: DataFrame, bounded: bool) -> DataFrame:
        folds = number_folds(rows, comp, spec, ordinal)
        return merge_conflicts(rows, folds, unified, comp, spec, bounded)

    def mappings(rows: DataFrame, bounded: bool) -> DataFrame:
        return merge_mappings(rows, unified, comp, spec, ordinal, bounded)

    return {
        f"Unified_{comp.code}": unified,
        f"Conflicts_{comp.code}": work.union(conflicts),
        f"Actions_{comp.code}": merge_actions(cleaned, unified, comp, spec, ordinal),
        f"Mappings_{comp.code}": work.union(mappings),
    }
