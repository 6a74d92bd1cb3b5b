"""One component from loaded ledger to result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import nullcontext
from dataclasses import asdict, dataclass, replace
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.operators.filters import FilterRules, filter_figures, keep_reject
from ledgerweave.operators.gaps import CREATE, REVIEW, action_counts, gap_actions
from ledgerweave.operators.mismatches import number_mismatches, type_mismatches
from ledgerweave.operators.presence import (
    Shard,
    few_environments,
    language_variants,
    presence_binary,
    presence_cells,
    presence_enriched,
    presence_shards,
    presence_totals,
    shard_index,
)
from ledgerweave.sources.ledger import ORDINAL, PendingLedger
from ledgerweave.storage import in_passing, materialise, one_row, store_by_key, store_in_buckets
from ledgerweave.plans.report import config_echo, filter_summary, written_summary
from ledgerweave.plans.sink import Sink, publishing, table_names


@dataclass(frozen=True)
class ComponentResult:
    """The results of one run, all of them lazy tables over stored intermediates.

    With more environments than a table has room for, ``presence_shards`` makes the columns of the
    environments, shard by shard, and the two matrices have only what is beside them.
    """

    raw: DataFrame
    cleaned: DataFrame
    filtered: DataFrame
    counts: DataFrame
    cells: DataFrame
    presence_binary: DataFrame | None
    presence_enriched: DataFrame | None
    actions: DataFrame
    create: DataFrame
    review: DataFrame
    action_counts: DataFrame
    number_mismatches: DataFrame
    type_mismatches: DataFrame
    presence_shards: Callable[[], Iterator[Shard]] | None = None


class Steps(NamedTuple):
    """The functions a run consists of; each can be replaced by one of the same signature."""

    split: Callable = keep_reject
    cells: Callable = presence_cells
    actions: Callable = gap_actions
    numbers: Callable = number_mismatches
    types: Callable = type_mismatches


def run_component(
    source: DataFrame | Callable[[], DataFrame | PendingLedger],
    comp: Component,
    rules: FilterRules | None = None,
    *,
    run_ts: str | None = None,
    out: str | None = None,
    names: Mapping[str, str] | None = None,
    format: str = "parquet",
    wide: bool = True,
    steps: Steps = Steps(),
) -> ComponentResult:
    """Filter, compare and report one conformed ledger, or a function returning it.

    With ``out`` eleven tables are published below ``<out>/<component>_output_<run_ts>``,
    under other ``names`` where given, all together when the last is complete; a run that fails
    leaves none, and one whose results exist is refused at once. What it returns reads the
    published tables if they are parquet. Without ``out`` nothing but intermediates is written;
    within :func:`~ledgerweave.storage.intermediates` these go when the scope ends.
    ``wide=False`` leaves out the two matrices with columns per environment. With more
    environments than a table has room for, these columns come in shards: tables of the usual
    names with a number behind, and an index of their columns.
    ``steps`` replaces single steps of the run.

    What several results read is stored once: the ledger of a loader function, the kept
    rows, and, in buckets of the description, what is compared of them and the presence
    cells. These two are shuffled by description for their storage and not again after it.

    The source of a loader function is read once: the job that stores the ledger takes the
    filter counters in passing, and checks a :class:`~ledgerweave.sources.ledger.PendingLedger`
    as well. A ledger given as a DataFrame is read for the kept rows, with the counters, and
    once more for the rejected ones, so it had better be a table. The numbers of rows in the
    summary are those counted while the tables were written.
    """
    if out is not None and run_ts is None:
        raise ValueError("a written run needs run_ts to name its folder")
    rules = rules or FilterRules()
    target = nullcontext()
    if out is not None:
        folder = f"{out.rstrip('/')}/{comp.code}_output_{run_ts}"
        target = publishing(_session(source), folder, {**table_names(comp), **(names or {})}, format)
    with target as sink:
        result = _run(source, comp, rules, sink, wide, steps)
        if sink is not None:
            written = _write(result, sink, comp, rules, run_ts)
    if sink is None or sink.format != "parquet":
        return result
    return _published(result, sink, written)


def _session(source: DataFrame | Callable) -> SparkSession:
    return SparkSession.active() if callable(source) else source.sparkSession


def _run(
    source: DataFrame | Callable[[], DataFrame | PendingLedger],
    comp: Component,
    rules: FilterRules,
    sink: Sink | None,
    wide: bool,
    steps: Steps,
) -> ComponentResult:
    def keep(cleaned: DataFrame) -> DataFrame:
        return materialise(cleaned) if sink is None else sink.keep("Cleaned Data", cleaned)

    def figures(rows: DataFrame) -> dict[str, Column]:
        return filter_figures(rows, comp, rules)

    usual = steps.split is keep_reject
    if callable(source):
        raw, found = _stored(source, figures if usual else None)
    else:
        raw, found = source, {}
    split = steps.split(raw, comp, rules)
    if not usual:  # with counters of its own
        counts, cleaned = materialise(split.counts), keep(split.cleaned)
    elif callable(source):
        counts, cleaned = one_row(raw.sparkSession, found), keep(split.cleaned)
    else:
        cleaned, found = in_passing(
            raw, figures(raw), lambda rows: keep(steps.split(rows, comp, rules).cleaned)
        )
        counts = one_row(raw.sparkSession, found)
    return _results(raw, split.filtered, counts, cleaned, comp, wide, steps)


def _stored(
    source: Callable[[], DataFrame | PendingLedger],
    figures: Callable[[DataFrame], dict[str, Column]] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """The ledger of a loader function as stored, with ``figures`` taken in passing."""
    ledger = source()
    if isinstance(ledger, PendingLedger):
        return ledger.store(figures)
    if figures is None:
        return materialise(ledger), {}
    return in_passing(ledger, figures(ledger), materialise)


def _results(
    raw: DataFrame,
    filtered: DataFrame,
    counts: DataFrame,
    cleaned: DataFrame,
    comp: Component,
    wide: bool,
    steps: Steps,
) -> ComponentResult:
    work = store_by_key(_working_columns(cleaned, comp, steps), "DESC_KEY")
    # A description has one cell an environment at most, so that cells are never hot.
    cells = store_in_buckets(work.each(lambda rows, _: steps.cells(rows, comp)), "DESC_KEY")

    def mismatches(step: Callable, usual: Callable) -> DataFrame:
        def make(rows: DataFrame, bounded: bool) -> DataFrame:
            return step(rows, comp, bounded=bounded) if step is usual else step(rows, comp)

        return work.union(make)

    binary = enriched = shards = None
    if wide:
        envs = few_environments(cells)
        languages = None if comp.category else language_variants(cleaned)
        if envs is None:
            shards = partial(presence_shards, cells, comp)
            binary, enriched = cells.select("DESC_KEY").distinct(), presence_totals(cells)
            if languages is not None:
                enriched = enriched.join(languages, "DESC_KEY")
        else:
            binary = presence_binary(cells, envs)
            enriched = presence_enriched(cells, comp, envs, languages)
    if steps.actions is gap_actions:
        actions = gap_actions(cleaned, comp, cells=cells)
        create, review = (gap_actions(cleaned, comp, kind=k, cells=cells) for k in (CREATE, REVIEW))
        counted = action_counts(cleaned, comp, cells=cells)
    else:
        actions = steps.actions(cleaned, comp, cells=cells)
        kind = F.col("ActionType")
        create, review = (actions.filter(kind == k) for k in (CREATE, REVIEW))
        counted = actions.agg(*(F.count_if(kind == k).alias(k) for k in (CREATE, REVIEW)))
    return ComponentResult(
        raw=raw,
        cleaned=cleaned,
        filtered=filtered,
        counts=counts,
        cells=cells,
        presence_binary=binary,
        presence_enriched=enriched,
        actions=actions,
        create=create,
        review=review,
        action_counts=counted,
        number_mismatches=mismatches(steps.numbers, number_mismatches),
        type_mismatches=mismatches(steps.types, type_mismatches),
        presence_shards=shards,
    )


def _working_columns(cleaned: DataFrame, comp: Component, steps: Steps) -> DataFrame:
    """What the usual steps look at; steps of one's own may look at everything."""
    if steps != Steps():
        return cleaned
    names = ("DESC_KEY", "ENV", *comp.attributes, ORDINAL)
    return cleaned.select(*(name for name in names if name in cleaned.columns))


# The results of a run by the names they are written under.
FIELDS = {
    "Cleaned Data": "cleaned",
    "Filtered Out": "filtered",
    "Presence Matrix (binary)": "presence_binary",
    "Presence Matrix (enriched)": "presence_enriched",
    "Create": "create",
    "Review": "review",
    "Number Mismatches": "number_mismatches",
    "Type Mismatches": "type_mismatches",
}


def _write(
    result: ComponentResult, sink: Sink, comp: Component, rules: FilterRules, run_ts: str
) -> dict[str, int]:
    """Write the other ten tables; the summary has the numbers of rows that were written."""
    for name, field in FIELDS.items():
        table = getattr(result, field)
        if table is not None and name not in sink.rows:
            sink.write(name, table, ["DESC_KEY"] if name.startswith("Presence") else ())
    if result.presence_shards is not None:
        _write_shards(result, sink, comp)
    sink.write("Filter Summary", filter_summary(result.counts))
    written = {
        "Create Actions": sink.rows["Create"],
        "Review Actions": sink.rows["Review"],
        "Number Mismatches": sink.rows["Number Mismatches"],
        "Type Mismatches": sink.rows["Type Mismatches"],
    }
    sink.write("Summary", written_summary(comp, result.counts, result.cells, written, run_ts))
    parameters = {**asdict(rules), "component": comp.code, "run_timestamp": run_ts}
    sink.write("Config", config_echo(result.cells.sparkSession, parameters))
    return {CREATE: written["Create Actions"], REVIEW: written["Review Actions"]}


def _write_shards(result: ComponentResult, sink: Sink, comp: Component) -> None:
    """Write the shards of the matrices beside them, and the index of their columns."""
    listed = []
    for shard in result.presence_shards():
        for field in ("binary", "enriched"):
            name = f"Presence Matrix ({field})"
            sink.write_part(name, f"{shard.number:05d}", getattr(shard, field), ["DESC_KEY"])
        listed.append((shard.number, shard.envs))
    index = shard_index(listed, comp, result.cells.sparkSession)
    sink.write_part("Presence Matrix (enriched)", "Columns", index)


def _published(result: ComponentResult, sink: Sink, counted: dict[str, int]) -> ComponentResult:
    """The same results, read from where they were published."""
    read = {
        field: sink.read(name, getattr(result, field))
        for name, field in FIELDS.items()
        if getattr(result, field) is not None
    }
    actions = read["create"].unionByName(read["review"])
    return replace(result, **read, actions=actions, action_counts=one_row(actions.sparkSession, counted))
