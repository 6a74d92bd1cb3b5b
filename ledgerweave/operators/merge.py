"""Plan the merge of several source environments into one target.

Source rows are first folded to one row per description and number. Everything
chosen per description (canonical number, majority, conflicts) is decided on the
folds, so a description that holds much of the data never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import CC, GL, Component
from ledgerweave.functions.firsts import first_by
from ledgerweave.functions.text import same_value
from ledgerweave.operators.gaps import CREATE, FREE, REVIEW
from ledgerweave.operators.holders import rival, two_holders
from ledgerweave.operators.joins import even_left_join, shuffle_anew
from ledgerweave.operators.texts import ordered_texts

# Numbering strategies, reasons and suggestions.
KEEP_PREFERRED, PICK_MAJORITY, FIRST, NEW_RANGE = (
    "keep_preferred",
    "pick_majority",
    "first",
    "new_range",
)
STRATEGIES = (KEEP_PREFERRED, PICK_MAJORITY, FIRST, NEW_RANGE)
NO_NUMBER = "no_number"
CROSS_CHECK = "Afstemmen/cross-check met canonical"
NO_CANONICAL = "Canonical is leeg; kies nieuw nummer"
SAME_IN_TARGET = "Target heeft al hetzelfde canonical nummer"
TAKEN_IN_TARGET = "Canonical nummer bestaat in target voor andere omschrijving: "
SUGGEST_CREATE = "Create (new range/choose number)"
SUGGEST_KEEP = "Keep (same number)"
SUGGEST_MAP = "Map to canonical"


class Environment(NamedTuple):
    """One ERP environment."""

    datalib: str
    company: str

    @property
    def name(self) -> str:
        return f"{self.datalib.strip()}-{self.company.strip()}"


@dataclass(frozen=True)
class MergeSpec:
    """Which environments merge into which, and how numbers are chosen."""

    sources: Sequence[Environment]
    target: Environment
    scope: Sequence[str] = (GL.code, CC.code)
    numbering_strategy: str = KEEP_PREFERRED
    preferred_env: str | None = None

    def __post_init__(self) -> None:
        scope = tuple(entry.strip().upper() for entry in self.scope)
        unknown = [entry for entry in scope if entry not in (GL.code, CC.code)]
        if unknown:
            raise ValueError(f"scope has unknown entries {unknown}")
        strategy = self.numbering_strategy.strip().lower()
        if strategy not in STRATEGIES:
            raise ValueError(f"no such strategy: {strategy!r}; known ones are {', '.join(STRATEGIES)}")
        if strategy == KEEP_PREFERRED and not self.preferred_env:
            raise ValueError(f"{KEEP_PREFERRED} needs preferred_env")
        object.__setattr__(self, "scope", scope)
        object.__setattr__(self, "numbering_strategy", strategy)

    @classmethod
    def from_dict(cls, spec: Mapping) -> MergeSpec:
        """Read a spec from plain data, as parsed from a YAML or JSON file.

        An environment is ``{datalib, company}``; ``bedrijf`` stands for
        ``company`` as well. Identifiers may be numbers.
        """

        def env(entry: Mapping) -> Environment:
            company = entry["company"] if "company" in entry else entry["bedrijf"]
            return Environment(str(entry["datalib"]), str(company))

        try:
            sources = [env(entry) for entry in spec["sources"]]
            target = env(spec["target"])
        except (KeyError, TypeError) as error:
            raise ValueError(f"merge spec is incomplete: {error!r}") from error
        optional = ("scope", "numbering_strategy", "preferred_env")
        return cls(sources, target, **{name: spec[name] for name in optional if name in spec})

    @property
    def source_names(self) -> list[str]:
        return sorted({env.name for env in self.sources})


def _sources(cleaned: DataFrame, spec: MergeSpec) -> DataFrame:
    return cleaned.filter(F.col("ENV").isin(spec.source_names))


def number_folds(
    cleaned: DataFrame, comp: Component, spec: MergeSpec, ordinal: str = "_ord"
) -> DataFrame:
    """Source rows folded to one row per ``(DESC_KEY, number)``, no number included."""
    order = F.col(ordinal)
    aggregates = {
        "_rows": F.count(F.lit(1)),
        "_at": F.min(order),
        "_description": first_by(F.col("DESCRIPTION"), order),
        "_lang": first_by(F.col("DESCRIPTION_LANG"), order),
        "_preferred": F.min(F.when(F.col("ENV") == F.lit(spec.preferred_env), order)),
    }
    if comp.category:
        aggregates["_category"] = first_by(F.col(comp.category), order)
    return (
        _sources(cleaned, spec)
        .groupBy("DESC_KEY", comp.number)
        .agg(*(value.alias(name) for name, value in aggregates.items()))
    )


def unify(folds: DataFrame, comp: Component, spec: MergeSpec) -> DataFrame:
    """One row per description of the sources, with its canonical number.

    ``keep_preferred`` takes the number in the first row of the preferred
    environment and falls back to the majority when that is missing;
    ``pick_majority`` takes the most frequent number, the first one seen among
    equals; ``first`` the first one; ``new_range`` none.
    """
    number = F.col(comp.number)
    preferred = F.col("_preferred")
    picks = {
        "_any": first_by(number, F.col("_at"))["value"],
        "_most": first_by(number, -F.col("_rows"), F.col("_at"))["value"],
        "_kept": F.min(F.when(preferred.isNotNull(), F.struct(preferred, number)))[comp.number],
        "_description": F.min("_description")["value"],
        "DESCRIPTION_LANG_CANONICAL": F.min("_lang")["value"],
    }
    if comp.category:
        picks["_category"] = F.min("_category")["value"]
    grouped = folds.groupBy("DESC_KEY").agg(*(value.alias(name) for name, value in picks.items()))

    canonical, why = _choice(spec)
    description = F.when(F.col("_description") != "", F.col("_description"))
    category = [F.col("_category").alias(f"{comp.category}_CANONICAL")] if comp.category else []
    return grouped.select(
        "DESC_KEY",
        F.coalesce(description, "DESC_KEY").alias("DESCRIPTION"),
        canonical.alias(f"{comp.number}_CANONICAL"),
        *category,
        "DESCRIPTION_LANG_CANONICAL",
        why.alias("Why_Canonical"),
    )


def _choice(spec: MergeSpec) -> tuple[Column, Column]:
    """Canonical number and the rule that gave it."""
    numbered = F.col("_any").isNotNull()
    strategy = spec.numbering_strategy
    if strategy == KEEP_PREFERRED:
        kept = F.col("_kept").isNotNull()
        number = F.coalesce("_kept", "_most")
        why = F.when(kept, F.lit(f"{KEEP_PREFERRED}({spec.preferred_env})")).otherwise(
            F.lit(PICK_MAJORITY)
        )
    else:
        number = {
            PICK_MAJORITY: F.col("_most"),
            FIRST: F.col("_any"),
            NEW_RANGE: F.lit(None).cast("string"),
        }[strategy]
        why = F.lit(strategy)
    return number, F.when(numbered, why).otherwise(F.lit(NO_NUMBER))


def _conflict_values(
    cleaned: DataFrame, folds: DataFrame, comp: Component, spec: MergeSpec
) -> DataFrame:
    """The distinct numbers and types of each description among the sources."""
    number = F.col(comp.number)
    nothing = F.lit(None).cast("string")
    values = folds.filter(number.isNotNull()).select(
        "DESC_KEY", number.alias("_number"), nothing.alias("_category")
    )
    if comp.category:
        categories = (
            _sources(cleaned, spec)
            .filter(F.col(comp.category).isNotNull())
            .select("DESC_KEY", F.col(comp.category).alias("_category"))
            .distinct()
        )
        values = values.unionByName(categories, allowMissingColumns=True)
    return values


def conflict_values(
    cleaned: DataFrame, folds: DataFrame, comp: Component, spec: MergeSpec
) -> DataFrame:
    """``DESC_KEY, KIND, VALUE`` of descriptions with several numbers or types, in long form."""
    values = _conflict_values(cleaned, folds, comp, spec)
    several = values.groupBy("DESC_KEY").agg(_several().alias("_several")).filter("_several")
    return values.join(several, "DESC_KEY").select(
        "DESC_KEY",
        F.when(F.col("_number").isNotNull(), "number").otherwise("type").alias("KIND"),
        F.coalesce("_number", "_category").alias("VALUE"),
    )


def _several() -> Column:
    return (F.count("_number") > 1) | (F.count("_category") > 1)


def merge_conflicts(
    cleaned: DataFrame,
    folds: DataFrame,
    unified: DataFrame,
    comp: Component,
    spec: MergeSpec,
    bounded: bool = False,
) -> DataFrame:
    """Descriptions with several numbers or types among the sources, all listed.

    One row per description, whatever the number of its values; the form without
    such texts is :func:`conflict_values`. ``bounded`` says that the ledger is stored by
    description and none of them is hot.
    """
    lists = {"Numbers": folds.select("DESC_KEY", F.col(comp.number).alias("Numbers"))}
    if comp.category:
        kinds = _sources(cleaned, spec).select("DESC_KEY", F.col(comp.category).alias("Types"))
        lists["Types"] = kinds.distinct()
    found, several = unified, F.lit(False)
    for name, values in lists.items():
        least, most = f"_least_{name}", f"_most_{name}"
        texts = ordered_texts(
            values.filter(F.col(name).isNotNull()),
            ["DESC_KEY"],
            [name],
            name,
            ", ",
            least={least: F.col(name)},
            most={most: F.col(name)},
            bounded=bounded,
        )
        found = found.join(texts, "DESC_KEY", "left")
        several = several | F.coalesce(F.col(least) < F.col(most), F.lit(False))
    texts = [F.coalesce(name, F.lit("")).alias(name) for name in lists]
    return found.filter(several).select("DESC_KEY", "DESCRIPTION", *texts, "Why_Canonical")


def merge_actions(
    cleaned: DataFrame,
    unified: DataFrame,
    comp: Component,
    spec: MergeSpec,
    ordinal: str = "_ord",
) -> DataFrame:
    """What the target needs for every unified description.

    A description that the target holds under several numbers gets one row for each of them. A
    canonical number that other descriptions use there is named after the first of these.
    """
    target = cleaned.filter(F.col("ENV") == spec.target.name)
    own = target.select("DESC_KEY", F.col(comp.number).alias("_own")).distinct()
    used = target.filter(F.col(comp.number).isNotNull() & F.col("DESC_KEY").isNotNull())
    holders = two_holders(used, [comp.number], "DESC_KEY", ordinal, "DESCRIPTION").select(
        F.col(comp.number).alias("_canonical"), "first", "second"
    )
    named = unified.withColumnRenamed(f"{comp.number}_CANONICAL", "_canonical")
    joined = even_left_join(named, own, "DESC_KEY").join(
        shuffle_anew(holders, "_canonical"), "_canonical", "left"
    )
    other = rival(F.col("first"), F.col("second"), "DESC_KEY")

    canonical, present = F.col("_canonical"), F.col("_own")
    collision = other.isNotNull()
    missing = present.isNull() & canonical.isNotNull()
    holder = F.coalesce(other["DESCRIPTION"], F.lit(""))
    category = (
        [F.col(f"{comp.category}_CANONICAL").alias(comp.category)] if comp.category else []
    )
    return joined.select(
        F.when(collision, F.lit(REVIEW))
        .when(missing | canonical.isNull(), F.lit(CREATE))
        .otherwise(F.lit(REVIEW))
        .alias("ActionType"),
        F.when(collision, F.concat(F.lit(TAKEN_IN_TARGET), holder))
        .when(same_value(present, canonical), F.lit(SAME_IN_TARGET))
        .when(canonical.isNull(), F.lit(NO_CANONICAL))
        .when(missing, F.lit(FREE))
        .otherwise(F.lit(CROSS_CHECK))
        .alias("Reason"),
        F.lit(spec.target.name).alias("ENV"),
        F.lit(spec.target.datalib).alias("DATALIB"),
        F.lit(spec.target.company).alias("COMPANY"),
        "DESCRIPTION",
        F.col("DESCRIPTION_LANG_CANONICAL").alias("DESCRIPTION_LANG"),
        canonical.alias(comp.number),
        *category,
    )


def merge_mappings(
    cleaned: DataFrame,
    unified: DataFrame,
    comp: Component,
    spec: MergeSpec,
    ordinal: str = "_ord",
    bounded: bool = False,
) -> DataFrame:
    """Old number to canonical number, per source environment and description.

    Equal entries collapse before the join, the first one in input order wins. ``bounded``
    says that both tables are stored by description and none of these is hot.
    """
    entries = (
        _sources(cleaned, spec)
        .filter(F.col("DESC_KEY").isNotNull())
        .groupBy("DESC_KEY", "ENV", "DESCRIPTION", comp.number)
        .agg(F.min(F.struct(ordinal, "DATALIB", "COMPANY")).alias("_first"))
        .select("DESC_KEY", "ENV", "DESCRIPTION", comp.number, "_first.*")
    )
    canonical = F.col(f"{comp.number}_CANONICAL")
    same = same_value(F.col(comp.number), canonical)
    chosen = unified.select("DESC_KEY", canonical, "Why_Canonical")
    if not bounded:
        chosen = shuffle_anew(chosen, "DESC_KEY")
    return entries.join(chosen, "DESC_KEY", "left").select(
        F.col("ENV").alias("Source_ENV"),
        "DATALIB",
        "COMPANY",
        "DESCRIPTION",
        F.col(comp.number).alias(f"{comp.number}_SOURCE"),
        canonical,
        same.alias("Same_Number"),
        F.when(canonical.isNull(), F.lit(SUGGEST_CREATE))
        .when(same, F.lit(SUGGEST_KEEP))
        .otherwise(F.lit(SUGGEST_MAP))
        .alias("Suggested_Action"),
        F.lit(spec.target.name).alias("Target_ENV"),
        "Why_Canonical",
    )
