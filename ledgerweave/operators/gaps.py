"""What to do about descriptions that an environment lacks.

A gap is a ``(DESC_KEY, ENV)`` without a row. There are up to (descriptions x
environments) of them, far more than ledger rows, so everything a gap needs is
joined while there is still one row per description and chunk of environments;
the gaps are exploded last and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.functions.firsts import first_by
from ledgerweave.functions.numbers import as_double, format_double, format_number
from ledgerweave.functions.text import or_null_text
from ledgerweave.operators.axis import (
    BIT,
    BROADCAST_LIMIT,
    CHUNK,
    CHUNK_SIZE,
    Axis,
    each_chunk,
    entry,
    has,
    numbered_axis,
    single,
    sparse_set,
)
from ledgerweave.operators.holders import rival, two_holders
from ledgerweave.operators.joins import shuffle_anew

# Action types and reasons.
CREATE, REVIEW = "Create", "Review"
FREE = "Target mist nummer"
TAKEN_SAME = "Nummer bestaat al in target voor dezelfde omschrijving"
TAKEN_OTHER = "Nummer bestaat al in target voor andere omschrijving"


def environment_axis(
    cleaned: DataFrame,
    comp: Component,
    gaps: DataFrame | None = None,
    chunk_size: int = CHUNK_SIZE,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> Axis:
    """The environments of the ledger (and of ``gaps``), with the highest number of each.

    One job over two columns of the ledger stores them, so that the plan does not compute them again.
    """
    frame = cleaned.groupBy("ENV").agg(F.max(as_double(F.col(comp.number))).alias("_max"))
    if gaps is not None:
        lone = gaps.select("ENV", F.lit(None).cast("double").alias("_max"))
        frame = frame.unionByName(lone).groupBy("ENV").agg(F.max("_max").alias("_max"))
    return numbered_axis(frame, chunk_size, broadcast_limit)


def gap_actions(
    cleaned: DataFrame,
    comp: Component,
    gaps: DataFrame | None = None,
    *,
    kind: str | None = None,
    cells: DataFrame | None = None,
    ordinal: str = "_ord",
    chunk_size: int = CHUNK_SIZE,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One action per gap: create the entry, or review it when its number is taken.

    A missing entry inherits each attribute from the first environment (by name)
    that has one. When the environment already uses the inherited number for
    another description, the action names that description and suggests the
    number after the environment's highest one.

    ``gaps`` gives the ``(DESC_KEY, ENV)`` pairs to judge instead of the ones the
    ledger lacks; only then can a number be taken by the same description.
    ``cells`` are the presence cells of the ledger, if they are at hand already.
    ``kind`` asks for the actions of one type; the others are never made.
    """
    joined, axis = _judged(cleaned, comp, gaps, cells, ordinal, chunk_size, broadcast_limit)
    if kind is not None:
        chosen = _of_kind(kind)
        joined = joined.withColumn("_missing", chosen).filter(F.col("_missing") != 0)
    bit = F.col(BIT)
    found = (
        axis.with_names(_phrased(joined, comp))
        .select("*", F.posexplode("_names").alias(BIT, "_env"))
        .filter(has(F.col("_missing"), bit))
        .select("*", "_env.*", entry(F.col("_users"), F.col("_taken"), bit).alias("_user"))
    )
    return _worded(found, comp)


def action_counts(
    cleaned: DataFrame,
    comp: Component,
    gaps: DataFrame | None = None,
    *,
    cells: DataFrame | None = None,
    ordinal: str = "_ord",
    chunk_size: int = CHUNK_SIZE,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row with the number of actions of each type, counted on the sets without making any."""
    joined, _ = _judged(cleaned, comp, gaps, cells, ordinal, chunk_size, broadcast_limit)
    return joined.agg(
        *(
            F.coalesce(F.sum(F.bit_count(_of_kind(kind)).cast("bigint")), F.lit(0)).alias(kind)
            for kind in (CREATE, REVIEW)
        )
    )


def _of_kind(kind: str) -> Column:
    """The missing environments that use the number already, or those that do not."""
    taken = F.coalesce("_taken", F.lit(0))
    if kind not in (CREATE, REVIEW):
        raise ValueError(f"unknown type of action: {kind}")
    return F.col("_missing").bitwiseAND(taken if kind == REVIEW else F.bitwise_not(taken))


def _judged(
    cleaned: DataFrame,
    comp: Component,
    gaps: DataFrame | None,
    cells: DataFrame | None,
    ordinal: str,
    chunk_size: int,
    broadcast_limit: int,
) -> tuple[DataFrame, Axis]:
    """Per description and chunk: what is missing there, and who uses its number."""
    axis = environment_axis(cleaned, comp, gaps, chunk_size, broadcast_limit)
    if cells is None:
        described = _described(cleaned, comp, axis, F.col("ENV"), F.col(ordinal))
    else:
        described = _described(cells, comp, axis, F.col("ENV"))
    wanted = _lacking(described, axis) if gaps is None else _given(described, axis, gaps)
    taken = _taken(cleaned, comp, axis, ordinal, rivals=1 if gaps is None else 2)

    return wanted.join(shuffle_anew(taken, comp.number), [comp.number, CHUNK], "left"), axis


def _described(source: DataFrame, comp: Component, axis: Axis, *order: Column) -> DataFrame:
    """Per description: inherited attributes, and its environments as sets by chunk."""
    attributes = [name for name in comp.attributes if name in source.columns]
    by_chunk = (
        axis.locate(source)
        .groupBy("DESC_KEY", CHUNK)
        .agg(
            F.bit_or(single(F.col(BIT))).alias("_held"),
            *(first_by(F.col(name), *order).alias(name) for name in attributes),
        )
    )
    held = sparse_set(F.col(CHUNK), F.col("_held"))
    return by_chunk.groupBy("DESC_KEY").agg(
        held.alias("_held"), *(F.min(name)["value"].alias(name) for name in attributes)
    )


def _lacking(described: DataFrame, axis: Axis) -> DataFrame:
    """Per description and chunk: the environments without the description."""
    missing = axis.full().bitwiseAND(F.bitwise_not(F.col("_members")))
    return (
        each_chunk(described, "_held", axis, "_members")
        .withColumn("_missing", missing)
        .drop("_members")
        .filter(F.col("_missing") != 0)
    )


def _given(described: DataFrame, axis: Axis, gaps: DataFrame) -> DataFrame:
    """Per description and chunk: the environments that ``gaps`` names."""
    return (
        axis.locate(gaps.select("DESC_KEY", "ENV"))
        .groupBy("DESC_KEY", CHUNK)
        .agg(F.bit_or(single(F.col(BIT))).alias("_missing"))
        .join(described.drop("_held"), "DESC_KEY", "left")
    )


def _taken(
    cleaned: DataFrame, comp: Component, axis: Axis, ordinal: str, rivals: int
) -> DataFrame:
    """Per number and chunk: the environments that use it, and who does there.

    A user entry holds the first ``rivals`` descriptions and the next free number.
    One is enough for gaps of the ledger itself: no description that has the
    number in an environment is missing there. Reducing every ``(ENV, number)`` to
    a row first keeps popular numbers from multiplying gaps.
    """
    place = ["ENV", comp.number]
    used = cleaned.filter(F.col(comp.number).isNotNull())
    if rivals == 1:
        holder = F.struct(F.col(ordinal).alias("at"), "DESC_KEY", "DESCRIPTION")
        users = used.groupBy(*place).agg(F.min(holder).alias("first"))
        users = users.withColumn("second", F.when(F.lit(False), F.col("first")))
    else:
        users = two_holders(used, place, "DESC_KEY", ordinal, "DESCRIPTION")
    following = format_double(F.col("_max") + 1).alias("next")
    return (
        axis.locate(users, "_max")
        .groupBy(comp.number, CHUNK)
        .agg(
            F.bit_or(single(F.col(BIT))).alias("_taken"),
            F.array_sort(F.collect_list(F.struct(BIT, "first", "second", following))).alias("_users"),
        )
    )


def _phrased(described: DataFrame, comp: Component) -> DataFrame:
    """What the gaps of a description have in common, worked out once for all of them."""
    number = or_null_text(F.col(comp.number))
    description = or_null_text(F.col("DESCRIPTION"))
    words = [F.lit(f" {comp.noun} with "), number, F.lit(" and "), description]
    if comp.sentence_has_lang:
        words += [F.lit(" and "), or_null_text(F.col("DESCRIPTION_LANG"))]
    exists = [F.lit(f" — {comp.noun} "), number, F.lit(" already exists for '"), description]
    return described.withColumns(
        {
            "_shown": format_number(F.col(comp.number)),
            "_what": F.concat(*words),
            "_exists": F.concat(*exists, F.lit("'")),
        }
    )


def _worded(found: DataFrame, comp: Component) -> DataFrame:
    """Action type, reason and sentence of every gap, in the columns of the report."""
    other = rival(F.col("_user.first"), F.col("_user.second"), "DESC_KEY")
    found = found.withColumns({"_used": F.col("_user").isNotNull(), "_rival": other})
    collision = F.col("_rival").isNotNull()
    aligned = F.col("_used") & ~collision
    kind = F.when(F.col("_used"), F.lit(REVIEW)).otherwise(F.lit(CREATE))
    category = [comp.category] if comp.category else []
    return found.select(
        kind.alias("ActionType"),
        F.when(collision, F.lit(TAKEN_OTHER))
        .when(aligned, F.lit(TAKEN_SAME))
        .otherwise(F.lit(FREE))
        .alias("Reason"),
        "ENV",
        "DATALIB",
        "COMPANY",
        "DESCRIPTION",
        "DESCRIPTION_LANG",
        F.col("_shown").alias(comp.number),
        *category,
        F.coalesce(F.col("_rival.DESCRIPTION"), F.lit("")).alias("Conflicting_Description"),
        F.when(collision, F.col("_user.next")).alias("Suggested_Number"),
        F.when(aligned, F.concat(F.lit(f"Verify {comp.verify_what} in "), "ENV", "_exists"))
        .otherwise(F.concat(kind, F.lit(" in "), "ENV", "_what"))
        .alias("Action"),
    )
