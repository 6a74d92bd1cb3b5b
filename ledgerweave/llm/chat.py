"""Chat logs folded into messages and rendered by a template, in DataFrame functions only.

A log holds events (conv_id, turn, seq, kind, role, text). Within a turn, in the order
of ``seq``: ``message`` opens a message, ``delta`` appends to it, ``edit`` replaces its
text, ``regenerate`` drops its text and waits for further deltas; other kinds are
ignored. Events ahead of any ``message`` form a message of their own, so that a log
whose start got lost keeps its text.

Nulls: a null text or role is empty; null conversations form one conversation, null
turns and places come first. Ties in ``seq`` are ordered by kind, role and text, so
results do not depend on row order, and a repeated ``message`` event is a further
message. Columns beside the named ones are not read. An empty log gives no rows.

The parts of a turn are folded where the turn lies; only finished messages move on to
their conversation, whose text is a single value and so has to be in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "edit", "regenerate", "delta")


def escape(text: Column) -> Column:
    """``text`` without control strings: a backslash goes between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(
        F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")
    )


def _unescape_role(role: Column) -> Column:
    # A letter follows each backslash that is no part of a pair.
    line = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(F.replace(line, F.lit("\\\\"), F.lit("\\")))


def fold_events(events: DataFrame) -> DataFrame:
    """The messages (conv_id, turn, part, role, text) that a log leaves."""
    kind = F.coalesce(F.col("kind"), F.lit(""))
    place = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    log = events.filter(kind.isin(*KINDS)).select(
        "conv_id",
        "turn",
        "seq",
        place.alias("place"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id", "turn").orderBy("seq", "place", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = log.withColumns(
        {
            "part": F.sum((F.col("place") == 1).cast("long")).over(so_far),
            "version": F.sum((F.col("place") < 4).cast("long")).over(so_far),
            "at": F.row_number().over(order),
        }
    )
    # What was streamed since the last reset; all of this stays where the turn lies.
    versions = numbered.groupBy("conv_id", "turn", "part", "version").agg(
        F.array_join(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct("at", F.when(F.col("place") == 3, "").otherwise(F.col("text")).alias("text"))
                    )
                ),
                lambda piece: piece["text"],
            ),
            "",
        ).alias("text"),
        F.min_by("role", "at").alias("role"),
    )
    return versions.groupBy("conv_id", "turn", "part").agg(
        F.min_by("role", "version").alias("role"), F.max_by("text", "version").alias("text")
    )


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One formatted text per conversation (conv_id, n_turns, formatted, loss_spans).

    ``loss_spans`` is the loss mask: start (from 0) and length, in code points of the
    formatted text, of each text by the role ``trained``.
    """
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    pieces = messages.withColumns({"head": head, "body": escape(F.col("text"))}).select(
        "conv_id",
        "turn",
        "part",
        F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.length("head").cast("long").alias("head_chars"),
        F.length("body").cast("long").alias("body_chars"),
        (F.col("role") == trained).alias("trained"),
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("turn", "part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = pieces.withColumn(
        "start", F.coalesce(F.sum(F.length("piece").cast("long")).over(earlier), F.lit(0))
    )
    ordered = F.array_sort(
        F.collect_list(F.struct("turn", "part", "piece", "start", "head_chars", "body_chars", "trained"))
    )
    return (
        placed.groupBy("conv_id")
        .agg(ordered.alias("pieces"))
        .select(
            "conv_id",
            F.size("pieces").cast("long").alias("n_turns"),
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
            F.transform(
                F.filter("pieces", lambda p: p["trained"]),
                lambda p: F.struct(
                    (p["start"] + p["head_chars"]).alias("start"), p["body_chars"].alias("length")
                ),
            ).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, as they were before rendering."""
    records = F.split(formatted, r"<\|im_end\|>\n")
    records = F.slice(records, 1, F.size(records) - 1)

    def turn(record: Column) -> Column:
        content = F.substring(record, F.lit(len(START) + 1), F.length(record))
        role = F.substring_index(content, "\n", 1)
        text = F.substring(content, F.length(role) + 2, F.length(content))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(records, turn)


def read_masked(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))
            ),
        ),
        "",
    )
