"""From a raw table to a conformed ledger.

Everything after the read is a projection: no shuffle, no Python worker, and it
applies to a streaming DataFrame just as well. Only the check of the declared
schema runs a job, unless it is left to the one that stores the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.functions.dates import parse_last_used
from ledgerweave.functions.numbers import number_text
from ledgerweave.functions.text import canonical_key, environment, squeeze
from ledgerweave.sources.quality import (
    require_columns,
    require_none,
    require_valid,
    violation_figures,
)
from ledgerweave.storage import in_passing, materialise

# Position of a row in its source. Spark rows have no order of their own, but
# "first" results depend on one.
ORDINAL = "_ord"
# Bits of an ordinal for the row's place in its file, and for the file's number above them.
ROW_BITS, FILE_BITS = 38, 25
# Up to this many files, some 30 MB of paths, their numbers are broadcast; more are left to Spark.
BROADCAST_FILES = 200_000


@dataclass(frozen=True)
class TableLocation:
    """Where the table of one component lies and how to read it."""

    base: str
    table: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def table_for(comp: Component, locations: Mapping[str, TableLocation]) -> TableLocation:
    """Location of ``comp`` among ``locations``; ``ValueError`` when there is none."""
    if comp.code not in locations:
        raise ValueError(f"no table location for component {comp.code!r}")
    return locations[comp.code]


def read_table(spark: SparkSession, location: TableLocation) -> DataFrame:
    """Read a file table with a stable ordinal.

    For parquet the ordinal is a number: the file's place among the files in order of their
    paths, then the row's place in that file. It survives retries, other cluster sizes and pruned
    columns alike, and aggregates carry eight bytes instead of a path. The files are those the
    planner lists when the table is read. Formats without row places get Spark's generated row
    id, which is only stable for unchanged input splits: write such a table out once before using
    it twice.
    """
    raw = (
        spark.read.format(location.format)
        .options(**location.options)
        .load(f"{location.base.rstrip('/')}/{location.table}")
    )
    if ORDINAL in raw.columns:
        return raw
    if location.format != "parquet":
        return raw.select("*", F.monotonically_increasing_id().alias(ORDINAL))
    return _with_ordinals(raw)


def _with_ordinals(raw: DataFrame, broadcast_files: int = BROADCAST_FILES) -> DataFrame:
    # The list has schemes without authority as scheme:///path, the rows as scheme:/path.
    paths = sorted(path.replace(":///", ":/", 1) for path in raw.inputFiles())
    if len(paths) >= 1 << FILE_BITS:
        raise ValueError(f"{len(paths):,} files are more than an ordinal can number")
    file = "_file"
    while file in raw.columns:
        file = f"_{file}"
    numbered = raw.sparkSession.createDataFrame(
        [(file_at,) for file_at in enumerate(paths)], f"{file} struct<number:bigint, path:string>"
    )
    if len(paths) <= broadcast_files:
        numbered = F.broadcast(numbered)
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))
    placed = raw.select("*", place.alias(ORDINAL))
    path, row = F.col(f"{ORDINAL}.path"), F.col(f"{ORDINAL}.row")
    unlisted = F.raise_error(F.concat(F.lit("file not in the list of the table: "), path))
    number = F.coalesce(F.col(f"{file}.number"), unlisted.cast("bigint"))
    return (
        placed.join(numbered, path == F.col(f"{file}.path"), "left")
        .withColumn(ORDINAL, number * (1 << ROW_BITS) + row)
        .drop(file)
    )


def normalise_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strip and upper-case column names, then apply ``renames`` (also upper-cased).

    Names in ``renames`` that the table lacks are ignored. Two columns ending up
    with one name raise ``ValueError``.
    """
    target = {old.upper(): new.upper() for old, new in (renames or {}).items()}
    names = []
    for column in df.columns:
        name = column if column == ORDINAL else column.strip().upper()
        names.append(target.get(name, name))
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"several columns would be called {repeated}")
    return df.toDF(*names)


def conform(
    df: DataFrame,
    comp: Component,
    renames: Mapping[str, str] | None = None,
    *,
    order_by: Column | None = None,
    date_formats: Sequence[str] = (),
    check: bool = True,
) -> DataFrame:
    """Normalise a raw table into a ledger with ``DESC_KEY``, ``ENV`` and ``_ord``.

    ``order_by`` names the business key that orders rows, unless the table already
    has an ordinal. With ``check`` the declared schema is verified first, in one
    job, and violations raise :class:`~ledgerweave.sources.quality.SchemaViolations`.
    Columns beyond the declared ones pass through.
    """
    pending = conform_later(df, comp, renames, order_by=order_by, date_formats=date_formats)
    if check:
        require_valid(pending.raw, comp)
    return pending.project(pending.raw)


@dataclass(frozen=True)
class PendingLedger:
    """A ledger whose declared schema is checked by the job that stores it.

    ``raw`` has the declared column names, ``project`` makes the conformed ledger of it.
    """

    raw: DataFrame
    comp: Component
    project: Callable[[DataFrame], DataFrame]

    def store(
        self, figures: Callable[[DataFrame], Mapping[str, Column]] | None = None
    ) -> tuple[DataFrame, dict[str, int]]:
        """Store the conformed ledger; return it with the ``figures`` asked for.

        One job reads the source, checks it, takes the figures and writes the table.
        Violations raise :class:`~ledgerweave.sources.quality.SchemaViolations` afterwards;
        the table is then an intermediate that nothing reads.
        """

        def write(rows: DataFrame) -> tuple[DataFrame, dict[str, int]]:
            ledger = self.project(rows)
            if figures is None:
                return materialise(ledger), {}
            return in_passing(ledger, figures(ledger), materialise)

        stored, broken = in_passing(self.raw, violation_figures(self.comp), write)
        require_none(broken, self.raw, self.comp)
        return stored


def conform_later(
    df: DataFrame,
    comp: Component,
    renames: Mapping[str, str] | None = None,
    *,
    order_by: Column | None = None,
    date_formats: Sequence[str] = (),
) -> PendingLedger:
    """Like :func:`conform`, with the check left to the job that stores the ledger."""
    ledger = normalise_columns(df, renames)
    require_columns(ledger, comp)
    if order_by is not None:
        ledger = ledger.withColumn(ORDINAL, order_by)
    elif ORDINAL not in ledger.columns:
        raise ValueError(f"rows need an order: give order_by or a {ORDINAL} column")
    return PendingLedger(ledger, comp, lambda rows: _projected(rows, comp, date_formats))


def _projected(ledger: DataFrame, comp: Component, date_formats: Sequence[str]) -> DataFrame:
    types = dict(ledger.dtypes)
    if "DESCRIPTION_LANG" not in types:
        ledger = ledger.withColumn("DESCRIPTION_LANG", F.lit(None).cast("string"))
    clean = {name: squeeze(F.col(name).cast("string")) for name in comp.text_columns}
    return ledger.withColumns(
        {
            **clean,
            comp.number: number_text(F.col(comp.number), types[comp.number]),
            **{flag: F.col(flag).cast("string") for flag in comp.flags},
            "LASTUSED_DATE": parse_last_used(
                F.col("LASTUSED_DATE"), types["LASTUSED_DATE"], date_formats
            ),
        }
    ).withColumns(
        {
            "DESC_KEY": canonical_key(F.col("DESCRIPTION")),
            "ENV": environment(F.col("DATALIB"), F.col("COMPANY")),
        }
    )


def load(
    spark: SparkSession,
    comp: Component,
    locations: Mapping[str, TableLocation],
    renames: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Read and conform the table of ``comp``; ``options`` go to :func:`conform`."""
    return conform(read_table(spark, table_for(comp, locations)), comp, renames, **options)


def load_later(
    spark: SparkSession,
    comp: Component,
    locations: Mapping[str, TableLocation],
    renames: Mapping[str, str] | None = None,
    **options,
) -> PendingLedger:
    """Like :func:`load`, checked by the job that stores it; for ``run_component``."""
    return conform_later(read_table(spark, table_for(comp, locations)), comp, renames, **options)
