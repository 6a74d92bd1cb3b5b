"""Writing result tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import Component
from ledgerweave.storage import exists, in_passing, materialise, move, remove

# Result names and the tables they are written to, after the component code.
RESULTS = {
    "Summary": "RunSummary",
    "Cleaned Data": "Cleaned",
    "Filtered Out": "Filtered",
    "Filter Summary": "Summary",
    "Presence Matrix (binary)": "PresenceBin",
    "Presence Matrix (enriched)": "Presence",
    "Create": "Create",
    "Review": "Review",
    "Number Mismatches": "NumMismatch",
    "Type Mismatches": "TypeMismatch",
    "Config": "Config",
}
TEXT_FORMATS = ("csv", "json")
MANIFEST = "TABLE string, FORMAT string, ROWS bigint"
TEXT_DATE = "dd-MM-yyyy"


def table_names(comp: Component) -> dict[str, str]:
    """The usual table of each result of ``comp``."""
    return {name: f"{comp.code}_{table}" for name, table in RESULTS.items()}


class Sink:
    """Writes result tables below one folder, each under its mapped name.

    Existing results are never overwritten. Text formats show time stamps as
    day-month-year and take structs apart.
    """

    def __init__(
        self, folder: str, names: Mapping[str, str] | None = None, format: str = "parquet"
    ) -> None:
        self.folder = folder.rstrip("/")
        self.names = names or {}
        self.format = format
        self.rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{self.names.get(name, name)}"

    def write(self, name: str, table: DataFrame, order: Sequence[str] = ()) -> int:
        """Write one table and return its number of rows; ``order`` sorts it by range."""
        if order:
            table = table.orderBy(*order)
        if self.format in TEXT_FORMATS:
            table = _as_text(table)

        def save(rows: DataFrame) -> None:
            writer = rows.write.mode("errorifexists").format(self.format)
            if self.format == "csv":
                writer = writer.option("header", True)
            writer.save(self.path(name))

        self.rows[name] = in_passing(table, {"rows": F.count(F.lit(1))}, save)[1]["rows"]
        return self.rows[name]

    def write_part(
        self, name: str, part: str, table: DataFrame, order: Sequence[str] = ()
    ) -> int:
        """Write a part of the result ``name``: a table of its name with ``part`` behind."""
        whole = f"{name} {part}"
        self.names = {**self.names, whole: f"{self.names.get(name, name)}_{part}"}
        return self.write(whole, table, order)

    def keep(self, name: str, table: DataFrame) -> DataFrame:
        """Write a table that further results are made from; return it as stored.

        A parquet result serves as its own intermediate table.
        """
        if self.format == "parquet":
            self.write(name, table)
            return self.read(name, table)
        stored = materialise(table)
        self.write(name, stored)
        return stored

    def read(self, name: str, like: DataFrame) -> DataFrame:
        """A parquet table as written, with the columns and types of ``like``."""
        return like.sparkSession.read.schema(like.schema).parquet(self.path(name))


def manifest_path(folder: str) -> str:
    return f"{folder.rstrip('/')}_manifest"


@contextmanager
def publishing(
    spark: SparkSession,
    folder: str,
    names: Mapping[str, str] | None = None,
    format: str = "parquet",
) -> Iterator[Sink]:
    """A sink whose tables appear below ``folder`` together at the end, or not at all on failure.

    They are written to a folder of this attempt beside it, which is renamed when all are
    complete. A manifest beside the results, one row per table with its number of rows, comes
    last: where renaming a folder takes more than one step, results without it are not whole.
    Results that exist, whole or not, are refused before anything is computed, and again at the
    end, should another attempt have been faster. The folder of a killed attempt is never taken
    for a result, nor touched by later ones. Afterwards the sink reads from the published place.
    """
    folder = folder.rstrip("/")
    for taken in (folder, manifest_path(folder)):
        if exists(spark, taken):
            raise FileExistsError(f"[RESULT_ALREADY_EXISTS] there is {taken} already")
    parent, _, run = folder.rpartition("/")
    sink = Sink(f"{parent}/_unfinished_{run}_{uuid.uuid4().hex}", names, format)
    try:
        yield sink
        move(spark, sink.folder, folder)
    except BaseException:
        remove(spark, sink.folder)
        raise
    sink.folder = folder
    listed = [(sink.names.get(name, name), format, rows) for name, rows in sink.rows.items()]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.json(manifest_path(folder))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``TABLE, FORMAT, ROWS`` of the published results below ``folder``."""
    if not exists(spark, f"{manifest_path(folder)}/_SUCCESS"):
        raise FileNotFoundError(f"nothing whole was published as {folder}")
    return spark.read.schema(MANIFEST).json(manifest_path(folder))


def read_results(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The published result tables below ``folder`` by name; refuses what is not whole."""
    return {
        row.TABLE: spark.read.format(row.FORMAT)
        .options(**({"header": True} if row.FORMAT == "csv" else {}))
        .load(f"{folder.rstrip('/')}/{row.TABLE}")
        for row in read_manifest(spark, folder).collect()
    }


def _as_text(table: DataFrame) -> DataFrame:
    columns = []
    for field in table.schema:
        column, kind = table[f"`{field.name}`"], field.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz", "date"):
            columns.append(F.date_format(column, TEXT_DATE).alias(field.name))
        elif kind == "struct":
            columns += [column[part].alias(f"{field.name}_{part}") for part in field.dataType.names]
        else:
            columns.append(column)
    return table.select(*columns)
