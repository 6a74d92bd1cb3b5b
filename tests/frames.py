"""Small ledgers for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.component import Component

SCHEMA = {
    "DATALIB": "string",
    "COMPANY": "string",
    "ACCOUNT": "string",
    "COSTCENTER": "string",
    "DESCRIPTION": "string",
    "DESC_KEY": "string",
    "ENV": "string",
    "TYPE": "string",
    "DESCRIPTION_LANG": "string",
    "DOORTREK_JN": "string",
    "VERDREK_JN": "string",
    "LASTUSED_DATE": "timestamp_ntz",
    "_ord": "bigint",
}


def columns_of(comp: Component) -> list[str]:
    foreign = {"GL": ["COSTCENTER"], "CC": ["ACCOUNT", "TYPE", "DOORTREK_JN", "VERDREK_JN"]}
    return [name for name in SCHEMA if name not in foreign[comp.code]]


def ledger(spark: SparkSession, comp: Component, rows: list[dict]) -> DataFrame:
    """A conformed ledger from partial rows, in their order.

    ``DESC_KEY`` defaults to the lower-case description; the environment follows
    from ``ENV`` or from library and company.
    """
    full = []
    for position, given in enumerate(rows):
        row = {"_ord": position, **given}
        if "ENV" in row:
            lib, _, company = row["ENV"].partition("-")
            row = {"DATALIB": lib, "COMPANY": company, **row}
        row.setdefault("DESC_KEY", (row.get("DESCRIPTION") or "").lower())
        full.append(tuple(row.get(name) for name in columns_of(comp)))
    schema = ", ".join(f"{name} {SCHEMA[name]}" for name in columns_of(comp))
    return spark.createDataFrame(full, schema)


def rows(df: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
