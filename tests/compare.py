"""Run queries and their SQL counterparts on the same tables and compare results.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, con, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Number of rows, and what is wrong."""
    found = entry.queries()[name](spark, sf_dir)
    expected = con.sql(entry.oracle_sql()[name])
    columns = sorted(found.columns)
    if columns != sorted(expected.columns):
        return 0, [f"columns {columns} != {sorted(expected.columns)}"]
    wrong = []
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    for column, kind in found.dtypes:
        if TYPES.get(kind) != kinds[column]:
            wrong.append(f"{column}: {kind} != {kinds[column]}")
    ours = [tuple(row) for row in found.select(*(f"`{c}`" for c in columns)).collect()]
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = expected.project(quoted).fetchall()
    left, right = Counter(ours), Counter(theirs)
    if left != right:
        wrong.append(
            f"{len(ours)} rows against {len(theirs)}; "
            f"only here {list((left - right).items())[:3]}; "
            f"only there {list((right - left).items())[:3]}"
        )
    return len(ours), wrong


def main() -> None:
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), engine(sf_dir)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            rows, wrong = differences(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            rows, wrong = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        verdict, taken = "FAIL" if wrong else "ok  ", time.time() - start
        print(f"{verdict} {name:35} {rows:7} {taken:5.1f}s", *wrong, flush=True)


if __name__ == "__main__":
    main()
