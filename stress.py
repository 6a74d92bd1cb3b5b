"""Time the operators on a large, skewed ledger made for the purpose.

A third of the rows share one description and a third one number; descriptions are
not plain ASCII. ``python stress.py [million rows] [environments] [heap]`` writes to
a new temporary folder. Beside the seconds stand the MB a step shuffled, from Spark's event log.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave import GL, MergeSpec, conform
from ledgerweave import operators as ops
from ledgerweave.plans import run_component
from ledgerweave.plans.merge_plan import component_merge
from ledgerweave.storage import materialise

LIBRARIES = 20


def deal(seed: int):
    """A repeatable random number for each row."""
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))


def delivered(spark: SparkSession, rows: int, envs: int) -> DataFrame:
    """The ledger as a source system would hand it over."""
    entry = (deal(2) % max(1, rows // 50)).cast("string")
    name = F.concat(F.lit("Açcount  "), entry, F.lit(" – general"))
    number = (deal(6) % max(1, rows // 20)).cast("string")
    return spark.range(0, rows, 1, 32).select(
        F.concat(F.lit("LIB"), deal(3) % LIBRARIES).alias("DATALIB"),
        (deal(4) % max(1, envs // LIBRARIES)).cast("string").alias("COMPANY"),
        F.when(deal(5) % 3 == 0, "9999").otherwise(number).alias("ACCOUNT"),
        F.when(deal(1) % 3 == 0, "---").otherwise(name).alias("DESCRIPTION"),
        F.concat(F.lit("T"), deal(7) % 5).alias("TYPE"),
        F.concat(F.lit("long "), entry).alias("DESCRIPTION_LANG"),
        F.lit("20240115").alias("LASTUSED_DATE"),
        F.lit("N").alias("DOORTREK_JN"),
        F.lit("N").alias("VERDREK_JN"),
        F.col("id").alias("_ord"),
    )


def shuffled(folder: str) -> dict[str, float]:
    """MB written to shuffles, by the job group of the step, from the event log."""
    step, found = {}, {}
    for path in Path(folder).iterdir():
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = (event.get("Properties") or {}).get("spark.jobGroup.id")
                step |= {stage: name for stage in event["Stage IDs"]}
            elif event["Event"] == "SparkListenerTaskEnd":
                written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                name = step.get(event["Stage ID"])
                found[name] = found.get(name, 0) + written.get("Shuffle Bytes Written", 0) / 1e6
    return found


def main() -> None:
    events = tempfile.mkdtemp(prefix="run-events-")
    rows = int(float(sys.argv[1]) * 1e6) if len(sys.argv) > 1 else 8_000_000
    envs = int(sys.argv[2]) if len(sys.argv) > 2 else 300
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerweave-stress")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", sys.argv[3] if len(sys.argv) > 3 else "4g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-stress-"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", f"file://{events}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}

    def timed(name: str, make) -> None:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        made = make()
        for table in made if isinstance(made, list) else [made]:
            table.write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - start
        print(f"{name:20} {seconds[name]:7.1f} s", flush=True)
        spark.sparkContext.setJobGroup("", "")

    raw = materialise(delivered(spark, rows, envs))
    timed("conform", lambda: conform(raw, GL))
    ledger = materialise(conform(raw, GL, check=False))
    timed("scan", lambda: ledger)
    timed("presence_cells", lambda: ops.presence_cells(ledger, GL))
    cells = materialise(ops.presence_cells(ledger, GL))
    names = ops.environments(cells)
    timed("presence_binary", lambda: ops.presence_binary(cells, names))
    timed("presence_enriched", lambda: ops.presence_enriched(cells, GL, names))
    timed("number_mismatches", lambda: ops.number_mismatches(ledger, GL))
    timed("type_mismatches", lambda: ops.type_mismatches(ledger, GL))
    timed("gap_actions", lambda: ops.gap_actions(ledger, GL, cells=cells))

    spec = MergeSpec.from_dict(
        {
            "sources": [{"datalib": "LIB1", "company": c} for c in range(envs // LIBRARIES)],
            "target": {"datalib": "LIB2", "company": 0},
            "numbering_strategy": "pick_majority",
        }
    )
    timed("number_folds", lambda: ops.number_folds(ledger, GL, spec))
    folds = materialise(ops.number_folds(ledger, GL, spec))
    unified = materialise(ops.unify(folds, GL, spec))
    timed("merge_conflicts", lambda: ops.merge_conflicts(ledger, folds, unified, GL, spec))
    timed("merge_actions", lambda: ops.merge_actions(ledger, unified, GL, spec))
    timed("merge_mappings", lambda: ops.merge_mappings(ledger, unified, GL, spec))

    def whole_run() -> list[DataFrame]:
        found = run_component(ledger, GL, wide=False)
        return [found.create, found.review, found.action_counts, found.number_mismatches, found.type_mismatches]

    timed("whole run", whole_run)
    timed("whole merge", lambda: list(component_merge(ledger, GL, spec).values()))
    spark.stop()
    moved = shuffled(events)
    for name, taken in seconds.items():
        print(f"{name:20} {taken:7.1f} s {moved.get(name, 0):9.1f} MB shuffled", flush=True)


if __name__ == "__main__":
    main()
