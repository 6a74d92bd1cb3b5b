import random
import subprocess
import sys

from pyspark.sql import functions as F

from ledgerweave.operators.texts import ordered_texts


def test_parts_and_whole_give_the_same_text(spark):
    rng = random.Random(2)
    entries = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}", rng.randrange(50), f"t{i}") for i in range(900)]
    entries += [("none", 1, None), ("k0", 3, None)]
    frame = spark.createDataFrame(entries, "key string, at_ long, text string").repartition(5)
    want = {}
    for key, _, text in sorted(entries, key=lambda e: (e[1], e[2] or "")):
        want.setdefault(key, []).append(text)
    for bounded in (False, True):
        found = ordered_texts(
            frame, ["key"], ["at_", "text"], "text", "; ", {"least": F.col("at_")}, {"most": F.col("at_")}, bounded
        )
        assert found.columns == ["key", "text", "least", "most"]
        rows = {r.key: r for r in found.collect()}
        assert {k: r.text for k, r in rows.items()} == {k: "; ".join(t for t in v if t) for k, v in want.items()}
        for key, r in rows.items():
            places = [e[1] for e in entries if e[0] == key]
            assert (r.least, r.most) == (min(places), max(places))
    assert ordered_texts(frame.limit(0), ["key"], ["at_"], "text", ", ").count() == 0


HOT = """
from pyspark.sql import SparkSession, functions as F
from ledgerweave.component import GL
from ledgerweave.operators import number_mismatches
spark = (SparkSession.builder.master("local[4]").config("spark.driver.memory", "1g")
    .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "16")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
n = 2_000_000
rows = spark.range(0, n, 1, 16).select(
    F.lit("hot").alias("DESC_KEY"), F.lit("Hot").alias("DESCRIPTION"), F.concat(F.lit("L-"), F.col("id") % 50).alias("ENV"),
    (10_000_000 + F.pmod(F.col("id") * 7919, F.lit(n))).cast("string").alias("ACCOUNT"), F.col("id").alias("_ord"))
(found,) = number_mismatches(rows, GL).select(F.sha2("Details", 256).alias("d"), F.length("Details").alias("n")).collect()
import hashlib
want = ", ".join(f"{10_000_000 + i * 7919 % n} (L-{i % 50})" for i in range(n))
assert (found.n, found.d) == (len(want), hashlib.sha256(want.encode()).hexdigest())
print("equal")
"""


def test_two_million_values_of_one_description_in_a_small_heap(tmp_path):
    """In a process of its own, whose heap has 1 GB."""
    ran = subprocess.run([sys.executable, "-c", HOT], capture_output=True, text=True, timeout=600)
    assert ran.stdout.strip().endswith("equal"), ran.stderr[-2000:]
