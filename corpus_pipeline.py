"""The training-data queries: the ten operators, and a pipeline of five of them.

Each stage takes the documents its predecessor kept and returns documents again; the
last adds their tokens. Documents keep their columns (doc_id, text, lang, source,
n_chars) and any others, whatever they are called: the stages hand an operator the text
and, in one struct, all other columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm import bpe, decontam, langid, parity, queries, suffix
from ledgerweave.llm.common import materialise, table

LEAST_SCORE = 0.25  # of a document that is in some known language


def _others(docs: DataFrame) -> Column:
    """All columns but the text, as one."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != "text")).alias("own")


def _apart(docs: DataFrame, **made: Column) -> list[Column]:
    """The columns of ``docs`` from a text and ``own``, some of them made anew."""
    return [
        (made.get(c.lower(), F.col("text") if c.lower() == "text" else F.col(f"own.`{c}`"))).alias(c)
        for c in docs.columns
    ]


def _identity() -> Column:
    """What tells documents apart: texts under one doc_id, or under none, are documents of their own."""
    return F.xxhash64("doc_id", "text")


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in none of the languages go; a missing ``lang`` is filled in."""
    told = langid.predict(docs.select("text", _others(docs)), langid.train(docs), into="told", score="score")
    kept = told.filter((F.col("told") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*_apart(docs, lang=F.coalesce("own.lang", "told")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of near duplicates the document with the least doc_id stays.

    Documents without shingles are no group. What groups a row is its text: texts that share a
    doc_id, or have none, stand for themselves. A null doc_id comes after all others, equal ids
    go by a hash of the text, and of rows equal in both the one with the least other columns
    stays.
    """
    keyed = docs.select(_identity().alias("row"), "doc_id", "text", _others(docs))
    near = parity.near_duplicates(keyed.select("row", "text"), "row").filter("n_shingles > 0")
    groups = near.groupBy(F.col("doc_id").alias("row")).agg(
        F.first("component_id").alias("component"), F.count("*").alias("n")
    )
    ids = keyed.select("row", "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    rows = materialise(groups.join(ids, "row").select("row", "component", "n", order.alias("place")))
    least = rows.groupBy("component").agg(F.min("place").alias("least"))
    gone = rows.join(least, "component").filter("row != least.row").select("row")
    kept = keyed.join(gone, "row", "left_anti")
    again = rows.filter("n > 1").select("row")
    if again.isEmpty():
        return kept.select(*_apart(docs))
    once = kept.join(again, "row", "left_semi").groupBy("row")
    once = once.agg(F.min_by(F.struct("text", "own"), F.to_json("own")).alias("one")).select("one.*")
    alone = kept.join(again, "row", "left_anti").select("text", "own")
    return alone.unionByName(once).select(*_apart(docs))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated passages go, and documents of which nothing is left.

    Bytes of characters that a cut left incomplete go as well.
    """
    cut = suffix.remove_repeats(docs.select("doc_id", "text", _others(docs)), characters=True)
    touched = F.size("spans") > 0
    text = F.when(touched, F.col("kept").cast("string")).otherwise(F.col("text"))
    left = cut.select("own", text.alias("text"), touched.alias("touched"))
    left = left.filter(~F.col("touched") | (F.length("text") > 0))
    return left.select(*_apart(docs, n_chars=F.length("text").cast("long")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a passage of a benchmark item go."""
    keyed = docs.select(_identity().alias("row"), "text", _others(docs))
    asked = keyed.select(F.col("row").alias("doc_id"), "text")
    leaks = decontam.find_leaks(asked, table(spark, sf_dir, "benchmark"))
    gone = leaks.select(F.col("doc_id").alias("row")).distinct()
    return keyed.join(gone, "row", "left_anti").select(*_apart(docs))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: the documents with their token ids, and whether these decode to the text again.

    Columns of documents with the names of these are replaced.
    """
    path = public_tokenizers.path(queries.VOCABULARY)
    read = bpe.decode(bpe.encode(docs.select("text", _others(docs)), path), path, into="again")
    made = ("ids", "n_tokens", "round_trip")
    kept = [c for c in docs.columns if c.lower() not in made]
    return read.select(
        *_apart(docs.select(*(F.col(f"`{c}`") for c in kept))),
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("again") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language_id", in_a_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeats),
    ("benchmark_passages", without_benchmark),
    ("tokens", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# No stage but the last can be said in SQL; tests/llm checks the rows by brute force.
ORACLE_SQL = None
QUERIES = queries.QUERIES | {"pipeline": run}
ORACLES = dict(queries.ORACLES)
