"""Ledgers derived from the test tables, which hold none themselves.

Suppliers' nations act as companies and parts as accounts; customers act as cost
centers. Line items are reduced before they meet the wide ``part`` rows, orders
before they meet customers, and only ``nation`` and ``region``, whose sizes are
fixed, are broadcast.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.component import CC, GL, Component
from ledgerweave.operators import FilterRules, MergeSpec, keep_reject
from ledgerweave.sources import conform

RULES = FilterRules(lastused_days=1000, as_of=datetime(2001, 11, 5))
# Headers as some source system may write them, and what they stand for.
GL_HEADERS = {
    "FIRM": "COMPANY",
    "LEDGER_NO": "ACCOUNT",
    "CAPTION": "DESCRIPTION",
    "FULL_CAPTION": "DESCRIPTION_LANG",
    "LAST_BOOKED": "LASTUSED_DATE",
}
CC_HEADERS = {
    "FIRM": "COMPANY",
    "CENTRE_NO": "COSTCENTER",
    "CAPTION": "DESCRIPTION",
    "FULL_CAPTION": "DESCRIPTION_LANG",
    "LAST_BOOKED": "LASTUSED_DATE",
}


def merge_spec(strategy: str = "pick_majority") -> MergeSpec:
    """Three European environments into a fourth."""
    return MergeSpec.from_dict(
        {
            "sources": [{"datalib": "EUROPE", "company": c} for c in (3, 8, 13)],
            "target": {"datalib": "EUROPE", "company": 18},
            "numbering_strategy": strategy,
            "preferred_env": "EUROPE-3",
        }
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation_key, DATALIB, COMPANY``; 25 rows at any scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(
        F.broadcast(region), nation.n_regionkey == region.r_regionkey
    ).select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("r_name").alias("DATALIB"),
        F.col("n_nationkey").cast("string").alias("COMPANY"),
    )


def _position(key: Column) -> Column:
    return (key.cast("bigint") * 32 + F.col("nation_key")).alias("_ord")


def gl_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per nation and part that the nation's suppliers delivered."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation_key")
    )
    used = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, "l_suppkey")
        .groupBy("l_partkey", "nation_key")
        .agg(
            F.max("l_shipdate").alias("last"),
            F.count_if(F.col("l_returnflag") == "R").alias("returns"),
        )
    )
    part = table(spark, sf_dir, "part")
    size, name = F.col("p_size"), F.col("p_name")
    return (
        used.join(part, used.l_partkey == part.p_partkey)
        .join(F.broadcast(_countries(spark, sf_dir)), "nation_key")
        .select(
            "DATALIB",
            "COMPANY",
            (1000 + F.col("p_partkey") % 500).cast("string").alias("ACCOUNT"),
            F.concat(
                F.when(F.col("nation_key") % 2 == 0, F.upper(name)).otherwise(name),
                F.lit("  "),
                "p_brand",
            ).alias("DESCRIPTION"),
            F.col("p_type").alias("TYPE"),
            F.when(F.col("p_partkey") % 7 != 0, F.concat(name, F.lit(" "), "p_type")).alias(
                "DESCRIPTION_LANG"
            ),
            F.when(F.col("returns") > 1, "J").otherwise("N").alias("DOORTREK_JN"),
            F.when(size == 50, "J").when(size != 49, "N").alias("VERDREK_JN"),
            F.col("last").alias("LASTUSED_DATE"),
            _position(F.col("p_partkey")),
        )
    )


def cc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cost center per customer, in the customer's nation."""
    ordered = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderpriority").alias("lang"), F.max("o_orderdate").alias("last"))
    )
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return (
        table(spark, sf_dir, "customer")
        .join(ordered, "c_custkey", "left")
        .withColumnRenamed("c_nationkey", "nation_key")
        .join(F.broadcast(_countries(spark, sf_dir)), "nation_key")
        .select(
            "DATALIB",
            "COMPANY",
            F.when(key % 40 != 0, (100 + key % 400).cast("string")).alias("COSTCENTER"),
            F.concat(
                F.when(F.col("nation_key") % 2 == 0, F.lower(segment)).otherwise(segment),
                F.lit(" - "),
                F.floor(F.col("c_acctbal") / 100).cast("string"),
            ).alias("DESCRIPTION"),
            F.col("lang").alias("DESCRIPTION_LANG"),
            F.col("last").alias("LASTUSED_DATE"),
            _position(key),
        )
    )


def raw(spark: SparkSession, sf_dir: str, comp: Component) -> DataFrame:
    return (gl_raw if comp is GL else cc_raw)(spark, sf_dir)


def ledger(spark: SparkSession, sf_dir: str, comp: Component) -> DataFrame:
    """The conformed ledger."""
    return conform(raw(spark, sf_dir, comp), comp, check=False)


def cleaned(spark: SparkSession, sf_dir: str, comp: Component) -> DataFrame:
    """The ledger rows the standard rules keep."""
    return keep_reject(ledger(spark, sf_dir, comp), comp, RULES).cleaned


def as_delivered(spark: SparkSession, sf_dir: str, comp: Component) -> DataFrame:
    """The raw ledger the way a source system exports it.

    Padded headers of its own, numbers read as floats, white space of every kind in the
    texts, and the date as eight digits.
    """
    headers = {new: old for old, new in (GL_HEADERS if comp is GL else CC_HEADERS).items()}
    nbsp = "\u00a0"
    source = raw(spark, sf_dir, comp).withColumns(
        {
            comp.number: F.col(comp.number).cast("double"),
            "DATALIB": F.concat(F.lit(" "), "DATALIB", F.lit(nbsp)),
            "COMPANY": F.concat("COMPANY", F.lit("\t")),
            "DESCRIPTION": F.regexp_replace("DESCRIPTION", " ", f" {nbsp}\n"),
            "LASTUSED_DATE": F.date_format("LASTUSED_DATE", "yyyyMMdd"),
        }
    )
    return source.select(
        *(F.col(n).alias(f" {headers.get(n, n).lower()} ") for n in source.columns if n != "_ord"),
        "_ord",
    )


def damaged(spark: SparkSession, sf_dir: str, comp: Component) -> DataFrame:
    """The raw ledger with null, blank and out-of-domain values strewn in."""
    spot = F.col("_ord")
    source = raw(spark, sf_dir, comp)
    broken = {
        "DATALIB": F.when(spot % 13 == 1, "  ").when(spot % 13 != 0, F.col("DATALIB")),
        "COMPANY": F.when(spot % 11 != 0, F.col("COMPANY")),
        "DESCRIPTION": F.when(spot % 7 == 1, "")
        .when(spot % 7 == 2, "\u00a0\t")
        .when(spot % 7 != 0, F.col("DESCRIPTION")),
    }
    for flag in comp.flags:
        broken[flag] = (
            F.when(spot % 5 == 0, " J")
            .when(spot % 5 == 1, "j")
            .when(spot % 5 == 2, "yes")
            .otherwise(F.col(flag))
        )
    return source.withColumns(broken)


def number_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order key in one of a dozen spellings: ``o_orderkey, raw``."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    forms = [
        text,
        F.concat(F.lit("0"), text),
        F.concat(text, F.lit(".0")),
        F.concat(F.lit("  "), text, F.lit(" ")),
        F.concat(text, F.lit("e2")),
        F.concat(text, F.lit("_000")),
        F.concat(text, F.lit("D")),
        F.concat(F.lit("ABC"), text, F.lit(".0")),
        F.lit("inf"),
        F.lit(None).cast("string"),
        F.concat(text, F.lit(".25")),
        F.concat(F.lit("-"), text, F.lit(".")),
    ]
    return table(spark, sf_dir, "orders").select(key, _pick(key, forms).alias("raw"))


def date_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order date in one of eleven spellings: ``o_orderkey, raw``."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    eight = F.date_format(day, "yyyyMMdd")
    forms = [
        eight,
        F.substring(eight, 3, 6),
        F.datediff(day, F.lit("1899-12-30")).cast("string"),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss"),
        F.lit("NaT"),
        F.lit(None).cast("string"),
        F.lit("  "),
        F.lit("99991231"),
        F.concat(eight, F.lit(".0")),
        F.lit("unknown"),
    ]
    return table(spark, sf_dir, "orders").select(key, _pick(key, forms).alias("raw"))


def _pick(key: Column, forms: list[Column]) -> Column:
    choice = F.when(key % len(forms) == 0, forms[0])
    for i, form in enumerate(forms[1:], 1):
        choice = choice.when(key % len(forms) == i, form)
    return choice


__all__ = [
    "CC",
    "CC_HEADERS",
    "GL",
    "GL_HEADERS",
    "RULES",
    "as_delivered",
    "cleaned",
    "damaged",
    "date_spellings",
    "ledger",
    "merge_spec",
    "number_spellings",
    "raw",
    "table",
]
