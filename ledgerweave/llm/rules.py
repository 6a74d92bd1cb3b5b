"""Quality rules and robust multivariate outliers, in DataFrame functions only.

The base rules count words, symbols, repeated lines and repeated five-word windows.
Documents that pass them are judged by the minimum-covariance-determinant estimate of
their language and source: the mean and covariance of those three quarters of a group's
rows whose covariance has the least determinant. Concentration steps lead there from
three starts, until no determinant changes by more than ``SETTLED``; every group keeps
the estimate of the start that got it the least. A document goes if its Mahalanobis
distance exceeds ``CUTOFF``.

A concentration step is one pass: rows are put into bins of their distance, each bin
is summed (count, sums, products) ahead of the shuffle, and a group takes its nearest
bins until ``SHARE`` of its rows are in. So a hot group costs no more than its bins.
Sparse groups lean on their language: its estimate counts as ``PRIOR_ROWS`` rows.

Nulls: a null text has no words and fails the base rules; null languages and sources
form groups of their own. Repeated rows count each. An empty table gives no rows.
Five-word windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WHITE = "\t\n\x0b\x0c\r"  # beside the space, what parts words
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
SHARE = 0.75  # of a group's rows that its estimate rests on
SETTLED = 0.05  # change of a determinant's logarithm that ends the steps; bins resolve no less
MOST_STEPS = 12  # a bound, not reached so far
SPREAD = 1.349  # quartile distance of a normal distribution, in standard deviations
PRIOR_ROWS = 50.0
SMOOTH = 40.0  # words that a document is padded with, so that short ones vary less
CUTOFF = 40.0  # squared distance; far out in the tail of chi-square with DIMS degrees
CONSISTENCY = 1.41  # scales the covariance of the nearest 75 % to that of all, for DIMS
# Least standard deviations: most documents have no symbol, no repeated line or window at
# all, so the nearest rows often do not vary; one repeated line must not make an outlier.
FLOORS = {"length": 0.03, "symbols": 0.03, "lines": 0.2, "repeats": 0.2, "capitals": 0.03}
BINS = 8.0  # per power of e of the squared distance
STATS = tuple(FLOORS)
DIMS = len(STATS)
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _removed(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts of each text instead of the text itself."""
    others = [c for c in df.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    counted = df.select(
        *others,
        F.array_remove(F.split(F.translate(body, WHITE, " " * len(WHITE)), " "), "").alias("_words"),
        F.filter(
            F.split(body, "\n"), lambda line: F.length(F.translate(line, " " + WHITE, "")) > 0
        ).alias("_lines"),
        _removed(body, SYMBOLS).cast("long").alias("n_symbols"),
        _removed(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ!").cast("long").alias("n_capitals"),
    )
    hashed = counted.select(
        *others,
        "n_symbols",
        "n_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_codes"),
    )

    def window(code: Column, i: Column) -> Column:
        rest = [F.get("_codes", i + k) for k in range(1, WINDOW)]
        return F.xxhash64(code, *rest)

    starts = F.slice("_codes", 1, F.greatest(F.size("_codes") - (WINDOW - 1), F.lit(0)))
    windows = hashed.withColumn("_windows", F.transform(starts, window)).drop("_codes")
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windows.withColumn("_sorted", F.when(repeated, placed)).drop("_windows")

    def twice(x: Column, i: Column) -> Column:
        # i - 1 is -1 for the first, which get() answers with null
        return (F.coalesce(F.get("_sorted", i - 1)["h"] == x["h"], F.lit(False))) | (
            F.coalesce(F.get("_sorted", i + 1)["h"] == x["h"], F.lit(False))
        )

    starts_twice = F.sort_array(F.transform(F.filter("_sorted", twice), lambda x: x["i"]))
    found = ordered.withColumn("_starts", starts_twice).drop("_sorted")
    covered = F.transform(
        "_starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - p, F.lit(WINDOW)))
    )
    return found.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(covered, F.lit(0), lambda total, x: total + x), F.lit(0)).cast("long"),
    ).drop("_starts")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def _vector() -> dict[str, Column]:
    """The transformed statistics: logarithm of the word length, roots of the shares."""
    words = F.col("n_words") + SMOOTH
    characters = F.col("word_chars") + 5 * SMOOTH
    return {
        "length": F.ln(characters / words),
        "symbols": F.sqrt(F.col("n_symbols") / characters),
        "lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 10.0)),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
        "capitals": F.sqrt(F.col("n_capitals") / characters),
    }


def _estimates(sums: DataFrame) -> DataFrame:
    """Mean and Cholesky factor per group from its sums, leaning on the language's."""
    by_lang = Window.partitionBy("lang", "start")
    names = ["n", *(f"s{i}" for i in range(DIMS)), *(f"p{i}{j}" for i, j in PAIRS)]
    weight = PRIOR_ROWS / F.sum("n").over(by_lang)
    leaning = sums.select(
        "lang", "source", "start", *((F.col(c) + weight * F.sum(c).over(by_lang)).alias(c) for c in names)
    )
    means = leaning.select(
        "lang",
        "source",
        "start",
        *((F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIMS)),
        *((F.col(f"p{i}{j}") / F.col("n")).alias(f"p{i}{j}") for i, j in PAIRS),
    )
    spread = means.withColumns(
        {
            f"c{i}{j}": CONSISTENCY * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
            + (FLOORS[STATS[i]] ** 2 if i == j else 0.0)
            for i, j in PAIRS
        }
    )
    # One column of the factor after the other; each needs those before it.
    for j in range(DIMS):
        done = [F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        pivot = reduce(lambda a, b: a - b, done, F.col(f"c{j}{j}"))
        spread = spread.withColumn(f"l{j}{j}", F.sqrt(F.greatest(pivot, F.lit(FLOORS[STATS[j]] ** 2 / 4))))
        spread = spread.withColumns(
            {
                f"l{i}{j}": reduce(
                    lambda a, b: a - b,
                    [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)],
                    F.col(f"c{i}{j}"),
                )
                / F.col(f"l{j}{j}")
                for i in range(j + 1, DIMS)
            }
        )
    return spread.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        "start",
        *(f"m{i}" for i in range(DIMS)),
        *(f"l{i}{j}" for i, j in PAIRS),
    )


def _log_determinant() -> Column:
    """Of the covariance with that Cholesky factor."""
    return 2 * reduce(lambda a, b: a + b, (F.ln(f"l{i}{i}") for i in range(DIMS)))


def _with_distance(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """``vectors`` with the squared Mahalanobis distance to their group's estimate: one row
    for each ``start`` that has one."""
    kept = vectors.columns
    here = vectors.join(
        estimates,
        vectors["lang"].eqNullSafe(estimates["_lang"]) & vectors["source"].eqNullSafe(estimates["_source"]),
        "left",
    )
    for i, name in enumerate(STATS):
        done = [F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)]
        rest = reduce(lambda a, b: a - b, done, F.col(name) - F.col(f"m{i}"))
        here = here.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    square = reduce(lambda a, b: a + b, (F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIMS)))
    return here.select(*kept, "start", square.alias("distance"))


def _sums() -> list[Column]:
    """Number of rows, sums and products of the statistics."""
    sums = {f"s{i}": F.sum(F.col(name)) for i, name in enumerate(STATS)}
    sums |= {f"p{i}{j}": F.sum(F.col(STATS[i]) * F.col(STATS[j])) for i, j in PAIRS}
    return [F.count("*").cast("double").alias("n"), *(c.alias(name) for name, c in sums.items())]


def _nearest_sums(placed: DataFrame) -> DataFrame:
    """Per group and start the sums over the bins that hold the nearest ``SHARE`` of rows."""
    names = [f"s{i}" for i in range(DIMS)] + [f"p{i}{j}" for i, j in PAIRS]
    bins = (
        placed.withColumn("bin", F.floor(F.ln(F.col("distance") + 1e-6) * BINS))
        .groupBy("lang", "source", "start", "bin")
        .agg(*_sums())
    )
    group = Window.partitionBy("lang", "source", "start")
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return (
        bins.withColumns({"_all": F.sum("n").over(group), "_before": F.coalesce(F.sum("n").over(before), F.lit(0.0))})
        .filter(F.col("_before") < SHARE * F.col("_all"))
        .groupBy("lang", "source", "start")
        .agg(*(F.sum(c).alias(c) for c in ["n", *names]))
    )


def _starts(vectors: DataFrame) -> DataFrame:
    """Three estimates per group: the medians with the floors as scale, the medians with the
    quartile distances as scale, and the mean and covariance of all rows."""
    groups = vectors.groupBy("lang", "source")
    quartiles = groups.agg(
        *(F.percentile_approx(name, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, name in enumerate(STATS))
    )
    scales = {
        "floors": [F.lit(FLOORS[name]) for name in STATS],
        "quartiles": [
            F.greatest(F.lit(FLOORS[name]), (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / SPREAD)
            for i, name in enumerate(STATS)
        ],
    }
    parts = [
        quartiles.select(
            F.col("lang").alias("_lang"),
            F.col("source").alias("_source"),
            F.lit(start).alias("start"),
            *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIMS)),
            *((scale[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in PAIRS),
        )
        for start, scale in scales.items()
    ]
    everything = groups.agg(*_sums()).withColumn("start", F.lit("means"))
    return reduce(DataFrame.unionByName, [*parts, _estimates(everything)])


def _change(before: DataFrame, after: DataFrame) -> float:
    """The largest change of a determinant's logarithm between two sets of estimates."""
    both = [e.select("_lang", "_source", "start", _log_determinant().alias("d")) for e in (before, after)]
    moved = both[0].unionByName(both[1]).groupBy("_lang", "_source", "start")
    found = moved.agg((F.max("d") - F.min("d")).alias("c")).agg(F.max("c")).first()[0]
    return found or 0.0


def least_determinants(vectors: DataFrame) -> DataFrame:
    """The estimate of each group (``_lang``, ``_source``) whose determinant is the least that
    concentration reached from any start; ties go to the first start by name."""
    before = materialise(_starts(vectors))
    for _ in range(MOST_STEPS):
        after = materialise(_estimates(_nearest_sums(_with_distance(vectors, before))))
        settled = _change(before, after) <= SETTLED
        before = after
        if settled:
            break
    rest = [c for c in before.columns if c not in ("_lang", "_source", "start")]
    least = F.min(F.struct(_log_determinant().alias("determinant"), "start", *rest)).alias("best")
    return before.groupBy("_lang", "_source").agg(least).select("_lang", "_source", "best.*")


def robust_distances(vectors: DataFrame) -> DataFrame:
    """``vectors`` (lang, source, the statistics) with their ``distance`` from the estimate of
    their group that has the least determinant."""
    return _with_distance(vectors, materialise(least_determinants(vectors))).drop("start")


def judge(df: DataFrame) -> DataFrame:
    """``df`` (doc_id, text, lang, source) with its counts, ``base_failed``, ``distance``
    and ``kept``; the distance of a document that fails the base rules is null."""
    counts = text_statistics(df.select("doc_id", "text", "lang", "source"))
    judged = materialise(counts.withColumns({"base_failed": base_failed(), **_vector()}))
    passed = robust_distances(judged.filter(~F.col("base_failed")))
    failed = judged.filter("base_failed").withColumn("distance", F.lit(None).cast("double"))
    return passed.unionByName(failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("distance") <= CUTOFF)
    )
