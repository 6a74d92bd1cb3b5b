"""Document quality by hierarchical empirical Bayes.

A classifier gives each document evidence: the weights of its telling features (words,
their starts, what clings to them, shares of capitals, symbols and repetition). These
are chosen by grouped counts over two thirds of the labelled documents, weighed by a
logistic regression on a sample of at most about ``SAMPLE`` of them, and scaled to log
likelihood ratios by a line fitted on the remaining third. A site then contributes what its other
documents look like. Expected positives and documents are counted per host and per path; a path
leans on its host and a host on all documents, as strongly as the spread between groups
says: the method of moments gives how many documents a prior counts for. A document's
posterior odds are its site's odds without itself times its own evidence.

Only the features that tell most (``FEATURES`` per target, by their z value), which of
them the sample has, and some numbers per bin of evidence reach the driver. Counts run over all labelled documents,
rates over all documents, each combined ahead of its shuffle.

Nulls: a null text has the feature of an empty one, a null host or path is a site of its own,
documents without label only count by their expectation, labels of unknown documents
and null labels are ignored. Of several labels of one document the largest counts.
Repeated rows count each. Without labels every probability is one half.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import add_columns, column, map_batches, materialise

FEATURES = 400  # of a target at most
SAMPLE = 20_000  # labelled documents that weights are fitted on
RIDGE = 1.0  # penalty of the regression
NEWTON_STEPS = 12
LEAST_Z = 5.0  # of a feature
LEAST_DOCUMENTS = 8  # that have a feature
BIN = 2.0  # bins of evidence per unit
MOST_PRIOR = 1000.0  # documents that a prior counts for at most
STEMS = (5, 7)  # letters of a word's start that are a feature as well
SYMBOLS = "#*$%&|<>"
EDGES = ".,;:!?\"'()[]{}#*$%&|<>-_=+~^/\\`@"


class Evidence(NamedTuple):
    """A fitted classifier of one target."""

    weights: dict[str, float]
    slope: float
    shift: float


def features(text: str) -> set[str]:
    """What a text has: words in lower case, their starts, what clings to them, and shares in tenths."""
    words = text.split()
    if not words:
        return {"#empty"}
    distinct = set(words)
    found = set()
    for word in distinct:
        core = word.strip(EDGES)
        lower = core.lower()
        found.add(lower)
        found.update(lower[:n] for n in STEMS if len(core) > n)
        if core != word:
            found.add("#edge:" + word.rpartition(core)[2] if core else "#mark:" + word[:4])
    found.discard("")
    capitals = sum(map(str.isupper, words)) / len(words)
    symbols = sum(map(text.count, SYMBOLS)) / len(text)
    found.add(f"#capitals:{int(10 * capitals)}")
    found.add(f"#symbols:{min(9, int(50 * symbols))}")
    found.add(f"#distinct:{int(10 * len(distinct) / len(words))}:{len(words).bit_length()}")
    return found


def _counts(labelled: DataFrame, targets: tuple[str, ...]) -> DataFrame:
    """(feature, and per target the positives and negatives that have it)."""
    names = [f"{t}_{v}" for t in targets for v in (1, 0)]

    def start() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            sums = {name: Counter() for name in names}
            labels = [column(batch, t).to_pylist() for t in targets]
            for text, *values in zip(column(batch, "text").to_pylist(), *labels):
                own = [*features(text or ""), "#all"]
                for target, value in zip(targets, values):
                    if value is not None:
                        sums[f"{target}_{int(value > 0)}"].update(own)
            every = list(set().union(*sums.values()))
            return {"feature": pa.array(every, pa.string())} | {
                name: pa.array([sums[name][f] for f in every], pa.int64()) for name in names
            }

        return work

    schema = "feature string, " + ", ".join(f"{name} long" for name in names)
    return (
        map_batches(labelled.select("text", *targets), schema, start)
        .groupBy("feature")
        .agg(*(F.sum(name).alias(name) for name in names))
    )


def _telling(counts: DataFrame, targets: tuple[str, ...]) -> dict[str, list[str]]:
    """Each target's most telling features."""
    totals = counts.filter(F.col("feature") == "#all").first()
    found: dict[str, list[str]] = {}
    for target in targets:
        found[target] = []
        if totals is None or not totals[f"{target}_1"] or not totals[f"{target}_0"]:
            continue
        yes, no = F.col(f"{target}_1"), F.col(f"{target}_0")
        all_yes, all_no = float(totals[f"{target}_1"]), float(totals[f"{target}_0"])
        both, n = yes + no, all_yes + all_no
        # Two shares compared under the share of both together.
        spread = F.sqrt(both * (n - both) * (all_yes * all_no / n**3))
        z = F.abs(yes - both * (all_yes / n)) / spread
        rows = (
            counts.filter((F.col("feature") != "#all") & (both >= LEAST_DOCUMENTS) & (both < n))
            .select("feature", z.alias("z"))
            .filter(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "feature")
            .limit(FEATURES)
        )
        found[target] = [r["feature"] for r in rows.collect()]
    return found


def _sampled(labelled: DataFrame, names: list[str], targets: tuple[str, ...]) -> list:
    """(hits, labels) of about ``SAMPLE`` documents; hits are places in ``names``."""
    n = labelled.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE / max(n, 1)))

    def start() -> Callable:
        places = {name: i for i, name in enumerate(names)}

        def work(batch: pa.RecordBatch) -> dict:
            hits = [
                sorted(places[f] for f in features(t or "") if f in places) for t in column(batch, "text").to_pylist()
            ]
            return {"hits": pa.array(hits, pa.list_(pa.int32()))} | {t: column(batch, t) for t in targets}

        return work

    rows = labelled.filter(share).select("text", *(F.col(t).cast("int").alias(t) for t in targets))
    return map_batches(rows, "hits array<int>, " + ", ".join(f"{t} int" for t in targets), start).collect()


def _weights(names: list[str], hits: list[list[int]], labels: list[bool]) -> dict[str, float]:
    """The features' weights by logistic regression with a ridge, fitted by Newton's steps."""
    if not names or not any(labels) or all(labels):
        return {}
    x = np.zeros((len(labels), len(names) + 1))
    x[:, -1] = 1
    for row, own in enumerate(hits):
        x[row, own] = 1
    y = np.array(labels, float)
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-6
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        w += np.clip(np.linalg.solve(bend, slope), -3, 3)
    return dict(zip(names, w[:-1].tolist()))


def _with_sums(df: DataFrame, weights: dict[str, dict[str, float]], text: str) -> DataFrame:
    """``df`` with the summed weights of each target as ``_sum_<target>``."""
    made = StructType()
    for target in weights:
        made = made.add(f"_sum_{target}", DoubleType())

    def start() -> Callable:
        known = set().union(*weights.values())

        def work(batch: pa.RecordBatch) -> dict:
            own = [features(t or "") & known for t in column(batch, text).to_pylist()]
            return {
                f"_sum_{target}": pa.array(
                    [math.fsum(w[f] for f in found if f in w) for found in own], pa.float64()
                )
                for target, w in weights.items()
            }

        return work

    return add_columns(df, made, start)


def fit(labelled: DataFrame, targets: tuple[str, ...] = ("quality",)) -> dict[str, Evidence]:
    """Classifiers from ``labelled`` (doc_id, text, the targets); null labels are skipped."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    split = labelled.select("doc_id", "text", *targets).withColumn("_scale", fold == 1)
    known = split.filter(~F.col("_scale"))
    telling = _telling(materialise(_counts(known, targets)), targets)
    names = sorted(set().union(*telling.values()))
    sample = _sampled(known, names, targets) if names else []
    weights = {}
    for target, own in telling.items():
        place = {names.index(name): i for i, name in enumerate(own)}
        rows = [r for r in sample if r[target] is not None]
        hits = [[place[h] for h in r["hits"] if h in place] for r in rows]
        weights[target] = _weights(own, hits, [r[target] > 0 for r in rows])
    sums = _with_sums(split.filter("_scale"), weights, "text").drop("text")
    return {t: Evidence(weights[t], *_line(sums, t)) for t in targets}


def _line(sums: DataFrame, target: str) -> tuple[float, float]:
    """Slope and shift from summed weights to log odds, by weighted least squares over bins."""
    bins = (
        sums.filter(F.col(target).isNotNull())
        .withColumn("bin", F.round(F.greatest(F.least(F.col(f"_sum_{target}"), F.lit(60.0)), F.lit(-60.0)) * BIN))
        .groupBy("bin")
        .agg(F.sum((F.col(target) > 0).cast("long")).alias("yes"), F.count("*").alias("n"))
        .collect()
    )
    yes, n = sum(b["yes"] for b in bins), sum(b["n"] for b in bins)
    if not 0 < yes < n:
        return 0.0, 0.0
    base = math.log(yes / (n - yes))
    points = []
    for b in bins:
        p = (b["yes"] + 0.5) / (b["n"] + 1)
        points.append((b["n"] * p * (1 - p), b["bin"] / BIN, math.log(p / (1 - p)) - base))
    total = sum(w for w, _, _ in points)
    x = sum(w * a for w, a, _ in points) / total
    y = sum(w * c for w, _, c in points) / total
    across = sum(w * (a - x) ** 2 for w, a, _ in points)
    slope = max(0.0, sum(w * (a - x) * (c - y) for w, a, c in points) / across) if across else 0.0
    return slope, y - slope * x


def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _inside(p: Column) -> Column:
    return F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))


def evidence(df: DataFrame, models: dict[str, Evidence], text: str = "text") -> DataFrame:
    """``df`` with ``evidence_<target>``: the log likelihood ratio of each text."""
    summed = _with_sums(df, {t: m.weights for t, m in models.items()}, text)
    made = {f"evidence_{t}": m.slope * F.col(f"_sum_{t}") + m.shift for t, m in models.items()}
    return summed.withColumns(made).drop(*(f"_sum_{t}" for t in models))


def _strength(groups: DataFrame, rate: Column) -> float:
    """How many documents the prior counts for: the method of moments over groups
    (positives, documents) around the ``rate`` above them."""
    mean = F.col("positives") / F.col("documents")
    weight = F.col("documents")
    found = groups.filter("documents > 1").agg(
        F.sum(weight).alias("n"),
        F.sum(weight * (mean - rate) ** 2).alias("between"),
        F.sum(rate * (1 - rate)).alias("noise"),
        F.sum(weight * rate * (1 - rate)).alias("whole"),
    ).first()
    if not found["n"] or not found["whole"]:
        return MOST_PRIOR
    # Excess of the spread between groups over what chance gives, as a share of p (1 - p).
    share = (found["between"] - found["noise"]) / found["whole"]
    return min(MOST_PRIOR, max(1.0, 1 / share - 1)) if share > 0 else MOST_PRIOR


def posteriors(df: DataFrame, target: str, prior: float) -> DataFrame:
    """``df`` (host, path, evidence_<target>, label_<target>) with ``<target>``: the
    posterior probability of each document.

    ``prior`` is the rate of positives among labelled documents.
    """
    base = math.log(prior / (1 - prior))
    own = F.coalesce(
        F.col(f"label_{target}").cast("double"), 1 / (1 + F.exp(-(F.col(f"evidence_{target}") + base)))
    )
    placed = df.withColumn("_own", own)
    sums = (F.sum("_own").alias("positives"), F.count("*").cast("double").alias("documents"))
    paths = placed.groupBy("host", "path").agg(*sums)
    hosts = paths.groupBy("host").agg(
        F.sum("positives").alias("positives"), F.sum("documents").alias("documents")
    )
    everything = hosts.agg(F.sum("positives"), F.sum("documents")).first()
    rate = min(1 - 1e-4, max(1e-4, everything[0] / everything[1])) if everything[1] else prior
    host_strength = _strength(hosts, F.lit(rate))
    with_hosts = paths.withColumnRenamed("positives", "_positives").withColumnRenamed("documents", "_documents").join(
        hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))
    )
    leaning = with_hosts.select(
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        F.col("_positives"),
        F.col("_documents"),
        F.col("positives").alias("_host_positives"),
        F.col("documents").alias("_host_documents"),
    )
    host_rate = (F.col("_host_positives") + host_strength * rate) / (F.col("_host_documents") + host_strength)
    path_strength = _strength(
        leaning.withColumns({"positives": F.col("_positives"), "documents": F.col("_documents")}),
        _inside(host_rate),
    )
    told = placed.join(
        leaning, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left"
    )
    # Its site without the document itself.
    host_rest = (F.col("_host_positives") - F.col("_own") + host_strength * rate) / (
        F.col("_host_documents") - 1 + host_strength
    )
    path_rest = (F.col("_positives") - F.col("_own") + path_strength * host_rest) / (
        F.col("_documents") - 1 + path_strength
    )
    odds = _logit(_inside(path_rest)) + F.col(f"evidence_{target}")
    return told.withColumn(target, 1 / (1 + F.exp(-odds))).drop(
        "_own", "_host", "_path", "_positives", "_documents", "_host_positives", "_host_documents"
    )


def rate_of(labelled: DataFrame, target: str) -> float:
    """The rate of positives among labels, kept away from 0 and 1."""
    yes, n = labelled.select(
        F.sum((F.col(target) > 0).cast("long")), F.count(target)
    ).first()
    return ((yes or 0) + 0.5) / (n + 1)
