"""Mixing sources to target weights, by blocks, multinomial draws and permuted indexes.

The words of a source's documents, in pseudorandom order, make one long row of words, cut
into blocks of ``BLOCK`` words. The mix is a number of output shards of ``SLOTS`` slots. Each
shard draws how many slots every source gets (multinomial, by the targets); what a source
draws beyond its target is given to those that drew too little. A source's slots are numbered
through all shards, and a keyed permutation of its blocks says which block a slot takes, once
around for every whole use of the source; a join by block number fetches the words.

Targets: sources by code point, null last, weigh 3, 1, 2, again and again, and share 150 % of
all words. A target stops at twice its source, and what is over is shared by weight among the
others, until none is above. A source's last use is cut to the word, so the words taken from a
source are its rounded target, and a document is taken twice at most.

Nothing grows in one place: positions are running sums over ranges of rows, a source of any
size is many ranges; draws go down a tree of sources, ``FAN`` at a step; the rounds that share
the excess bring two numbers to the driver. A permutation has no table, it is worked out.

Nulls and odd input: a null text has no words; null is a source of its own, the last one.
Documents without words are never taken. Repeated rows, and those with equal or null keys, are
documents of their own. Long texts span blocks, their words stay in order. Other columns of
the input play no part. An empty table, or one without any word, takes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialise

# Weights in order of the sources, share of all words, most uses of a source.
WEIGHTS = (3, 1, 2)
SHARE_NUM, SHARE_DEN = 3, 2
MOST_USES = 2
BLOCK = 256  # words
SLOTS = 8192  # of an output shard
FAN = 1024  # sources told apart in one draw
WORD = r"[^\x20\x09-\x0D]+"


class Mix(NamedTuple):
    """Documents and sources with their figures, and the pieces that make up each slot."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """``df``, stored, with each of ``sums`` over the rows before a row in ``order``.

    Rows are sorted by range and summed within the ranges; only the ranges' totals, as many
    as there are partitions, are summed in one place.
    """
    parts = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    stored = materialise(parts)
    totals = stored.groupBy("_range").agg(*(F.sum(v).alias(f"_all_{n}") for n, v in sums.items()))
    # One row a partition: this window is bounded by their number.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *(F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums)
    )
    inner = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = stored.select("*", *(F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_in_{n}") for n, v in sums.items()))
    made = {n: F.col(f"_in_{n}") + F.col(f"_off_{n}") for n in sums}
    joined = summed.join(F.broadcast(offsets), "_range")
    return materialise(joined.select(*df.columns, *(v.cast("long").alias(n) for n, v in made.items())))


def _placed(documents: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """``row, key, source, size`` and ``start``, a document's place among all words."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    sized = materialise(
        documents.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(told).alias("deal"),
            F.xxhash64(text).alias("content"),
        )
    )
    order = [F.col("source").isNull(), F.col("source"), F.col("deal"), F.col("key"), F.col("size"), F.col("content")]
    placed = running(sized, order, row=F.lit(1), start=F.col("size"))
    return placed.select("row", "key", "source", "size", "start")


def _targets(placed: DataFrame) -> DataFrame:
    """One row a source: ``rank, source, words, start, target`` and the ``quota`` in words."""
    sums = placed.groupBy("source").agg(F.sum("size").alias("words"), F.min("start").alias("start"))
    ranked = running(sums, [F.col("source").isNull(), F.col("source")], rank=F.lit(1))
    weights = F.array(*map(F.lit, WEIGHTS))
    weighed = materialise(
        ranked.withColumns(
            {
                "weight": F.get(weights, (F.col("rank") % len(WEIGHTS)).cast("int")).cast("long"),
                "most": MOST_USES * F.col("words"),
            }
        )
    )
    whole = SHARE_NUM * (weighed.agg(F.sum("words")).first()[0] or 0)
    # What a weight of one gets is shared / (SHARE_DEN * among); each round caps some more.
    shared, among, capped = whole, 0, F.lit(False)
    while True:
        seen = weighed.agg(
            F.sum(F.when(capped, F.col("most"))).alias("most"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        left = whole - SHARE_DEN * int(seen.most or 0), int(seen.weight or 0)
        if left == (shared, among) or not left[1]:
            break
        shared, among = left
        part = F.lit(shared).cast("decimal(38,0)")
        capped = F.col("weight") * part > F.col("most") * F.lit(SHARE_DEN * among).cast("decimal(38,0)")
    fair = (F.col("weight") * F.lit(shared)).cast("double") / F.lit(SHARE_DEN * max(among, 1)).cast("double")
    return materialise(
        weighed.withColumn("target", F.when(capped, F.col("most").cast("double")).otherwise(fair)).withColumn(
            "quota", F.least(F.round("target").cast("long"), F.col("most"))
        )
    )


def _parts(words: str, size: int) -> Column:
    return F.expr(f"({words} + {size - 1}) div {size}")


def _counted(sources: DataFrame, block: int) -> DataFrame:
    """Sources with their ``blocks`` and the number of ``slots`` their quota takes."""
    return (
        sources.withColumn("blocks", _parts("words", block))
        .withColumn("uses", F.expr("if(words > 0, quota div words, 0L)"))
        .withColumn("rest", F.col("quota") - F.col("uses") * F.col("words"))
        .withColumn("slots", F.col("uses") * F.col("blocks") + _parts("rest", block))
        .drop("uses", "rest", "blocks")
    )


def _generator(*parts: object) -> np.random.Generator:
    digest = hashlib.sha256(":".join(map(str, parts)).encode()).digest()
    return np.random.Generator(np.random.Philox(int.from_bytes(digest[:16], "little")))


def draw(seed: int, shard: int, node: int, level: int, count: int, slots: list[int]) -> list[int]:
    """How many of ``count`` slots of a shard go to each child of a node of the tree."""
    weights = np.array(slots, np.float64)
    return _generator(seed, "draw", shard, level, node).multinomial(count, weights / weights.sum()).tolist()


def _drawn(sources: DataFrame, shards: DataFrame, seed: int, fan: int) -> DataFrame:
    """``shard, rank, count``: the slots each shard draws of each source."""
    levels, level = [], sources.select(F.col("rank").alias("child"), "slots").filter("slots > 0")
    while True:
        child = F.struct("child", "slots")
        nodes = level.groupBy(F.floor(F.col("child") / fan).cast("long").alias("node")).agg(
            F.array_sort(F.collect_list(child)).alias("children"), F.sum("slots").alias("slots")
        )
        levels.append(materialise(nodes))
        if levels[-1].count() <= 1:
            break
        level = levels[-1].select(F.col("node").alias("child"), "slots")
    top = levels.pop().first()
    if top is None:
        return shards.select("shard", F.col("shard").alias("rank"), "count").limit(0)
    first = [(child.child, child.slots) for child in top.children]  # at most ``fan``
    height = len(levels)

    def split(rows: Iterable[tuple], depth: int) -> pa.RecordBatch:
        made = [
            (shard, child, n)
            for shard, node, count, children in rows
            for (child, _), n in zip(children, draw(seed, shard, node, depth, count, [c[1] for c in children]))
            if n
        ]
        columns = [pa.array(values, pa.int64()) for values in zip(*made)] or [pa.array([], pa.int64())] * 3
        return pa.RecordBatch.from_arrays(columns, names=["shard", "node", "count"])

    def start(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(column(batch, "shard").to_pylist(), column(batch, "count").to_pylist())
            yield split(((shard, 0, count, first) for shard, count in pairs), height)

    def stepper(depth: int) -> Callable:
        def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = [column(batch, c).to_pylist() for c in ("shard", "node", "count", "children")]
                values[3] = [[(c["child"], c["slots"]) for c in children] for children in values[3]]
                yield split(zip(*values), depth)

        return step

    schema = "shard long, node long, count long"
    drawn = shards.mapInArrow(start, schema)
    for depth in reversed(range(len(levels))):
        nodes = levels[depth].select("node", "children")
        drawn = drawn.join(nodes, "node").mapInArrow(stepper(depth), schema)
    return drawn.withColumnRenamed("node", "rank")


def _units(df: DataFrame, order: str, count: str) -> DataFrame:
    """A row for each of ``count`` units, numbered as ``unit`` through all rows by ``order``."""
    some = running(df.select(order, count).filter(F.col(count) > 0), [F.col(order)], unit=F.col(count))
    return some.select(order, F.explode(F.sequence("unit", F.col("unit") + F.col(count) - 1)).alias("unit"))


def _evened(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """``drawn`` with every source's slots brought to its number: ``shard, rank, count``."""
    placed = running(drawn, [F.col("rank"), F.col("shard")], at=F.col("count"))
    sums = placed.groupBy("rank").agg(F.min("at").alias("first"), F.sum("count").alias("all"))
    wanted = materialise(sources.select("rank", "slots").join(sums, "rank", "left"))
    counts = materialise(
        placed.join(wanted, "rank")
        .withColumn("open", F.greatest(F.col("slots") - (F.col("at") - F.col("first")), F.lit(0)))
        .select("shard", "rank", "count", F.least("count", "open").alias("kept"))
    )
    free = counts.groupBy("shard").agg(F.sum(F.col("count") - F.col("kept")).alias("free"))
    lacking = wanted.select(
        "rank", (F.col("slots") - F.least("slots", F.coalesce("all", F.lit(0)))).alias("lack")
    )
    moved = _units(free, "shard", "free").join(_units(lacking, "rank", "lack"), "unit")
    given = moved.groupBy("shard", "rank").agg(F.count("*").alias("count"))
    kept = counts.select("shard", "rank", F.col("kept").alias("count")).unionByName(given)
    return kept.groupBy("shard", "rank").agg(F.sum("count").alias("count")).filter("count > 0")


def _mixed(x: np.ndarray, key: np.ndarray, rnd: int) -> np.ndarray:
    """A round function on 64-bit numbers."""
    z = x + key + np.uint64((rnd + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed permutation of ``size`` places puts each ``index``.

    Four Feistel rounds over the next power of four; what falls outside walks on.
    """
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2).astype(np.uint64)
    half = (np.uint64(1) << np.maximum(bits, np.uint64(1))) - np.uint64(1)
    shift = np.maximum(bits, np.uint64(1))
    x = index.astype(np.uint64)
    open_ = np.arange(len(x))
    while len(open_):
        h, s, k = half[open_], shift[open_], key[open_]
        left, right = x[open_] >> s, x[open_] & h
        for rnd in range(4):
            left, right = right, left ^ (_mixed(right, k, rnd) & h)
        x[open_] = (left << s) | right
        open_ = open_[x[open_] >= size[open_].astype(np.uint64)]
    return x.astype(np.int64)


def permutation_key(seed: int, rank: int, use: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:use:{rank}:{use}".encode()).digest()[:8], "little")


def _blocks_of(slots: DataFrame, seed: int, block: int) -> DataFrame:
    """Slots (``shard, rank, number, words, quota``) with the ``block`` and the words they take.

    The whole blocks of a source are permuted anew for each use, the short one comes last.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, words, quota, rank = (
                column(batch, c).to_numpy() for c in ("number", "words", "quota", "rank")
            )
            around, full = -(-words // block), words // block
            use, place = number // around, number % around
            keys = {pair: permutation_key(seed, *pair) for pair in {*zip(rank.tolist(), use.tolist())}}
            key = np.array([keys[pair] for pair in zip(rank.tolist(), use.tolist())], np.uint64)
            at = place.copy()
            inside = place < full
            at[inside] = permuted(place[inside], full[inside], key[inside])
            length = np.minimum(block, words - place * block)
            length = np.minimum(length, quota - use * words - place * block)
            made = {"shard": column(batch, "shard"), "rank": rank, "number": number, "block": at, "length": length}
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in made.values()], names=list(made))

    return slots.mapInArrow(run, "shard long, rank long, number long, block long, length long")


def mix(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1,
    block: int = BLOCK,
    shard_slots: int = SLOTS,
    fan: int = FAN,
) -> Mix:
    """Mix ``documents`` so that the words of each source come to its target.

    ``documents``: ``row, key, source, size``, the ``start`` in the words of its source, the
    source's ``rank``, ``source_size`` and ``target``.
    ``sources``: ``rank, source, words, target, quota, slots``. ``slots``: ``shard, slot, rank,
    block, length``. ``pieces``: for every slot the documents it holds, as words ``[first,
    last)`` of the document, in order of ``place``, the piece's first word in the slot.
    """
    placed = _placed(documents, key, text, source, seed)
    sources = materialise(_counted(_targets(placed), block))
    spark = documents.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = spark.range(-(-total // shard_slots)).select(
        F.col("id").alias("shard"),
        F.least(F.lit(shard_slots), F.lit(total) - F.col("id") * shard_slots).cast("long").alias("count"),
    )
    counts = running(
        _evened(_drawn(sources, shards, seed, fan), sources), [F.col("rank"), F.col("shard")], at=F.col("count")
    )
    firsts = counts.groupBy("rank").agg(F.min("at").alias("first"))
    figures = materialise(sources.select("rank", "words", "quota").join(firsts, "rank"))
    number = F.sequence("at", F.col("at") + F.col("count") - 1)
    numbered = (
        counts.select("shard", "rank", F.explode(number).alias("at"))
        .join(figures, "rank")
        .withColumn("number", F.col("at") - F.col("first"))
    )
    taken = _blocks_of(numbered, seed, block)
    dealt = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "rank", "number"), "rank", "number")
    slots = materialise(
        taken.select("shard", (F.row_number().over(dealt) - 1).cast("long").alias("slot"), "rank", "block", "length")
    )
    own = sources.select(F.col("source").alias("of"), "rank", "words", "target", F.col("start").alias("origin"))
    told = placed.join(own, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "key", "source", "size", "rank", (F.col("start") - F.col("origin")).alias("start"),
        F.col("words").alias("source_size"), "target",
    )
    last = F.col("start") + F.col("size")
    spread = (
        told.filter("size > 0")
        .withColumn("stop", last)
        .select(
            "row", "key", "rank", "start", "stop",
            F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((last - 1) / block))).alias("block"),
        )
    )
    begins = F.col("block") * block
    pieces = (
        spread.join(slots, ["rank", "block"])
        .withColumn("place", F.greatest(F.col("start") - begins, F.lit(0)))
        .withColumn("end", F.least(F.col("stop") - begins, F.col("length")))
        .filter("place < end")
        .select(
            "shard", "slot", "place", "row", "key",
            (begins + F.col("place") - F.col("start")).alias("first"),
            (begins + F.col("end") - F.col("start")).alias("last"),
        )
    )
    return Mix(told, sources, slots, pieces)


def words_taken(found: Mix) -> DataFrame:
    """Every document with ``source_size``, ``target`` and the words ``taken`` of it, repeats counted."""
    taken = found.pieces.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return found.documents.join(taken, "row", "left").select(
        "key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
