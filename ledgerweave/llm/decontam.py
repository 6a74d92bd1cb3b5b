"""Passages of benchmark items in documents, found by SimHash over item-sized windows.

Each item and each window of as many words has a 64-bit SimHash of its five-word
shingles. Fingerprints within ``RADIUS`` bits are found by blocks: cut into ``BLOCKS``
blocks, two such fingerprints have a block that differs in at most ``RADIUS // BLOCKS``
bits, so looking up each item's blocks with all such changes misses none. Candidates
are verified exactly: the similarity is the weighted Jaccard of the two multisets of
shingles, each shingle weighing as often as it occurs.

Which windows are worth a fingerprint is decided without loss: a window as similar as
``SIMILARITY`` to an item of its size has at least a known share of shingles from items of
that size, and a bit table of the benchmark's shingles, of fixed size, bounds that
share from above. A document shorter than an item is a window as a whole.

Items and documents without words match nothing; items of fewer than five words count
as one shingle. Null ids are kept and matched like others. A passage that occurs again
in a document, and a repeated row, give one pair; columns beside the named ones are not
read. At a similarity of exactly 0.8 a pair differs in 10 bits on average, so that
``RADIUS`` 20 keeps 99.9 % even of such, and all equal ones.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, materialise
from .shingles import WORDS, Shingler, as_multiset, grams, mix, shingles_of

SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 7
TABLE_BITS = 1 << 25  # of the table of benchmark shingles; 4 MB
ANY_SIZE = 0  # the size under which the table notes all shingles
_U64 = np.uint64


def simhash(shingles: np.ndarray) -> int:
    """The fingerprint of a multiset of shingles, as a signed 64-bit number."""
    bits = (mix(shingles)[:, None] >> np.arange(64, dtype=np.uint64)) & _U64(1)
    votes = 2 * bits.sum(axis=0).astype(np.int64) - len(shingles)
    number = int((_U64(1) << np.flatnonzero(votes > 0).astype(np.uint64)).sum())
    return number - (1 << 64) if number >> 63 else number


def _block_bounds() -> list[tuple[int, int]]:
    edges = [round(i * 64 / BLOCKS) for i in range(BLOCKS + 1)]
    return list(zip(edges, edges[1:]))


def blocks_of(fingerprint: Column) -> Column:
    """The fingerprint's blocks, as an array of (block, value)."""
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
            )
            for i, (a, b) in enumerate(_block_bounds())
        )
    )


def changes(bits: int, most: int) -> list[int]:
    """All masks of up to ``most`` of so many bits."""
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def lookups_of(fingerprint: Column) -> Column:
    """All block values within reach of the fingerprint's blocks."""

    def lookups(block: int, low: int, high: int) -> Column:
        value = F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        masks = F.array(*(F.lit(m).cast("long") for m in changes(high - low, RADIUS // BLOCKS)))
        return F.transform(
            masks, lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value"))
        )

    return F.concat(*(lookups(i, a, b) for i, (a, b) in enumerate(_block_bounds())))


def prepare_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """The items (item_id, size, fingerprint, shingles, bits), without those that have no words."""

    def start() -> Callable:
        shingler = Shingler()

        def work(batch: pa.RecordBatch) -> dict:
            rows = []
            ids = column(batch, "item_id").to_pylist()
            for first, words, counts in shingler.blocks(column(batch, "text")):
                ends = np.cumsum(counts)
                for k, end in enumerate(ends):
                    own = words[end - counts[k] : end]
                    if len(own):
                        found = shingles_of(own)
                        rows.append((ids[first + k], len(own), simhash(found), found))
            return {
                "item_id": pa.array([r[0] for r in rows], pa.int64()),
                "size": pa.array([r[1] for r in rows], pa.int32()),
                "fingerprint": pa.array([r[2] for r in rows], pa.int64()),
                "shingles": pa.array(
                    [as_multiset(r[3]).astype(np.int64) for r in rows], pa.list_(pa.int64())
                ),
                "bits": pa.array(
                    [
                        np.concatenate([table_places(r[3], n) for n in (ANY_SIZE, r[1])]).astype(np.int64)
                        for r in rows
                    ],
                    pa.list_(pa.int64()),
                ),
            }

        return work

    rows = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
    schema = "item_id long, size int, fingerprint long, shingles array<long>, bits array<long>"
    return map_batches(rows, schema, start)


def table_places(shingles: np.ndarray, size: int) -> np.ndarray:
    """Where the table notes shingles of items with ``size`` words."""
    return mix(shingles + _U64(size)) % _U64(TABLE_BITS)


def shingle_table(items: DataFrame) -> np.ndarray:
    """The table of all shingles, by the size of their item; ``TABLE_BITS`` bits however
    many items there are."""
    place = F.explode("bits")
    words = (
        items.select(place.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits"))
    )
    table = np.zeros(TABLE_BITS // 64, np.int64)
    for word, bits in words.toLocalIterator():
        table[word] = bits
    return table.view(np.uint64)


def _noted(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> _U64(6)] >> (places & _U64(63))) & _U64(1) > 0


def document_windows(
    documents: DataFrame,
    table: np.ndarray,
    sizes: list[int],
    similarity: float = SIMILARITY,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The windows (doc_id, start, size, fingerprint, shingles) that may match an item."""
    shared = documents.sparkSession.sparkContext.broadcast((table, sizes))

    def start() -> Callable:
        shingler = Shingler()
        noted, wanted = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            ids = column(batch, "doc_id")
            rows = []
            for first, words, counts in shingler.blocks(column(batch, "text")):
                for of, begin, size, shingles in _windows(words, counts, noted, wanted, similarity):
                    rows.append((ids[first + of].as_py(), begin, size, shingles))
            return {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "start": pa.array([r[1] for r in rows], pa.int64()),
                "size": pa.array([r[2] for r in rows], pa.int32()),
                "fingerprint": pa.array([simhash(r[3]) for r in rows], pa.int64()),
                "shingles": pa.array(
                    [as_multiset(r[3]).astype(np.int64) for r in rows], pa.list_(pa.int64())
                ),
            }

        return work

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, start long, size int, fingerprint long, shingles array<long>"
    return map_batches(rows, schema, start)


def _windows(words: np.ndarray, counts: np.ndarray, table: np.ndarray, sizes: list[int], similarity: float):
    """(text, first word, item size, shingles) of the windows of a block to look at."""
    ends = np.cumsum(counts)
    of_word = np.repeat(np.arange(len(counts)), counts)
    for k in sorted({min(WORDS, size) for size in sizes}):
        found = grams(words, k)
        if not len(found):
            continue
        # A shingle never leaves its text.
        whole = of_word[: len(found)] == of_word[k - 1 : k - 1 + len(found)]
        places = np.flatnonzero(whole & _noted(table, table_places(found, ANY_SIZE)))
        if not len(places):
            continue
        for size in sizes:
            if min(WORDS, size) == k:
                hits = places[_noted(table, table_places(found[places], size))]
                yield from _dense_windows(hits, found, k, size, of_word, ends, counts, similarity)


def _dense_windows(hits, found, k, size, of_word, ends, counts, similarity):
    """The windows for items of one size that hold enough of the places ``hits``."""
    span = size - k + 1
    texts, first = np.unique(of_word[hits], return_index=True)
    n_hits = np.diff(np.append(first, len(hits)))
    spans = np.minimum(span, counts[texts] - k + 1)
    least = np.maximum(1, np.ceil(similarity * (spans + span) / (1 + similarity) - 1e-9))
    for of, own, need in zip(texts[n_hits >= least], spans[n_hits >= least], least[n_hits >= least]):
        begin = ends[of] - counts[of]
        starts = np.arange(begin, ends[of] - k + 2 - own)
        common = np.searchsorted(hits, starts + own) - np.searchsorted(hits, starts)
        for at in starts[common >= need]:
            yield int(of), int(at - begin), size, found[at : at + own]


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY
) -> DataFrame:
    """Pairs (doc_id, item_id) with their largest ``similarity`` and where it starts (in words)."""
    items = materialise(prepare_items(benchmark))
    sizes = [row["size"] for row in items.select("size").distinct().orderBy("size").collect()]
    windows = materialise(document_windows(documents, shingle_table(items), sizes, similarity))
    here = windows.select("*", F.explode(blocks_of(F.col("fingerprint"))).alias("b")).select(
        "doc_id", "start", "size", "fingerprint", "shingles", "b.block", "b.value"
    )
    there = items.select(
        "item_id",
        F.col("size").alias("_size"),
        F.col("fingerprint").alias("_fingerprint"),
        F.col("shingles").alias("_shingles"),
        F.explode(lookups_of(F.col("fingerprint"))).alias("b"),
    ).select("*", F.col("b.block").alias("_block"), F.col("b.value").alias("_value")).drop("b")
    near = here.join(
        there,
        (F.col("size") == F.col("_size")) & (F.col("block") == F.col("_block")) & (F.col("value") == F.col("_value")),
    ).filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_fingerprint"))) <= RADIUS)
    common = F.size(F.array_intersect("shingles", "_shingles"))
    every = F.size("shingles") + F.size("_shingles") - common
    return (
        near.withColumn("similarity", common / every)
        .filter(F.col("similarity") >= similarity)
        .groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start"))
    )
