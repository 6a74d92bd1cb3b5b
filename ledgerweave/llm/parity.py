"""Near-duplicate documents by a join of parity sketches.

A document is its set of distinct five-word shingles. Equal sets are one class, of which
only one goes on. The shingles of a set are dealt by hash into blocks, and the XOR of a
block's shingles is its parity word; a shingle in one of two sets but not in both
changes one block at most. So the number of blocks that differ is a lower bound of the
symmetric difference, which at a Jaccard similarity ``t`` is at most
``(a + b) (1 - t) / (1 + t)`` for sets of ``a`` and ``b`` shingles: similar sets must agree
in all other blocks. Sets are compared per size band, which fixes the number of
blocks; a set near the upper end of its band also takes part in the next one. Because
so many blocks agree, it is enough to look up a set's blocks with the least parity
words, one more than may differ (pigeonhole): two similar sets share one of these.

Pairs found so pass a second, finer parity sketch of one bit per block, whose Hamming
distance bounds the symmetric difference as well, and what remains is verified on the
shingles themselves. Buckets of more than ``BUCKET`` sets do not emit their pairs: their
sketches are compared within the task, which emits a spanning forest of the pairs that
pass. Verified links are joined into components, and a second round emits those pairs
of large buckets that pass but lie in different components so far; so no link between
components is lost, and a group of copies never makes all its pairs.

Nulls: a null text is an empty set; empty sets link with nothing. Documents without
doc_id link like others, but never name a component. Repeated rows are equal sets.
Shingles are compared as 64-bit numbers. Columns beside the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, column, in_table, map_batches, materialise
from .components import components
from .shingles import Shingler, mix, shingles_of

SIMILAR = (80, 100)  # intersection to union, as a fraction
BUCKET = 8  # sets; larger buckets emit a forest instead of all pairs
SMALL = 5  # bands below 2^5 shingles have a block for each shingle
ROWS = 2_000_000  # of a task that looks for shared blocks
TEXTS = 1_000  # whose sets a task holds at once
_U64 = np.uint64


def most_apart(a, b):
    """The largest symmetric difference of similar sets of these sizes."""
    part, whole = SIMILAR
    return (a + b) * (whole - part) // (whole + part)


def set_id(shingles: np.ndarray) -> int:
    """A number for a set of distinct shingles, as a signed 64-bit number."""
    total = int(mix(shingles + _U64(1)).sum(dtype=np.uint64)) ^ int(np.bitwise_xor.reduce(mix(shingles)))
    return _signed(int(mix(np.array([total], np.uint64))[0]))


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _bands(n: int) -> list[int]:
    """The size bands a set of ``n`` shingles takes part in."""
    part, whole = SIMILAR
    own = n.bit_length() - 1
    return [own, own + 1] if whole * n >= part << (own + 1) else [own]


def parity_words(shingles: np.ndarray, band: int) -> np.ndarray:
    """The parity words of the blocks that are not empty, each with its band and block."""
    if band < SMALL:
        words = mix(shingles)
    else:
        # A quarter of the largest size: more blocks than may differ, few of them empty.
        n_blocks = (1 << (band - 1)) + 32
        block = ((mix(shingles + _U64(7)) >> _U64(32)) * _U64(n_blocks)) >> _U64(32)
        order = np.argsort(block, kind="stable")
        block = block[order]
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        words = np.bitwise_xor.reduceat(mix(shingles)[order], starts) + mix(block[starts] + _U64(1))
    return mix(words + _U64(band + 1))


def signatures(shingles: np.ndarray) -> np.ndarray:
    """What a set is looked up by, over all its bands."""
    part, whole = SIMILAR
    n = len(shingles)
    larger = n * whole // part  # the largest partner
    most = most_apart(n, larger) + 1
    found = []
    for band in _bands(n):
        words = parity_words(shingles, band)
        found.append(np.partition(words, most - 1)[:most] if most < len(words) else words)
    return np.concatenate(found)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """One parity bit per block, at least two blocks per shingle, as 64-bit words."""
    bits = max(256, 1 << (2 * len(shingles) - 1).bit_length())
    flips = np.bincount((mix(shingles + _U64(3)) & _U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch with so many words, as fewer blocks would have made it."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def _distinct_sets(batch: pa.RecordBatch, shingler: Shingler) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingles) of each text."""
    for first, words, counts in shingler.blocks(column(batch, "text")):
        ends = np.cumsum(counts)
        for k, end in enumerate(ends):
            own = shingles_of(words[end - counts[k] : end])
            own.sort()
            if len(own):
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            yield first + k, own


def shingle_sets(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id) of all documents; set_id is null for empty sets."""

    def start() -> Callable:
        shingler = Shingler()

        def work(batch: pa.RecordBatch) -> dict:
            found = [(len(s), set_id(s) if len(s) else None) for _, s in _distinct_sets(batch, shingler)]
            return {
                "doc_id": column(batch, "doc_id"),
                "n_shingles": pa.array([n for n, _ in found], pa.int64()),
                "set_id": pa.array([i for _, i in found], pa.int64()),
            }

        return work

    return map_batches(documents, "doc_id long, n_shingles long, set_id long", start, TEXTS)


def _signature_rows(documents: DataFrame) -> DataFrame:
    """(signature, set_id) of all sets; a task gives a set's rows once."""

    def start() -> Callable:
        shingler, done = Shingler(), set()

        def work(batch: pa.RecordBatch) -> dict:
            words, ids, sizes = [np.zeros(0, np.uint64)], [], []
            for _, s in _distinct_sets(batch, shingler):
                if len(s) and (own := set_id(s)) not in done:
                    done.add(own)
                    words.append(signatures(s))
                    ids.append(own)
                    sizes.append(len(words[-1]))
            return {
                "signature": pa.array(np.concatenate(words).view(np.int64)),
                "set_id": pa.array(np.repeat(np.array(ids, np.int64), sizes)),
            }

        return work

    return map_batches(documents, "signature long, set_id long", start, TEXTS)


def _buckets(rows: DataFrame) -> DataFrame:
    """Pairs of small buckets (a, b) and, with ``a`` null, the rows of large ones
    (signature, b)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [
            (column(x, "signature").to_numpy(), column(x, "set_id").to_numpy()) for x in batches if x.num_rows
        ]
        if not parts:
            return
        signature, ids = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((ids, signature))
        signature, ids = signature[order], ids[order]
        new = (signature[1:] != signature[:-1]) | (ids[1:] != ids[:-1])
        kept = np.concatenate(([True], new))
        signature, ids = signature[kept], ids[kept]
        starts = np.flatnonzero(np.concatenate(([True], signature[1:] != signature[:-1])))
        sizes = np.diff(np.append(starts, len(signature)))
        size = np.repeat(sizes, sizes)
        large = size > BUCKET
        place = np.arange(len(ids)) - np.repeat(starts, sizes)
        pairs = [np.zeros((0, 2), np.int64)]
        for step in range(1, BUCKET):
            at = np.flatnonzero(~large & (place + step < size))
            pairs.append(np.stack((ids[at], ids[at + step]), axis=1))
        found = np.unique(np.concatenate(pairs), axis=0)
        none = np.zeros(len(found), bool)
        some = np.ones(int(large.sum()), bool)
        first = np.concatenate((found[:, 0], signature[large]))
        columns = [
            pa.array(first, mask=np.concatenate((none, some))),
            pa.array(np.concatenate((found[:, 1], ids[large]))),
            pa.array(first, mask=np.concatenate((~none, ~some))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "signature"])

    return rows.mapInArrow(run, "a long, b long, signature long")


def _needed_sets(documents: DataFrame, ids: DataFrame, reps: DataFrame, full: bool) -> DataFrame:
    """The sets with the given ``ids`` (set_id): their n and sketch, or in full their shingles.

    They are made anew from one text each. A bit table of fixed size picks the texts; the few it
    lets through beside them find no partner later.
    """

    def start() -> Callable:
        shingler = Shingler()

        def work(batch: pa.RecordBatch) -> dict:
            sets = [s for _, s in _distinct_sets(batch, shingler) if len(s)]
            own = {"set_id": pa.array([set_id(s) for s in sets], pa.int64())}
            if full:
                return own | {"shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))}
            return own | {
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "sketch": pa.array([bit_sketch(s).tobytes() for s in sets], pa.binary()),
            }

        return work

    wanted = ids.distinct().join(reps, "set_id")
    chosen = in_table(documents, "doc_id", bit_table(wanted, "doc_id"))
    schema = "set_id long, shingles array<long>" if full else "set_id long, n long, sketch binary"
    return materialise(map_batches(chosen, schema, start, TEXTS))


def _passing(sizes: np.ndarray, sketches: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` may be similar to ``one``, by size and sketch."""
    part, whole = SIMILAR
    n, m = sizes[one], sizes[others]
    apart = np.bitwise_count(sketches[others] ^ sketches[one]).sum(axis=1, dtype=np.int64)
    sized = whole * np.minimum(n, m) >= part * np.maximum(n, m)
    return others[sized & (apart <= most_apart(n, m))]


def _bucket_pairs(ids: np.ndarray, sizes: np.ndarray, sketches: list[bytes], labels: np.ndarray | None) -> list:
    """Pairs of a bucket's sets that pass: without labels a spanning forest of them,
    otherwise all whose labels differ."""
    words = min(len(s) for s in sketches) // 8
    table = np.stack([folded(np.frombuffer(s, np.uint64), words) for s in sketches])
    found = []
    if labels is not None:
        for i in range(len(ids) - 1):
            others = np.arange(i + 1, len(ids))
            others = others[labels[others] != labels[i]]
            found += [(ids[i], ids[j]) for j in _passing(sizes, table, i, others)] if len(others) else []
        return found
    left = np.arange(len(ids))
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            near = _passing(sizes, table, one, left)
            found += [(ids[one], ids[j]) for j in near]
            reached += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return found


def _large_bucket_pairs(rows: DataFrame, labelled: bool) -> DataFrame:
    """Candidate pairs (a, b) from the rows (signature, b, n, sketch, label) of large buckets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()

        def pairs(bucket: list[tuple]) -> pa.RecordBatch | None:
            ids, sizes, sketches, labels = zip(*dict.fromkeys(bucket))
            made = _bucket_pairs(
                np.array(ids), np.array(sizes), sketches, np.array(labels) if labelled else None
            )
            fresh = {(min(p), max(p)) for p in made} - seen
            seen.update(fresh)
            if not fresh:
                return None
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*fresh)], ["a", "b"])

        bucket, current = [], None
        for batch in batches:
            columns = [column(batch, c).to_pylist() for c in ("signature", "b", "n", "sketch", "label")]
            for signature, *row in zip(*columns):
                if signature != current and bucket:
                    if (made := pairs(bucket)) is not None:
                        yield made
                    bucket = []
                current = signature
                bucket.append(tuple(row))
        if bucket and (made := pairs(bucket)) is not None:
            yield made

    in_order = rows.repartition("signature").sortWithinPartitions("signature", "b")
    return in_order.mapInArrow(run, "a long, b long").distinct()


def _sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sizes and sketches allow them to be similar."""
    light = sets.select("set_id", "n", "sketch")
    both = pairs.join(light.toDF("a", "n_a", "sketch_a"), "a").join(light.toDF("b", "n_b", "sketch_b"), "b")

    def start() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            kept = []
            for n, m, x, y in zip(*(column(batch, c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b"))):
                words = min(len(x), len(y)) // 8
                apart = folded(np.frombuffer(x, np.uint64), words) ^ folded(np.frombuffer(y, np.uint64), words)
                kept.append(int(np.bitwise_count(apart).sum()) <= most_apart(n, m))
            chosen = pa.array(kept, pa.bool_())
            return {c: column(batch, c).filter(chosen) for c in ("a", "b")}

        return work

    part, whole = SIMILAR
    sized = both.filter(whole * F.least("n_a", "n_b") >= part * F.greatest("n_a", "n_b"))
    return map_batches(sized, "a long, b long", start)


def _verified(pairs: DataFrame, documents: DataFrame, reps: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of sets that are similar."""
    part, whole = SIMILAR
    full = _needed_sets(documents, pairs.select(F.explode(F.array("a", "b")).alias("set_id")), reps, full=True)
    common = F.size(F.array_intersect("x", "y")).cast("long")
    every = F.size("x") + F.size("y") - common
    return (
        pairs.join(full.toDF("a", "x"), "a")
        .join(full.toDF("b", "y"), "b")
        .filter(whole * common >= part * every)
        .select("a", "b")
    )


def near_duplicates(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that links lead to."""
    texts = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = materialise(shingle_sets(texts))
    reps = materialise(
        sets.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    )
    buckets = materialise(_buckets(_dealt(_signature_rows(texts), sets)))
    pairs = buckets.filter("a IS NOT NULL").select("a", "b").distinct()
    crowded = buckets.filter("a IS NULL").select("signature", "b")
    met = buckets.select(F.explode(F.array("a", "b")).alias("set_id")).dropna()
    light = _needed_sets(texts, met, reps, full=False)
    crowded = crowded.join(light.select(F.col("set_id").alias("b"), "n", "sketch"), "b")
    forest = _large_bucket_pairs(crowded.withColumn("label", F.lit(0).cast("long")), labelled=False)
    likely = materialise(_sketched(pairs.unionByName(forest).distinct(), light))
    links = materialise(_verified(likely, texts, reps))
    label = F.coalesce("component", "b").alias("label")
    apart = crowded.join(components(links).withColumnRenamed("node", "b"), "b", "left")
    across = materialise(
        _large_bucket_pairs(apart.select("signature", "b", "n", "sketch", label), labelled=True)
    )
    if not across.isEmpty():
        links = links.unionByName(_verified(across, texts, reps))
    return _by_document(sets, reps, links)


def _dealt(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Signature rows dealt so that a task gets about ``ROWS`` of them."""
    shuffled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    return rows.repartition(max(shuffled, total // (3 * ROWS) + 1), "signature")


def _by_document(sets: DataFrame, reps: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    labelled = reps.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = materialise(labelled.join(least, "component").select("set_id", "component_id"))
    return sets.join(classes, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
