"""Repeated passages removed by merging Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in a
document with a smaller doc_id, or earlier in the same one). The work is cut into
pieces that can be dealt out without missing a repeat:

1. *Anchors.* Of the ``GRAM``-byte substrings in a string of ``LENGTH`` bytes, the one with
   the least hash is its anchor; equal strings have equal anchors at equal offsets. All
   strings with one anchor lie in its context, the bytes around it.
2. *Equal contexts.* Of occurrences with equal contexts all but the earliest are
   repeats altogether. That is settled per batch ahead of the shuffle, then per anchor.
3. *Unequal contexts* are split by where the anchor stands in the string, into
   ``PARTS`` ranges of offsets. All strings of a range share a core, so only contexts
   with equal cores go on, as strings a few bytes longer than ``LENGTH``: the number of
   the core, and the up to ``SLACK`` bytes on either side of the ``CORE`` bytes that all have.
4. *Transforms.* In the strings of a batch a few symbols that no text has, one way for each
   core, stand for the bytes of the core, so that ``LENGTH`` bytes are as many symbols less
   than that. The strings are dealt to shards, each with its suffix array
   and transform. The transforms are merged by refining their interleave: a pass sorts
   the merged suffixes by two more symbols by handing each to the bucket of the symbols
   ahead of it; suffixes that are alone by then are settled. The blocks left after the
   symbols of ``LENGTH`` bytes are the intervals of equal strings; of each, all but the
   earliest start are repeats.

Cores with more than ``STRINGS`` different strings (a passage of just such a length in very
many surroundings) are compared by the numbers of their strings instead.

Nulls: a null text is empty; a null doc_id orders ahead of all others and is kept. Rows
equal in doc_id and text are one document and do not repeat each other. Different texts
that share a doc_id, or have none, are documents of their own, in order of a hash of the
text; such tables are numbered anew first, which stores the documents once.
Texts shorter than ``LENGTH`` bytes keep everything. Columns beside the named ones are not
read. Anchors, contexts and cores are compared as 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from .common import add_columns, bit_table, column, giving_back, in_table, map_batches, materialise
from .shingles import STEP, mix, powers

LENGTH = 100  # bytes of a repeat
GRAM = 32  # bytes of an anchor
OFFSETS = LENGTH - GRAM + 1  # where in a string its anchor can stand
PARTS = 8  # ranges of offsets
SHARDS = 4
BATCH = 400_000  # symbols of strings merged at once
STRINGS = 20_000  # of one core that are merged
BLOCK = 1 << 16  # bytes searched for anchors at once
TASK_BYTES = 1 << 26  # of text whose anchors go to one task
NO_ID = -(1 << 63)  # stands for a null doc_id
END, BETWEEN, SHIFT = 0, 1, 2  # symbols: end of a shard, between strings, bytes from 2 on
DIGIT, DIGITS = 247, 9  # symbols from 247 on, which no byte of UTF-8 has, number the cores
_U64 = np.uint64
_LAST = _U64((1 << 64) - 1)
_RANGES = [(i * OFFSETS // PARTS, (i + 1) * OFFSETS // PARTS - 1) for i in range(PARTS)]
SLACK = 8  # bytes that strings have on either side of their core, as one long
CORE = LENGTH - SLACK  # bytes from the start of a core that all its strings have
_PLACE = np.arange(SLACK)
# Which of the bytes of a long are there: the last ``n`` ahead of a core, the first ``n`` behind it.
_LAST_BYTES = (np.where(_PLACE >= SLACK - np.arange(SLACK + 1)[:, None], 255, 0)).astype(np.uint8).view(np.int64).ravel()
_FIRST_BYTES = (np.where(_PLACE < np.arange(SLACK + 1)[:, None], 255, 0)).astype(np.uint8).view(np.int64).ravel()


class _Hasher:
    """Numbers of substrings of a block, read off one running sum."""

    def __init__(self) -> None:
        self._letter = mix(np.arange(256, dtype=np.uint64) + _U64(1))
        self._grow(BLOCK)

    def _grow(self, n: int) -> None:
        self._up, self._down = powers(STEP, n), powers(pow(STEP, -1, 1 << 64), n)

    def load(self, data: np.ndarray) -> None:
        if len(data) >= len(self._up):
            self._grow(len(data))
        self._sums = np.concatenate(([_U64(0)], np.cumsum(self._letter[data] * self._up[: len(data)])))

    def number(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._down[start])

    def numbers(self, n: int, width: int) -> np.ndarray:
        """The numbers of the first ``n`` substrings of ``width`` bytes."""
        return mix((self._sums[width : width + n] - self._sums[:n]) * self._down[:n])


def _sliding(least: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """``least`` (or greatest) of each value and the ``width - 1`` after it."""
    done, spare = 1, [np.empty_like(x), np.empty_like(x)]
    while done < width:
        step = min(done, width - done)
        shifted = spare.pop()
        least(x[:-step], x[step:], out=shifted[:-step])
        shifted[-step:] = x[-step:]
        if done > 1:  # what the caller holds stays as it is
            spare.append(x)
        x, done = shifted, done + step
    return x


def anchors(data: np.ndarray, ends: np.ndarray, hasher: _Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the anchors of texts that lie one after the other."""
    n = len(data)
    hasher.load(data)
    starts = np.concatenate(([0], ends[:-1]))
    long = ends - starts >= LENGTH
    if not long.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    numbers = np.full(n, _LAST)
    numbers[: n - GRAM + 1] = np.clip(hasher.numbers(n - GRAM + 1, GRAM), _U64(1), _LAST - _U64(1))
    least = _sliding(np.minimum, numbers, OFFSETS)
    # Only strings inside one text choose an anchor.
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - LENGTH + 1, -1)
    least[np.cumsum(change[:n]) == 0] = 0
    chosen = _sliding(np.maximum, least[::-1], OFFSETS)[::-1]
    places = np.flatnonzero(chosen == numbers)
    return places, numbers[places]


def _flanks(place, start, end, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that strings with their anchor ``low`` to ``high`` bytes in may cover."""
    return np.maximum(place - high, start), np.minimum(place + LENGTH - low, end)


def _text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + BLOCK, side="left"))
        last = min(max(last, first + 1), len(texts))
        yield first, content[bounds[first] : bounds[last]], bounds[first + 1 : last + 1] - bounds[first]
        first = last


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals of each document with overlapping and touching ones joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    number = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    reach = np.maximum.accumulate(stop + (number << 40)) - (number << 40)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


def _first_of(keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, new class, repeats): rows by class, document and place; ``repeats`` marks
    those that start later than the first of their class."""
    order = np.lexsort((place, doc, *keys[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for key in keys:
            ordered = key[order]
            new[1:] |= ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    doc, place = doc[order], place[order]
    return order, new, (doc != doc[first]) | (place != place[first])


ANCHORS = "key long, doc long, place long, stop long, context long, cores long, found boolean"


def _anchor_batch(parts: dict[str, np.ndarray], found: tuple) -> dict:
    """Rows of anchors (found is false) and of repeats that are settled already."""
    doc, start, stop = found
    n, m = len(parts["doc"]), len(doc)
    zeros = np.zeros(m, np.int64)
    return {
        "key": pa.array(np.concatenate((parts["key"].view(np.int64), mix(doc.view(np.uint64)).view(np.int64)))),
        "doc": pa.array(np.concatenate((parts["doc"], doc))),
        "place": pa.array(np.concatenate((parts["place"], start))),
        "stop": pa.array(np.concatenate((parts["stop"], stop))),
        "context": pa.array(np.concatenate((parts["context"].view(np.int64), zeros))),
        "cores": pa.array(np.concatenate((parts["cores"].view(np.int64), zeros))),
        "found": pa.array(np.concatenate((np.zeros(n, bool), np.ones(m, bool)))),
    }


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """Step 1, and step 2 as far as a batch knows."""

    def start() -> Callable:
        hasher = _Hasher()

        def work(batch: pa.RecordBatch) -> dict:
            docs = column(batch, "doc").to_numpy()
            made: dict[str, list[np.ndarray]] = {c: [] for c in ("key", "doc", "place", "low", "stop", "context", "cores")}
            for first, data, ends in _text_blocks(column(batch, "text")):
                if not len(data):
                    continue
                place, number = anchors(data, ends, hasher)
                of = np.searchsorted(ends, place, side="right")
                begin, end = ends[of] - np.diff(ends, prepend=0)[of], ends[of]
                low, high = _flanks(place, begin, end, 0, OFFSETS - 1)
                cores = np.zeros(len(place), np.uint64)
                for i, (a, b) in enumerate(_RANGES):
                    left, right = place - a, place + LENGTH - b
                    whole = (left >= begin) & (right <= end)
                    core = hasher.number(np.where(whole, left, 0), np.where(whole, right, 0)) >> _U64(56)
                    # A core that does not exist is marked as 0, all others as 1 to 255.
                    cores |= np.where(whole, np.maximum(core, _U64(1)), _U64(0)) << _U64(8 * i)
                made["key"].append(number)
                made["doc"].append(docs[first + of])
                made["place"].append(place - begin)
                made["low"].append(low - begin)
                made["stop"].append(high - begin)
                made["context"].append(mix(hasher.number(low, high) + (place - low).astype(np.uint64)))
                made["cores"].append(cores)
            kinds = {"key": np.uint64, "context": np.uint64, "cores": np.uint64}
            rows = {c: np.concatenate([np.zeros(0, kinds.get(c, np.int64)), *v]) for c, v in made.items()}
            order, new, repeats = _first_of([rows["key"], rows["context"]], rows["doc"], rows["place"])
            rows = {c: v[order] for c, v in rows.items()}
            found = _merged(*(rows[c][repeats] for c in ("doc", "low", "stop")))
            return _anchor_batch({c: v[new] for c, v in rows.items()}, found)

        return work

    return map_batches(texts, ANCHORS, start)


def _settle_contexts(rows: DataFrame) -> DataFrame:
    """Step 2 per anchor: repeats (doc, start, stop) and, with ``ranges`` not null, the
    places whose context goes on, with a bit for each range of offsets to look at."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "doc", "place", "stop", "context", "cores", "found")
        parts = [[column(b, c).to_numpy(zero_copy_only=False) for c in names] for b in batches if b.num_rows]
        if not parts:
            return
        rows = dict(zip(names, (np.concatenate(p) for p in zip(*parts))))
        done = rows["found"]
        ready = [rows[c][done] for c in ("doc", "place", "stop")]
        rows = {c: v[~done] for c, v in rows.items()}
        order, new, repeats = _first_of([rows["key"], rows["context"]], rows["doc"], rows["place"])
        rows = {c: v[order] for c, v in rows.items()}
        low = np.maximum(rows["place"] - (OFFSETS - 1), 0)
        again = [x[repeats] for x in (rows["doc"], low, rows["stop"])]
        merged = _merged(*(np.concatenate(p) for p in zip(ready, again)))
        firsts = {c: v[new] for c, v in rows.items() if c in ("key", "doc", "place", "cores")}
        ranges = _shared_cores(firsts["key"], firsts["cores"].view(np.uint64))
        onward = ranges > 0
        n, m = len(merged[0]), int(onward.sum())
        columns = [
            np.concatenate((merged[0], firsts["doc"][onward])),
            np.concatenate((merged[1], firsts["place"][onward])),
            np.concatenate((merged[2], np.zeros(m, np.int64))),
        ]
        settled = np.concatenate((np.ones(n, bool), np.zeros(m, bool)))
        bits = pa.array(np.concatenate((np.zeros(n, np.int32), ranges[onward])), mask=settled)
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), bits], ["doc", "start", "stop", "ranges"])

    return rows.mapInArrow(giving_back(run), "doc long, start long, stop long, ranges int")


def _shared_cores(key: np.ndarray, cores: np.ndarray) -> np.ndarray:
    """For each context the ranges whose core another context of the anchor has as well."""
    ranges = np.zeros(len(key), np.int32)
    together = np.zeros(len(key), bool)
    if len(key) > 1:
        same = key[1:] == key[:-1]
        together[1:] |= same
        together[:-1] |= same
    at = np.flatnonzero(together)
    key, cores = key[at].view(np.uint64), cores[at]
    for i in range(PARTS):
        core = (cores >> _U64(8 * i)) & _U64(255)
        pair = mix(key + core)
        order = np.argsort(pair)
        same = pair[order][1:] == pair[order][:-1]
        twice = np.zeros(len(pair), bool)
        twice[1:] |= same
        twice[:-1] |= same
        shared = np.zeros(len(pair), bool)
        shared[order] = twice
        ranges[at] |= (shared & (core > 0)).astype(np.int32) << i
    return ranges


STRINGS_OF = "core long, ahead long, behind long, sizes int, doc long, start long"


def _strings(places: DataFrame) -> DataFrame:
    """Step 3: the strings of (doc, text, places) as ``STRINGS_OF``: the number of the core, the
    bytes ahead of and behind the ``CORE`` bytes all have, how many these are (16 times the
    first, and the second), and where the string is."""

    def start() -> Callable:
        hasher = _Hasher()

        def work(batch: pa.RecordBatch) -> dict:
            docs = column(batch, "doc").to_numpy()
            listed = column(batch, "places")
            upto = np.concatenate(([0], np.cumsum(listed.value_lengths().to_numpy())))
            listed = listed.flatten()
            starts, ranges = (listed.field(c).to_numpy() for c in ("start", "ranges"))
            made: dict[str, list[np.ndarray]] = {c: [] for c in ("core", "ahead", "behind", "sizes", "doc", "start")}
            for first, data, ends in _text_blocks(column(batch, "text")):
                own = slice(upto[first], upto[first + len(ends)])
                of = np.repeat(np.arange(len(ends)), np.diff(upto[first : first + len(ends) + 1]))
                begin, end = (ends - np.diff(ends, prepend=0))[of], ends[of]
                place, bits = starts[own] + begin, ranges[own]
                hasher.load(data)
                # The bytes from each place on, or up to it, as one long.
                edge = np.zeros(SLACK, np.uint8)
                longs = np.lib.stride_tricks.sliding_window_view(np.concatenate((edge, data, edge)), SLACK)
                for i, (a, b) in enumerate(_RANGES):
                    chosen = np.flatnonzero((bits >> i) & 1)
                    at = place[chosen]
                    low, high = _flanks(at, begin[chosen], end[chosen], a, b)
                    inner = at - a
                    left, right = inner - low, high - inner - CORE
                    made["core"].append((hasher.number(inner, at + LENGTH - b) + _U64(i)).view(np.int64))
                    made["ahead"].append(longs[inner].view(np.int64).ravel() & _LAST_BYTES[left])
                    made["behind"].append(longs[inner + CORE + SLACK].view(np.int64).ravel() & _FIRST_BYTES[right])
                    made["sizes"].append((left * 16 + right).astype(np.int32))
                    made["doc"].append(docs[first + of[chosen]])
                    made["start"].append(low - begin[chosen])
            return {c: pa.array(np.concatenate(v)) for c, v in made.items()}

        return work

    return map_batches(places, STRINGS_OF, start)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of ``text`` (which ends in a symbol of its own) in order, by doubling.

    Only suffixes that are tied so far are sorted again.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << _U64(8)) | padded[i : i + n]
    order = np.argsort(key)
    ordered = key[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    at, known = _tied(new), 8
    while len(at):
        suffixes = order[at]
        base = rank[suffixes]
        key = (base << 32) + rank[np.minimum(suffixes + known, n)] + 1
        again = np.argsort(key, kind="stable")
        suffixes, key = suffixes[again], key[again]
        order[at] = suffixes
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[suffixes] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        at, known = at[_tied(fresh)], known * 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Where a value equals the one before or after it."""
    return np.flatnonzero(~(new & np.append(new[1:], True)))


def merge_transforms(transforms: list[np.ndarray], passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes whose first ``passes`` symbols (an even number) occur at least twice, in
    order of these, and their blocks.

    Suffixes are numbered through the shards, each in its own order. A pass takes the
    suffixes in the order so far and hands each one's extension by the two symbols
    ahead of it to their bucket; within a shard that is the transform's last-to-first
    mapping, twice. Extensions stay in one block if symbols and former block are the
    same. Once a suffix is alone in its block its extensions are as well, so it is
    settled and drops out, as do those that reach the end of their string.
    """
    back, offset = [], 0
    for transform in transforms:
        order = np.argsort(transform, kind="stable")
        mapping = np.empty(len(order), np.int32)
        mapping[order] = np.arange(offset, offset + len(order), dtype=np.int32)
        back.append(mapping)
        offset += len(order)
    symbols, back = np.concatenate(transforms), np.concatenate(back)
    outer = symbols[back]
    pairs = (outer.astype(np.uint16) << 8) | symbols
    inside = (symbols >= SHIFT) & (outer >= SHIFT)
    back = back[back]
    live = np.arange(offset, dtype=np.int32)
    block = np.zeros(offset, np.int32)
    for _ in range(0, passes, 2):
        within = inside[live]
        live, block = live[within], block[within]
        ahead = pairs[live]
        order = np.argsort(ahead, kind="stable")
        ahead, block = ahead[order], block[order]
        new = np.empty(len(live) + 1, bool)
        new[0] = new[-1] = True
        np.not_equal(ahead[1:], ahead[:-1], out=new[1:-1])
        new[1:-1] |= block[1:] != block[:-1]
        tied = ~(new[:-1] & new[1:])
        live = back[live[order[tied]]]
        block = np.cumsum(new[:-1], dtype=np.int32)[tied]
        if not len(live):
            break
    return live, block


class _Symbols:
    """Strings as symbols: bytes, digits of the core's rank, bytes, and what lies between strings."""

    def __init__(self, rank: np.ndarray, ahead: np.ndarray, behind: np.ndarray, sizes: np.ndarray) -> None:
        cores, digits = int(rank.max()) + 1, 2
        while DIGITS**digits < cores:
            digits += 2
        self.width = SLACK + digits  # symbols that stand for ``LENGTH`` bytes
        left, right = sizes[:, None] >> 4, sizes[:, None] & 15
        number = rank[:, None] // DIGITS ** np.arange(digits) % DIGITS + DIGIT
        between = np.full((len(rank), 1), BETWEEN)
        bytes_of = [x[:, None].view(np.uint8) + np.uint8(SHIFT) for x in (ahead, behind)]
        parts = (bytes_of[0], number, bytes_of[1], between)
        self._table = np.concatenate([x.astype(np.uint8) for x in parts], axis=1)
        every = np.ones((len(rank), 1), bool)
        there = (_PLACE >= SLACK - left, np.broadcast_to(every, number.shape), _PLACE < right, every)
        self._there = np.concatenate(there, axis=1)

    def of(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of some strings, one after the other, and how many each has."""
        there = self._there[strings]
        return self._table[strings][there], there.sum(axis=1)


def _places_of(sizes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, offset) of each of ``sizes`` things that lie one after the other."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(owner, sizes), np.arange(int(sizes.sum())) - np.repeat(first, sizes)


def equal_strings(strings: _Symbols, rows: np.ndarray, shard_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, class) of all substrings of ``LENGTH`` bytes that occur at least twice in ``rows``."""
    transforms, owners, offsets = [], [], []
    for shard in np.unique(shard_of):
        own = rows[shard_of == shard]
        text, sizes = strings.of(own)
        text[-1] = END
        owner, offset = _places_of(sizes, own)
        order = suffix_array(text)
        transforms.append(text[order - 1])
        owners.append(owner[order])
        offsets.append(offset[order])
    merged, block = merge_transforms(transforms, strings.width)
    return np.concatenate(owners)[merged], np.concatenate(offsets)[merged], block


def _numbered_strings(strings: _Symbols, rows: np.ndarray, _: None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``equal_strings`` for any number of strings, by the numbers of their substrings."""
    hasher = _Hasher()
    text, sizes = strings.of(rows)
    first = np.cumsum(sizes) - sizes
    number_of, offset = _places_of(sizes - strings.width, np.arange(len(rows)))
    hasher.load(text)
    at = first[number_of] + offset
    _, number, count = np.unique(hasher.number(at, at + strings.width), return_inverse=True, return_counts=True)
    twice = count[number] > 1
    return rows[number_of[twice]], offset[twice], number[twice]


def _settle_strings(rows: DataFrame) -> DataFrame:
    """Step 4: repeats (doc, start, stop) among the strings, which come in order of their core."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            yield _interval_batch(_chunk_repeats(rows))

    return rows.mapInArrow(giving_back(run), "doc long, start long, stop long")


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows with about ``BATCH`` symbols of strings and whole cores."""
    waiting: list[pa.RecordBatch] = []
    size, each = 0, 3 * SLACK
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            # About as many rows as fit, then on to the end of the core.
            part = batch.slice(at, max(1, (BATCH - size) // each + 1))
            at += part.num_rows
            waiting.append(part)
            size += part.num_rows * each
            if size >= BATCH:
                table = pa.Table.from_batches(waiting)
                core = table["core"].to_numpy()
                cut = int(np.searchsorted(core, core[-1]))
                if cut:
                    yield table.slice(0, cut)
                waiting = table.slice(cut).to_batches()
                size = (table.num_rows - cut) * each if cut else 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _chunk_repeats(rows: pa.Table) -> list[tuple]:
    core, ahead, behind, sizes, doc, start = (rows[c].to_numpy() for c in rows.column_names)
    lengths = (sizes >> 4) + CORE + (sizes & 15)
    number = mix(mix(ahead.view(np.uint64) + sizes.astype(np.uint64) * _U64(STEP)) + behind.view(np.uint64))
    order, new, later = _first_of([core, number], doc, start)
    again = order[later]
    found = [_merged(doc[again], start[again], start[again] + lengths[again])]
    # The earliest of each class of equal strings, where a core has several.
    first = order[new]
    begins = np.flatnonzero(np.concatenate(([True], core[first][1:] != core[first][:-1])))
    counts = np.diff(np.append(begins, len(first)))
    place = np.arange(len(first)) - np.repeat(begins, counts)
    count = np.repeat(counts, counts)
    together = (count > 1) & (count <= STRINGS)
    parts = [(first[together], place[together] % SHARDS, equal_strings)]
    for begin, n in zip(begins[counts > STRINGS], counts[counts > STRINGS]):
        parts.append((first[begin : begin + n], None, _numbered_strings))
    rank = np.cumsum(np.concatenate(([0], core[1:] != core[:-1])))
    for own, shard, compare in parts:
        if len(own):
            # Cores that are compared are numbered without gaps.
            _, dense = np.unique(rank[own], return_inverse=True)
            symbols = _Symbols(dense, ahead[own], behind[own], sizes[own])
            owner, offset, same = compare(symbols, np.arange(len(own)), shard)
            docs, places = doc[own][owner], start[own][owner] + offset
            order, _, later = _first_of([same], docs, places)
            docs, places = docs[order][later], places[order][later]
            found.append(_merged(docs, places, places + LENGTH))
    return found


def _interval_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "start", "stop"])


def repeated_spans(texts: DataFrame, total: int) -> DataFrame:
    """(doc, start, stop) of all repeats in (doc, text), overlaps not yet joined.

    Rows that share ``doc`` are copies. ``total`` is the bytes of text.
    """
    spark = texts.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES + 1)
    settled = materialise(_settle_contexts(_anchor_rows(texts).repartition(partitions, "key")))
    onward = settled.filter("ranges IS NOT NULL")
    places = materialise(
        onward.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "ranges"))).alias("places"))
    )
    needed = in_table(texts, "doc", bit_table(places, "doc"))
    strings = _strings(needed.join(places, "doc"))
    in_order = strings.repartition(partitions, "core").sortWithinPartitions("core")
    return settled.filter("ranges IS NULL").drop("ranges").unionByName(_settle_strings(in_order))


def _numbered(documents: DataFrame, doc: str, text: str) -> tuple[DataFrame, int]:
    """``documents`` with ``_doc``, in order of doc_id and equal only for copies; the bytes of text.

    That is doc_id itself, unless different texts share one or have none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = documents.withColumn("_doc", F.coalesce(F.col(doc).cast("long"), F.lit(NO_ID)))
    named = F.col(doc).cast("long").isNotNull()
    sizes = keyed.select("_doc", F.xxhash64(body, named).alias("hash"), F.octet_length(body).alias("size"))
    per_id = sizes.groupBy("_doc").agg(
        F.sum("size").alias("size"), (F.min("hash") != F.max("hash")).alias("differ")
    )
    total, differ = per_id.agg(F.sum("size"), F.max("differ")).first()
    if not differ:
        return keyed, total or 0
    keyed = keyed.withColumn("_named", named).withColumn("_hash", F.xxhash64(body))
    key = ["_named", "_doc", "_hash"]
    # Numbers that rise through the partitions of a sorted table.
    ranks = keyed.select(*key).distinct().orderBy(*key).withColumn("_rank", F.monotonically_increasing_id())
    numbered = keyed.join(materialise(ranks), key).drop(*key).withColumnRenamed("_rank", "_doc")
    return materialise(numbered), total or 0


def remove_repeats(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", characters: bool = False
) -> DataFrame:
    """``documents`` with ``n_bytes``, ``spans`` and ``kept``: what is removed of each and what is left.

    ``spans`` are the maximal removed runs (start, stop), ``kept`` the remaining bytes,
    which may cut a character in two. With ``characters`` the runs are widened to whole
    characters, so that ``kept`` is text again. Columns of these names are replaced.
    """
    keyed, total = _numbered(documents, doc, text)
    texts = keyed.select(F.col("_doc").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = materialise(
        repeated_spans(texts, total)
        .groupBy(F.col("doc").alias("_doc"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_found"))
    )
    table = bit_table(spans, "_doc")
    # Only documents that have repeats are dealt out anew.
    cut = in_table(keyed, "_doc", table).join(spans, "_doc", "left")
    whole = in_table(keyed, "_doc", table, inside=False)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    made = (
        StructType()
        .add("n_bytes", LongType())
        .add("spans", ArrayType(StructType().add("start", LongType()).add("stop", LongType())))
        .add("kept", BinaryType())
    )

    def start() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            sizes, runs, kept = [], [], []
            for body, found in zip(column(batch, text).to_pylist(), column(batch, "_found").to_pylist()):
                data = (body or "").encode()
                joined = _joined_spans(found or [])
                if characters:
                    joined = _joined_spans(_whole_characters(data, joined))
                ends = [0, *(s["stop"] for s in joined)]
                starts = [*(s["start"] for s in joined), len(data)]
                sizes.append(len(data))
                runs.append(joined)
                kept.append(b"".join(data[a:b] for a, b in zip(ends, starts)))
            return {
                "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array(runs, kind),
                "kept": pa.array(kept, pa.binary()),
            }

        return work

    # The others are whole, which takes no Python.
    body = F.coalesce(F.col(text), F.lit(""))
    plain = {
        "n_bytes": F.octet_length(body).cast("long"),
        "spans": F.array().cast(made["spans"].dataType),
        "kept": body.cast("binary"),
    }
    others = [F.col(f"`{c}`") for c in whole.columns if c.lower() not in plain and c != "_doc"]
    whole = whole.select(*others, *(made_of.alias(c) for c, made_of in plain.items()))
    return add_columns(cut, made, start).drop("_doc", "_found").unionByName(whole)


def _joined_spans(spans: list[dict]) -> list[dict]:
    joined: list[dict] = []
    for span in spans:
        if joined and span["start"] <= joined[-1]["stop"]:
            joined[-1]["stop"] = max(joined[-1]["stop"], span["stop"])
        else:
            joined.append(dict(span))
    return joined


def _whole_characters(data: bytes, spans: list[dict]) -> list[dict]:
    """The spans with all bytes of the characters that they begin or end in."""

    def inside(at: int) -> bool:
        return at < len(data) and data[at] & 0xC0 == 0x80

    wider = []
    for span in spans:
        start, stop = span["start"], span["stop"]
        while inside(start):
            start -= 1
        while inside(stop):
            stop += 1
        wider.append({"start": start, "stop": stop})
    return wider
