"""Words and word shingles of whole texts as 64-bit numbers, many texts at once.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A word's number is the sum of one
scattered number for each byte and its place in the word, read off one running sum over the
block, so that no pattern of bytes makes words collide; a shingle's number is a polynomial
over its few words. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5  # of a shingle
BLOCK = 1 << 19  # bytes handled at once
PLACES = 32  # bytes of a word with a table of their own; the numbers of later ones are scattered again
_U64 = np.uint64
STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse


def mix(x: np.ndarray) -> np.ndarray:
    """Numbers scattered over 64 bits, one to one."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """The powers of ``base`` up to ``n``, modulo 2^64."""
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class Shingler:
    """Tables for blocks of text; made once per task."""

    def __init__(self) -> None:
        codes = np.arange(256, dtype=np.uint64)
        upper = (codes >= 65) & (codes <= 90)
        lower = np.where(upper, codes + _U64(32), codes)
        places = np.arange(PLACES, dtype=np.uint64)[:, None] * _U64(256)
        self._numbers = mix(mix(places + lower + _U64(1))).ravel()
        self._white = (codes == 32) | ((codes >= 9) & (codes <= 13))

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, and how many words each text has.

        ``data`` holds the bytes of the texts, ``ends`` where each text ends.
        """
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
        inside = ~self._white[data]
        cuts = ends[(ends > 0) & (ends < n)]
        before = np.concatenate(([False], inside[:-1]))
        before[cuts] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False]))
        after[cuts - 1] = False
        stops = np.flatnonzero(inside & ~after)
        begins = np.zeros(n, np.int32)
        begins[starts] = starts
        place = np.arange(n, dtype=np.int32) - np.maximum.accumulate(begins)
        scattered = self._numbers[((place & (PLACES - 1)) << 8) | data]
        late = np.flatnonzero(inside & (place >= PLACES))
        if len(late):
            turn = (place[late] // PLACES).astype(np.uint64)
            scattered[late] = mix(scattered[late] + turn * _U64(STEP))
        sums = np.cumsum(scattered)
        head = np.where(starts > 0, sums[starts - 1], _U64(0))
        numbers = mix(sums[stops] - head)
        upto = np.searchsorted(starts, ends)
        return numbers, np.diff(upto, prepend=0)

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, word numbers, words per text) of consecutive texts."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(bounds, bounds[first] + BLOCK, side="left"))
            last = min(max(last, first + 1), len(texts))
            ends = bounds[first + 1 : last + 1] - bounds[first]
            yield first, *self.words(content[bounds[first] : bounds[last]], ends)
            first = last


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """The number of the ``k`` words from each word on; the last ``k - 1`` have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * _U64(STEP) + words[i : i + n]
    return mix(total + _U64(k))


def shingles_of(words: np.ndarray) -> np.ndarray:
    """The shingle at each place of one text; of fewer than ``WORDS`` words, all as one."""
    return grams(words, min(WORDS, len(words))) if len(words) else np.zeros(0, np.uint64)


def as_multiset(numbers: np.ndarray) -> np.ndarray:
    """Numbers made distinct by how often each came before, so that sets count copies."""
    order = np.argsort(numbers, kind="stable")
    ordered = numbers[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, bool)
    at = np.arange(len(ordered))
    nth = at - np.maximum.accumulate(np.where(new, at, 0)) if len(ordered) else at
    made = np.empty_like(numbers)
    made[order] = np.where(nth > 0, mix(ordered + nth.astype(np.uint64)), ordered)
    return made
