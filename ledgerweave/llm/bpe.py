"""Byte-level BPE over a contiguous rank array, and its inverse.

A word is short, so its parts lie in one list and the ranks of adjacent parts in
another: the lowest rank is found by scanning, its boundary is deleted and the two
neighbouring ranks are looked up anew. That is quadratic in the length of a word, so
words longer than ``LONG_WORD`` bytes are merged over a heap, with equal results.

The vocabulary file is one of the ``tokenizers`` library; it stays where it is and
each task reads it. Nulls encode and decode like empty texts (no ids), repeated rows
are encoded each for itself, columns named like a result are replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .common import add_columns, column

# Fixed value: how byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = 128  # bytes; beyond, a heap replaces the scan
CACHED_WORDS = 250_000  # words a task remembers at least, twice as many at most
CACHED_LENGTH = 24  # characters; longer words seldom come again
NEVER = 1 << 60
ID_BITS = 24  # a merge is its rank above the id it makes


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {b: chr(b) for b in plain}
    for b in range(256):
        found.setdefault(b, chr(256 + len(found) - len(plain)))
    return [found[b] for b in range(256)]

_ID = (1 << ID_BITS) - 1


class Codec:
    """The vocabulary and merges of one file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}
        self.byte_ids = [vocabulary[c] for c in characters]
        self.merges = {
            (vocabulary[a], vocabulary[b]): (rank << ID_BITS) | vocabulary[a + b]
            for rank, (a, b) in enumerate(merges)
        }
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (max([*vocabulary.values(), *self.added.values()]) + 1)
        for token, number in vocabulary.items():
            self.pieces[number] = bytes(byte_of[c] for c in token)
        for token, number in self.added.items():
            self.pieces[number] = token.encode()
        self._words = regex.compile(WORDS)
        longest_first = sorted(self.added, key=len, reverse=True)
        self._added = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self._cache = _Cache(self.encode_word)

    def encode_word(self, word: str) -> tuple[int, ...]:
        parts = [self.byte_ids[b] for b in word.encode("utf-8")]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        merge = self.merges.get
        ranks = [merge(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == NEVER:
                break
            i = ranks.index(lowest)
            parts[i] = own = lowest & _ID
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = merge((parts[i - 1], own), NEVER)
            if i < len(ranks):
                ranks[i] = merge((own, parts[i + 1]), NEVER)
        return tuple(parts)

    def _merge_long(self, parts: list[int]) -> tuple[int, ...]:
        merges, n = self.merges, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [
            (merges[pair] >> ID_BITS, i, pair)
            for i, pair in enumerate(zip(parts, parts[1:]))
            if pair in merges
        ]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != pair[0] or parts[j] != pair[1]:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = merges[pair] & _ID, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    fresh = (parts[left], parts[after[left]])
                    if fresh in merges:
                        heapq.heappush(heap, (merges[fresh] >> ID_BITS, left, fresh))
        return tuple(p for p in parts if p >= 0)

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``; strings of added tokens become their ids."""
        word_ids = self._cache.__getitem__
        ids: list[int] = []
        at = 0
        for hit in self._added.finditer(text):
            ids.extend(chain.from_iterable(map(word_ids, self._words.findall(text[at : hit.start()]))))
            ids.append(self.added[hit.group()])
            at = hit.end()
        rest = text[at:] if at else text
        ids.extend(chain.from_iterable(map(word_ids, self._words.findall(rest))))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", errors="replace")


class _Cache(dict):
    """The ids of words met lately.

    When it is full it starts anew, keeping one older generation at hand, from which
    words that come again move over; so frequent words stay.
    """

    def __init__(self, encode: Callable[[str], tuple[int, ...]]) -> None:
        super().__init__()
        self._encode = encode
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self._older.get(word)
        if ids is None:
            ids = self._encode(word)
            if len(word) > CACHED_LENGTH:
                return ids
        if len(self) >= CACHED_WORDS:
            self._older = dict(self)
            self.clear()
        self[word] = ids
        return ids


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text``."""
    made = StructType().add(into, ArrayType(IntegerType(), containsNull=False))

    def start() -> Callable:
        known = Codec(path)

        def work(batch: pa.RecordBatch) -> dict:
            found = [known.encode(t or "") for t in column(batch, text).to_pylist()]
            starts = np.zeros(len(found) + 1, dtype=np.int64)
            np.cumsum([len(ids) for ids in found], out=starts[1:])
            flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(starts[-1]))
            return {into: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat))}

        return work

    return add_columns(df, made, start)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids in column ``ids``."""
    made = StructType().add(into, StringType())

    def start() -> Callable:
        known = Codec(path)

        def work(batch: pa.RecordBatch) -> dict:
            lists = column(batch, ids)
            values = lists.values.to_numpy()
            ends = lists.offsets.to_numpy()
            told = [known.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            return {into: pa.array(told, pa.string())}

        return work

    return add_columns(df, made, start)
