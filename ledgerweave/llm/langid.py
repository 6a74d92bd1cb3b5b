"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three letters, with word
edges) in order of frequency. A document is given the language whose profile has the
least out-of-place distance: the sum, over the document's own most frequent n-grams,
of how far each is from its place in the language's profile, ``PROFILE`` where the
profile lacks it.

Counting runs over whole texts in blocks of code points; a block's n-grams are numbers,
sorted once. Profiles are ``PROFILE`` rows per language, which is all that ever
reaches the driver.

Nulls and texts without a letter get ``und`` with score 0, as do all texts if nothing
was learned. Rows without text or language are not learned from. Equally frequent
n-grams are ordered by length and code points, equal distances by language name, so
neither row order nor blocks matter. Columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import add_columns, column, map_batches

PROFILE = 500  # n-grams of a language
OWN = 400  # n-grams of a document
BLOCK = 1 << 20  # code points counted at once
UNKNOWN = "und"
CODE_POINTS = 0x110000
BITS = 21  # of a code point
EDGE = 1  # a word edge in an n-gram; letters are their code point + 2, 0 is no letter


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(CODE_POINTS)), bool, CODE_POINTS)


def _blocks(texts: list[str], groups: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    block: list[str] = []
    of: list[int] = []
    size = 0
    for text, group in zip(texts, groups):
        block.append(text)
        of.append(group)
        size += len(text)
        if size >= BLOCK:
            yield block, of
            block, of, size = [], [], 0
    if block:
        yield block, of


def count_grams(
    texts: list[str], groups: list[int], is_letter: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, n-gram, count) of each block of texts, ordered by group and n-gram.

    An n-gram packs up to three symbols of ``BITS`` bits each. A text is never cut,
    so a group that is a single text is counted whole.
    """
    waiting = list(_blocks(texts, groups))[::-1]
    while waiting:
        block, of = waiting.pop()
        joined = "\n".join(t.lower().replace("\n", " ") for t in block)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        inside = is_letter[points]
        # Words with one edge between them: keep letters and what follows a letter.
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        number = np.cumsum(points == 10)[kept]
        symbols = np.where(inside, points + 2, EDGE)[kept]
        if not len(symbols):
            continue
        # A small alphabet makes n-grams short numbers; it keeps the order of code points.
        seen = np.zeros(CODE_POINTS + 2, bool)
        seen[symbols] = True
        alphabet = np.concatenate(([0], np.flatnonzero(seen)))
        if alphabet[1:2] != EDGE:
            alphabet = np.insert(alphabet, 1, EDGE)
        place = np.zeros(CODE_POINTS + 2, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        c, base = place[symbols], len(alphabet)
        if len(block) > 1 and base**3 * (max(of) + 1) >= 1 << 62:
            half = len(block) // 2  # so many scripts that n-grams would not fit a number
            waiting += [(block[half:], of[half:]), (block[:half], of[:half])]
            continue
        # The symbol ahead of a text's first letter is an edge as well.
        before = np.concatenate(([1], c[:-1]))
        before[np.flatnonzero(np.diff(number, prepend=-1))] = 1
        after = np.concatenate((c[1:], [1]))
        after[np.flatnonzero(np.diff(number, append=number[-1] + 1))] = 1
        letter = c > 1
        of_text = np.asarray(of, np.int64)[number] * base**3
        c, before, after, of_text = c[letter], before[letter], after[letter], of_text[letter]
        first = before == 1
        keys = np.concatenate(
            (
                of_text + c,
                of_text + c * base + after,
                (of_text + base + c)[first],
                of_text + (before * base + c) * base + after,
            )
        )
        keys.sort()
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(starts, len(keys)))
        keys = keys[starts]
        group, gram = np.divmod(keys, base**3)
        high, low = np.divmod(gram, base)
        top, middle = np.divmod(high, base)
        packed = (alphabet[top] << (2 * BITS)) | (alphabet[middle] << BITS) | alphabet[low]
        yield group, packed, counts


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The profiles (lang, gram, place) of the languages in ``labelled``."""

    def start() -> Callable:
        is_letter = letters()

        def work(batch: pa.RecordBatch) -> dict:
            langs = column(batch, lang).dictionary_encode()
            groups = langs.indices.to_pylist()
            parts = list(count_grams(column(batch, text).to_pylist(), groups, is_letter))
            if not parts:
                return {
                    "lang": pa.array([], pa.string()),
                    "gram": pa.array([], pa.int64()),
                    "n": pa.array([], pa.int64()),
                }
            of, gram, n = (np.concatenate(x) for x in zip(*parts))
            return {
                "lang": langs.dictionary.take(pa.array(of)),
                "gram": pa.array(gram.astype(np.int64)),
                "n": pa.array(n.astype(np.int64)),
            }

        return work

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    text, lang = "text", "lang"
    counts = map_batches(rows, "lang string, gram long, n long", start)
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order) - 1)
        .filter(F.col("place") < PROFILE)
        .select("lang", "gram", "place")
    )


def _places(model: list[tuple[str, int, int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, known n-grams in order, and the place of each n-gram in each language."""
    langs = sorted({lang for lang, _, _ in model})
    grams = np.unique(np.array([gram for _, gram, _ in model], np.int64))
    places = np.full((len(grams), len(langs)), -1, np.int64)
    for lang, gram, place in model:
        places[np.searchsorted(grams, gram), langs.index(lang)] = place
    return langs, grams, places


def predict(
    df: DataFrame, profiles: DataFrame, text: str = "text", into: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``df`` with the language of each text and a score from 0 (nothing fits) to 1."""
    langs, grams, places = _places([tuple(row) for row in profiles.select("lang", "gram", "place").collect()])
    made = StructType().add(into, StringType()).add(score, DoubleType())

    def start() -> Callable:
        is_letter = letters()

        def work(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in column(batch, text).to_pylist()]
            found: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            if langs:
                for of, gram, n in count_grams(texts, list(range(len(texts))), is_letter):
                    rows, best, fit = _nearest(of, gram, n)
                    scores[rows] = fit
                    for row, k in zip(rows.tolist(), best.tolist()):
                        found[row] = langs[k]
            return {into: pa.array(found, pa.string()), score: pa.array(scores)}

        return work

    def _nearest(of: np.ndarray, gram: np.ndarray, n: np.ndarray) -> tuple:
        order = np.lexsort((gram, -n, of))
        of, gram = of[order], gram[order]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        rank = np.arange(len(of)) - np.repeat(firsts, np.diff(np.append(firsts, len(of))))
        own = rank < OWN
        of, gram, rank = of[own], gram[own], rank[own]
        firsts = np.flatnonzero(np.diff(of, prepend=-1))
        at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
        there = np.where((grams[at] == gram)[:, None], places[at], -1)
        apart = np.where(there >= 0, np.abs(there - rank[:, None]), PROFILE)
        total = np.add.reduceat(apart, firsts, axis=0)
        best = total.argmin(axis=1)
        size = np.diff(np.append(firsts, len(of)))
        return of[firsts], best, 1 - total.min(axis=1) / (size * PROFILE)

    return add_columns(df, made, start)
