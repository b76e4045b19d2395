"""Periodic runs of words, by a dictionary of basic factors.

Words are numbered, and every stretch of 2^k words gets a name, such that equal
stretches have equal names: a name of level k + 1 stands for a pair of names of
level k. Occurrences of one factor within twice its length form arithmetic
progressions, so the distance to a factor's next occurrence proposes a period.
Places with the same distance one after another are one progression; it is
extended word by word as far as the period holds, and equal results are one
run. Factors that occur once are left out of the higher levels, so ordinary
text costs a few levels only. Many texts are handled at once, with a word
between them that occurs nowhere else.

A run has a smallest period q, at least ``min_words`` words and ``min_repeats``
periods, and no neighbouring word extends it. Why none is missed: a factor at
least as long as q occurs in a run at every q-th place and nowhere between, and
with three periods a factor of q to 2q words has its next occurrence inside
the run, for each place of the run at which both fit.

Defined results
* Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte; a null text has none.
* Runs are sorted by start, then period; several may overlap.
* ``collapsed``: the words, joined by one space, without those that a run
  contains after its first period. A text without words gives the empty string.
* Rows that repeat each other give equal results. An empty table gives no rows.
* Other columns are carried along; those named like an added column are replaced.
* Texts are taken whole. A task holds one slice of them (4 MB, or one longer text).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, slices, with_fields

SLICE_BYTES, CHUNK = 4 << 20, 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")
RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")]), False)


class Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a chunk at a time. ``bytes.split`` splits at the six blanks."""
    start = 0
    while start < len(text):
        stop = start + CHUNK
        cut = BLANK.search(text, stop) if stop < len(text) else None
        stop = cut.start() if cut else len(text)
        yield text[start:stop].split()
        start = stop


def number_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All words as numbers, with a number of its own after each text; where
    each text starts (and the last one's end); the words by number."""
    numbers, parts, starts = Numbers(), [], [0]
    for i, text in enumerate(texts):
        size = 0
        for words in _words(text or b""):
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            size += len(words)
        parts.append(np.array([-1 - i]))
        starts.append(starts[-1] + size + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(starts), list(numbers)


def basic_factors(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per power of two: the places, in order, whose factor of that length occurs again, and the factors' names."""
    length, places, names = 1, np.arange(len(words)), words
    named = np.full(len(words), -1, np.int64)
    while len(places):
        names, _ = pd.factorize(names)
        again = np.bincount(names)[names] > 1
        places, names = places[again], names[again].astype(np.int64)
        yield length, places, names
        # the factor of twice the length is the pair of this one and the one that follows it
        named[places] = names
        fits = places + length < len(words)
        places, names = places[fits], names[fits]
        follows = named[places + length]
        both = follows >= 0
        named[:] = -1
        places, names = places[both], (names[both] << 32) | follows[both]
        length *= 2


def proposals(words: np.ndarray, min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, end and period of each progression of next occurrences."""
    least = 1 << (max(1, 2 * min_words // 3).bit_length() - 1)  # shorter factors aren't needed to see a run of min_words
    for length, places, names in basic_factors(words):
        if length < least:
            continue
        order = np.argsort(names, kind="stable")
        gap = np.diff(places[order])
        near = (np.diff(names[order]) == 0) & (gap <= length)
        if length > least:
            near &= gap > length // 2  # shorter periods were seen a level below
        at, gap = places[order[:-1]][near], gap[near]
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(gap, prepend=-1) != 0))
        if len(new):
            last = np.append(new[1:], len(at)) - 1
            yield at[new], at[last] + gap[new] + length, gap[new]


def extend(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch, as far as its period holds on both sides."""
    start, end = start.copy(), end.copy()
    moving = np.arange(len(start))
    while len(moving):
        before = np.maximum(start[moving] - 1, 0)
        moving = moving[(start[moving] > 0) & (words[before] == words[before + period[moving]])]
        start[moving] -= 1
    moving = np.arange(len(end))
    while len(moving):
        after = np.minimum(end[moving], len(words) - 1)
        moving = moving[(end[moving] < len(words)) & (words[after] == words[after - period[moving]])]
        end[moving] += 1
    return start, end


def find(words: np.ndarray, min_words: int, min_repeats: int) -> np.ndarray:
    """All runs as rows of start, length and period, sorted."""
    found = [np.zeros((0, 3), np.int64)]
    for start, end, period in proposals(words, min_words):
        start, end = extend(words, start, end, period)
        length = end - start
        enough = length >= np.maximum(min_words, min_repeats * period)
        found.append(np.column_stack([start, length, period])[enough])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: np.ndarray, kept: np.ndarray, vocabulary: list[bytes]) -> bytes:
    return b" ".join(map(vocabulary.__getitem__, words[kept].tolist()))


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = 24, min_repeats: int = 3) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``."""
    if min_words < 1 or min_repeats < 3:
        raise ValueError("runs need at least one word and three periods")
    src = docs.drop(*[c for c in ("n_words", "runs", "collapsed") if c != text_col])
    schema = with_fields(src, ("n_words", T.LongType()), ("runs", RUNS), ("collapsed", T.StringType()))
    item = pa.struct([pa.field(x, pa.int64(), False) for x in ("start", "length", "period")])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                words, starts, vocabulary = number_words(part.column(text_col).cast(pa.binary()).to_pylist())
                runs = find(words, min_words, min_repeats)
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
                np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(edges[:-1]) == 0
                text = np.searchsorted(starts, runs[:, 0], side="right") - 1
                values = pa.StructArray.from_arrays([pa.array(runs[:, 0] - starts[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(item))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(starts))).astype(np.int32)), values)
                lists = lists.cast(pa.list_(pa.field("element", item, False)))
                texts = [_collapsed(words[a:b - 1], kept[a:b - 1], vocabulary) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(starts) - 1), lists, pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of those that tie. Null if there is none."""
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which each tenth text, by the CRC-32 of its id, repeats a
    stretch from some word to its end. Rows without an id stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    held = fresh(docs, "words")
    g, n = F.floor(h / 10), F.size(held)
    a = (g % n).cast("int")
    left = n - a
    p = (1 + F.floor(left / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(held, a + 1, p), F.ceil(left / p).cast("int")))
    text = F.array_join(F.concat(F.slice(held, F.lit(1), a), F.slice(again, F.lit(1), left)), " ")
    return (docs.withColumn(held, F.when(h % 10 == 0, words))
            .withColumn(text_col, F.when(F.size(held) > 0, text).otherwise(F.col(text_col))).drop(held))
