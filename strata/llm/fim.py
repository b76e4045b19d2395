"""Fill-in-middle transformation by displacement scatter.

A text is cut at two places into prefix, middle and suffix, and the parts are
written in another order behind sentinels, so that a model learns to fill in
the middle. A whole batch of texts is moved at once: cuts are found by a scan
over the batch's bytes, each part's displacement goes into a difference array,
its cumulative sum is the shift of every byte, and one numpy scatter writes
the outputs. ``restore`` does the inverse gather from output and form alone.
Bytes are handled in windows, so beside a batch's texts only a few MB are held.

Defined results
* Forms: ``plain`` (the text), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>``
  middle) and ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>`` middle).
* A null text is empty. Empty texts, and texts that hold a sentinel, are plain.
* Cuts are counted in code points; every text is taken whole.
* Rows that repeat each other get equal outputs. An empty table gives no rows.
* A null id draws as the empty string does. Other columns are carried along;
  those named like a column this module adds are replaced.
* ``restore`` gives null for an output that does not have its form's sentinels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, slices, with_fields

SLICE_BYTES, WINDOW = 4 << 20, 1 << 20
P, S, M = (np.frombuffer(x, np.uint8) for x in (b"<P>", b"<S>", b"<M>"))
FORMS = ["plain", "psm", "spm"]
PLAIN, PSM, SPM = range(3)


def draws(id_col: Column, seed: int = 1) -> Column:
    """Four unsigned 32-bit numbers per row: the first digit groups of the
    SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the place where each text starts (and the last one ends)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def _strings(data: np.ndarray, ends: np.ndarray, bad: np.ndarray | None = None) -> pa.Array:
    out = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
    return out if bad is None or not bad.any() else pc.if_else(pa.array(bad), pa.scalar(None, pa.string()), out)


def _windows(size: int) -> Iterator[tuple[int, int]]:
    return ((at, min(size, at + WINDOW)) for at in range(0, size, WINDOW))


def _starts(data: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Places in a window where a code point starts."""
    return np.flatnonzero((data[begin:end] & 0xC0) != 0x80)


def _code_points_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points before each of the sorted byte places."""
    out, seen, lo = np.empty(len(places), np.int64), 0, 0
    for begin, end in _windows(len(data)):
        starts, hi = _starts(data, begin, end), np.searchsorted(places, end)
        out[lo:hi] = seen + np.searchsorted(starts, places[lo:hi] - begin)
        seen, lo = seen + len(starts), hi
    out[lo:] = seen
    return out


def _places_of(data: np.ndarray, code_points: np.ndarray) -> np.ndarray:
    """Byte places of the sorted code point numbers; the one after the last is the end."""
    out, seen, lo = np.full(len(code_points), len(data), np.int64), 0, 0
    for begin, end in _windows(len(data)):
        starts = _starts(data, begin, end)
        hi = np.searchsorted(code_points, seen + len(starts))
        out[lo:hi] = begin + starts[code_points[lo:hi] - seen]
        seen, lo = seen + len(starts), hi
    return out


def _sentinels(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, text and letter of every sentinel that lies inside a text."""
    places = []
    for begin, end in _windows(len(data)):
        x = data[begin:end + 2]
        letter = x[1:-1]
        hit = (x[:-2] == ord("<")) & (x[2:] == ord(">")) & ((letter == ord("P")) | (letter == ord("S")) | (letter == ord("M")))
        places.append(begin + np.flatnonzero(hit))
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    text = np.searchsorted(ends, at, side="right") - 1
    inside = at + 3 <= ends[text + 1]
    return at[inside], text[inside], data[at[inside] + 1]


def _shifts(size: int, places: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """The place that each of ``size`` bytes moves to, window by window: part i
    starts at the sorted ``places[i]`` and moves by ``shifts[i]``."""
    steps, now, lo = np.diff(shifts, prepend=0), 0, 0
    for begin, end in _windows(size):
        hi = np.searchsorted(places, end)
        moved = np.zeros(end - begin, np.int64)
        np.add.at(moved, places[lo:hi] - begin, steps[lo:hi])  # empty parts share a place: their steps add up
        moved[0] += now
        np.cumsum(moved, out=moved)
        now, lo = int(moved[-1]), hi
        moved += np.arange(begin, end)
        yield begin, end, moved


def scatter(data: np.ndarray, ends: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and places of the outputs of all texts. ``cuts``: two byte places per text."""
    sources = np.column_stack([ends[:-1], cuts])  # prefix, middle, suffix
    sizes = np.diff(np.column_stack([sources, ends[1:]]), axis=1)
    moved = form != PLAIN
    out_ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1) + 9 * moved)])
    prefix, middle, suffix = sizes.T
    spm, at = form == SPM, out_ends[:-1]
    targets = np.column_stack([at + np.where(spm, 6 + suffix, 3), at + 9 + prefix + suffix, at + np.where(spm, 3, 6 + prefix)])
    targets = np.where(moved[:, None], targets, sources - ends[:-1, None] + at[:, None])
    out = np.empty(int(out_ends[-1]), np.uint8)
    for begin, end, to in _shifts(len(data), sources.ravel(), (targets - sources).ravel()):
        out[to] = data[begin:end]
    for mark, part in ((P, 0), (M, 1), (S, 2)):  # each sentinel stands right before its part
        out[(targets[moved, part] - 3)[:, None] + np.arange(3)] = mark
    return out, out_ends


def gather(data: np.ndarray, ends: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and places of the texts behind outputs, and which outputs are broken."""
    at, text, letter = _sentinels(data, ends)
    moved = form != PLAIN
    used = moved[text]
    found = np.full((len(form), 3), -1, np.int64)
    count = np.zeros((len(form), 3), np.int64)
    for k, mark in enumerate((P, S, M)):
        here = used & (letter == mark[1])
        found[text[here], k] = at[here]
        np.add.at(count[:, k], text[here], 1)
    p, s, m = found.T
    first, second = np.where(form == SPM, s, p), np.where(form == SPM, p, s)
    broken = moved & ~((count == 1).all(axis=1) & (first == ends[:-1]) & (second > first) & (m > second))
    moved &= ~broken
    start, stop = ends[:-1], ends[1:]
    # where prefix, middle and suffix stand in the output; a plain text is all prefix
    begin = np.where(moved[:, None], np.column_stack([p + 3, m + 3, s + 3]), np.column_stack([start, stop, stop]))
    end = np.where(moved[:, None], np.column_stack([np.where(form == SPM, m, s), stop, np.where(form == SPM, p, m)]), stop[:, None])
    sizes = end - begin
    places = np.concatenate([[0], np.cumsum(sizes.ravel())])
    out = np.empty(int(places[-1]), np.uint8)
    for lo, hi, of in _shifts(len(out), places[:-1], begin.ravel() - places[:-1]):
        out[lo:hi] = data[of]
    return out, places[::3], broken


def transform(docs: DataFrame, draws: Column, text_col: str = "text", fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``docs`` with ``n`` (code points), ``form``, ``prefix_chars``,
    ``middle_chars`` (null if plain) and ``output``. ``draws``: four unsigned
    numbers, for the two cuts, for plain or not and for the order."""
    src = docs.drop("n", "form", "prefix_chars", "middle_chars", "output") if text_col != "output" else docs
    drawn = fresh(src, "draws")
    src = src.withColumn(drawn, draws)
    schema = with_fields(src.drop(drawn), ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
                         ("middle_chars", T.LongType()), ("output", T.StringType()))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                data, ends = _texts(part.column(text_col))
                h = np.array(part.column(drawn).to_pylist(), np.int64).reshape(-1, 4)
                before = _code_points_before(data, ends)
                n = np.diff(before)
                pair = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                form = np.where(h[:, 3] % 100 < spm_percent, SPM, PSM)
                form[(n == 0) | (h[:, 2] % 100 >= fim_percent)] = PLAIN
                form[_sentinels(data, ends)[1]] = PLAIN
                cuts = _places_of(data, (before[:-1, None] + pair).ravel()).reshape(-1, 2)
                plain = form == PLAIN
                out = _strings(*scatter(data, ends, cuts, form))
                kept = [c for c, name in zip(part.columns, part.schema.names) if name != drawn]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n), pa.array([FORMS[f] for f in form], pa.string()), pa.array(pair[:, 0], mask=plain),
                     pa.array(pair[:, 1] - pair[:, 0], mask=plain), out], names=schema.names)

    return src.mapInArrow(run, schema)


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with ``restored``: the text, from output and form alone."""
    src = rows.drop("restored")
    schema = with_fields(src, ("restored", T.StringType()))

    def run(batches):
        codes = {name: i for i, name in enumerate(FORMS)}
        for batch in batches:
            for part in slices(batch, output_col, SLICE_BYTES):
                data, ends = _texts(part.column(output_col))
                form = np.array([codes.get(f, -1) for f in part.column(form_col).to_pylist()], np.int64)
                unknown = form < 0
                out, places, broken = gather(data, ends, np.where(unknown, PLAIN, form))
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(out, places, broken | unknown)], names=schema.names)

    return src.mapInArrow(run, schema)
