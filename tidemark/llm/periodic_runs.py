"""Periodic runs of words by a sparse diagonal DP over lags.

A word that equals the one ``q`` words before lies on diagonal ``q``; a run of period ``q`` is a stretch of
that diagonal without a gap. Following every earlier occurrence of a word would take quadratic time on a
text that repeats one word, so lags are followed by size: for lags from ``g/2`` (exclusive) to ``g`` an
occurrence is one of the word together with the ``g - 1`` that follow, and only the latest earlier one
counts. That loses nothing. A run of at least four periods ``q <= g`` holds such places, and at each the latest
earlier occurrence within the run lies exactly ``q`` words back: a nearer one would give the run two periods,
hence a smaller one. Nor does a place before or after the run have it, as a neighbouring word differs there. So
the match length of the active lag grows by one at each word while the lag stays the same, and when it changes the
diagonal has ended and is a run, if it is long enough. Only repeated occurrences are taken to the next size, which
ends the search early in plain text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, slices, span_hashes, texts, words

#: What counts as a run: words at least, and periods at least. Four periods are what the search by size rests on.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = "array<struct<start: long, length: long, period: long>>"


class Runs(NamedTuple):
    """Runs of several sequences laid end to end, by start, then period."""

    starts: np.ndarray
    lengths: np.ndarray
    periods: np.ndarray


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different key, and whether it occurs more than once."""
    _, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return number, counts[number] > 1


def _earlier(number: np.ndarray) -> np.ndarray:
    """The index of the latest earlier entry with the same number; -1 without one."""
    order = np.argsort(number, kind="stable")
    same = number[order][1:] == number[order][:-1]
    before = np.full(len(number), -1, np.int64)
    before[order[1:][same]] = order[:-1][same]
    return before


def find_runs(keys: np.ndarray, least_words: int = LEAST_WORDS) -> Runs:
    """The runs of a sequence of symbols (64-bit values).

    A run is a stretch with smallest period ``q`` of ``max(least_words, 4 * q)`` symbols at least that no
    neighbour extends. Sequences laid end to end stay apart if they share no symbol.
    """
    n = len(keys)
    number, repeated = _numbered(keys)
    places = np.flatnonzero(repeated)
    number = number[places]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 1
    while len(places):
        before = _earlier(number)
        lag = np.where(before >= 0, places - places[before], 0)
        lag[(lag <= size // 2) | (lag > size)] = 0
        # The active lag goes on while neighbouring words have the same one.
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (lag[1:] != lag[:-1])
        first = np.flatnonzero(new)
        matched = np.diff(np.append(first, len(places)))
        period = lag[first]
        length = matched + size - 1 + period
        good = (period > 0) & (length >= np.maximum(least_words, LEAST_PERIODS * period))
        if good.any():
            found.append((places[first][good] - period[good], length[good], period[good]))
        if LEAST_PERIODS * size > n:
            break
        # The occurrences of the next size: this one followed, after as many words, by that one.
        at = np.searchsorted(places, places + size)
        both = (at < len(places)) & (places[np.minimum(at, len(places) - 1)] == places + size)
        left, right = number[both], number[at[both]]
        places = places[both]
        number, repeated = _numbered(left * (int(number.max()) + 1) + right)
        places, number = places[repeated], number[repeated]
        size *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none)
    starts, lengths, periods = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((periods, starts))
    return Runs(starts[order], lengths[order], periods[order])


def _kept(n: int, runs: Runs) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs.starts + runs.periods, 1)
    np.add.at(cover, runs.starts + runs.lengths, -1)
    return np.cumsum(cover[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """The given words joined by one space, for each of ``n`` rows."""
    sizes = ends - starts + 1
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    source = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
    source[bounds[1:] - 1] = 0  # the place of the space
    out = data[source] if len(data) else np.zeros(0, np.uint8)
    out[bounds[1:] - 1] = 0x20
    last = np.searchsorted(rows, np.arange(n), "right")
    first = np.searchsorted(rows, np.arange(n), "left")
    begin, end = bounds[first], np.where(last > first, bounds[last] - 1, bounds[first])
    raw = out.tobytes()
    return pa.array([raw[a:b].decode() for a, b in zip(begin.tolist(), end.tolist())], pa.string())


def _in_arrow(keep: list[str], text: str, least_words: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            at, n = batch.schema.get_field_index(text), batch.num_rows
            t = texts(batch.column(at))
            w = words(t)
            keys = span_hashes(t.data, w.starts, w.ends)
            runs = find_runs(mix(keys + w.rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), least_words)
            stay = _kept(len(keys), runs)
            first = np.searchsorted(w.rows, np.arange(n + 1))
            row = w.rows[runs.starts] if len(runs.starts) else np.zeros(0, np.int64)
            fields = [pa.array(x, pa.int64()) for x in (runs.starts - first[row], runs.lengths, runs.periods)]
            spans = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), spans)
            left = _joined(t.data, w.starts[stay], w.ends[stay], w.rows[stay], n)
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(first), pa.int64()), listed, left], names)

    return run


def periodic_runs(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least_words: int = LEAST_WORDS
) -> DataFrame:
    """The columns ``keep``, ``n_words``, ``runs`` and ``collapsed`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists (start, length, period) of every run, by
    start, then period: stretches with smallest period ``q`` and at least ``max(least_words, 4 * q)`` words that
    no neighbouring word extends. ``collapsed`` holds the words that no run contains after its first ``q``
    ones, joined by one space.

    Whole texts, one pass, no shuffle; repeated rows are treated alike, and equal keys do not meet. A NULL or empty
    text has no words, no runs and an empty ``collapsed``. Columns not in ``keep`` are left out, whatever their names;
    an empty table gives no rows.
    """
    held = [f"_keep_{i}" for i in range(len(keep))]
    slim = df.select(*(F.col(k).alias(h) for k, h in zip(keep, held)), F.col(text).alias("_text"))
    kinds = ", ".join(f"{h} {df.schema[k].dataType.simpleString()}" for k, h in zip(keep, held))
    schema = f"{kinds}{', ' if kinds else ''}n_words long, runs {RUN}, collapsed string"
    found = map_arrow(slim, _in_arrow(held, "_text", least_words, [*held, "n_words", "runs", "collapsed"]), schema)
    return found.withColumnsRenamed(dict(zip(held, keep)))
