"""Periodic runs of words, found by following diagonals, and texts with each run cut down to its first period.

A text is read from left to right. A word that stands ``q`` words after an equal one continues the
diagonal of lag ``q``; a diagonal that ends after enough matches gives out a run at once: as many
words as it had matches, and the ``q`` before them.

Which earlier occurrences of a word need a look? A run of period ``q`` has max(24 - q, 2 q) matches
in a row or more. So its words are told apart together with the WIDTH words before them, WIDTH
being a power of two over ``q`` and at most that many. Of such a stretch only the *latest* earlier
occurrence counts: were it nearer than ``q`` inside a run of period ``q``, the run would have a
smaller period (two periods of a stretch as long as both have their common divisor for a period).
The same says that a lag found this way is the smallest period of its run. So each word has at
most one active lag per width, and the work grows as n log n with the words of a text, whatever it
repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmood.llm import blocks as B

#: Words and periods that a run has at least.
SHORTEST, PERIODS = 24, 3
#: Matches in a row that every run has, a power of two.
WIDTH = 16

_STEP = np.uint64(0x9E3779B97F4A7C15)

RUNS = "runs array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of the 2 * width words up to each place, from those of width words; no meaning before that many words."""
    out = names.copy()
    out[width:] = B.mixed(names[:-width] * _STEP + names[width:])
    return out


def _in_a_row(flags: np.ndarray) -> np.ndarray:
    """How many places up to each one are set without a gap."""
    at = np.arange(len(flags))
    return at - np.maximum.accumulate(np.where(flags, -1, at))


def _again(names: np.ndarray) -> np.ndarray:
    """Which of the names occur twice or more."""
    ordered = np.sort(names)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(twice, names), len(twice) - 1)
    return twice[at] == names


def _lags(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place of ``at``, ascending, how far back the latest place of the same name is; 0 for none."""
    own = names[at]
    order = np.argsort(own, kind="stable")
    same = own[order[1:]] == own[order[:-1]]
    out = np.zeros(len(at), "int64")
    out[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
    return out


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs of texts, ordered by start and period.

    ``words`` names the words of all texts in turn, ``first`` is the place of each text's first
    word (and the last's end). No run crosses texts.
    """
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    names = B.mixed(words + B.mixed(text.astype("uint64") * _STEP))
    width = 1
    while width < WIDTH:
        names, width = _doubled(names, width), 2 * width
    whole = np.arange(len(words)) - np.repeat(first[:-1], counts) >= WIDTH - 1
    repeated = np.zeros(len(words), bool)
    repeated[whole] = _again(names[whole])
    row = _in_a_row(repeated)
    at, lowest, found = np.flatnonzero(repeated), 1, []
    while len(at):
        lag = _lags(names, at)
        active = (lag >= lowest) & (lag < width)
        place, period = at[active], lag[active]
        if len(place):
            begins = np.ones(len(place), bool)
            begins[1:] = (place[1:] != place[:-1] + 1) | (period[1:] != period[:-1])
            begins = np.flatnonzero(begins)
            ends = np.append(begins[1:], len(place)) - 1
            period = period[begins]
            length = ends - begins + width + period  # width - 1 matches more than stretches, and the first period
            long = length >= np.maximum(SHORTEST, PERIODS * period)
            found.append(np.stack([place[ends] - length + 1, length, period])[:, long])
        names, lowest, width = _doubled(names, width), width, 2 * width
        at = np.flatnonzero(row > width - WIDTH)
        at = at[counts[text[at]] >= PERIODS * lowest]
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), "int64")
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _kept(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Places that no run contains after its first period."""
    edges = np.zeros(n + 1, "int64")
    np.add.at(edges, starts + periods, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    """The words from starts to ends, those of each of n texts joined by one space."""
    sizes = ends - starts + 1
    out = B.gathered(np.append(data, np.uint8(32)), starts, sizes)
    closes = np.cumsum(sizes)
    out[closes - 1] = 32
    bounds = np.append(0, closes)[np.searchsorted(text, np.arange(n + 1))]
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1  # no space after a text's last word
    out = np.delete(out, last)
    bounds -= np.append(0, np.cumsum(bounds[1:] > bounds[:-1]))
    offsets = pa.py_buffer(bounds.astype("int64"))
    return pa.Array.from_buffers(pa.large_string(), n, [None, offsets, pa.py_buffer(out.tobytes())]).cast(pa.string())


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) per row.

    A run is a stretch of consecutive words, numbered from 0, with smallest period ``q`` that is
    max(SHORTEST, PERIODS * q) words long or longer and that no neighbouring word extends. ``runs``
    are all of them by start and period. ``collapsed`` is the text without the words that lie in
    any run after its first ``q`` words, the others joined by one space.

    One pass over the rows without a shuffle; a text is never cut. A NULL text and one without
    words have no runs and an empty ``collapsed``; an id may be NULL, of any type and on several
    rows; equal rows give equal results; other columns are ignored; an empty table gives no rows.
    Words are told apart by 64-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, bounds in B.blocks(batch, 1):
                starts, ends, first = B.words(data, bounds)
                names = B.mixed(B.stretch_hashes(B.prefix_hashes(data), starts, ends) + (ends - starts).astype("uint64"))
                start, length, period = find_runs(names, first)
                kept = _kept(len(starts), start, length, period)
                text = np.repeat(np.arange(own.num_rows), np.diff(first))
                of_run = np.searchsorted(start, first)
                inside = start - np.repeat(first[:-1], np.diff(of_run))
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (inside, length, period)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0),
                        pa.array(np.diff(first).astype("int64")),
                        pa.ListArray.from_arrays(pa.array(of_run.astype("int32")), runs),
                        _joined(data, starts[kept], ends[kept], text[kept], own.num_rows),
                    ],
                    names=[id_col, "n_words", "runs", "collapsed"],
                )

    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType)])
    for part in ("n_words long", RUNS, "collapsed string"):
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(part).fields])
    return df.select(id_col, F.col(text_col).alias("text_")).mapInArrow(run, schema)
