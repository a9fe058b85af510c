"""Runs of repeated words, by a dictionary of basic factors.

A run is a stretch of words with smallest period q, of length max(6, 4 q) at
least, that no neighbouring word extends keeping that period.

The dictionary names the factors of length 1, 2, 4, ...: two places have the
same name at a level if the same words follow. Names of a level are ranks of
pairs of names of the level below. The successor of a place is the next one of
its name. A factor of length L that comes again q words on, L/2 < q <= L, and
next there and next again, stands in an arithmetic progression of places, which
proposes the period q. Since q <= L the factor of a run with smallest period q
recurs first q words on at each place of the run where factor and successor
fit, and at no place beside it: a longest stretch of places s..e whose
successors are all q words on is extended by the factor and the period to the
words s .. e + L - 1 + q, and these are all runs, each found at one level, once.
(If the smallest period were less than q, successors would be nearer.) A run of
four periods holds q + 1 such places, so none is missed.

A level keeps only places whose name comes twice; words of texts without
repeats fall out at the first levels. Each text ends in a mark of its own, so
texts of a batch are worked on together and no run crosses from one to another.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; repeated rows are worked on each; texts of any length are worked
on whole, memory following the longest; an empty table gives no rows. Other
columns come back as they are; a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hopscope.llm.arrow_words import pieces, word_codes

MIN_LENGTH = 6
MIN_PERIODS = 4

RUN = "array<struct<start: long, length: long, period: long>>"


def _names(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of (pair, place), and whether each begins a new pair."""
    order = np.argsort(pairs, kind="stable")
    ranked = pairs[order]
    return order, np.append(True, ranked[1:] != ranked[:-1])[: len(order)]


def runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of a sequence of
    codes >= 0; codes that are negative and all different end texts."""
    found = []
    n = len(codes)
    at = np.flatnonzero(codes >= 0)  # places of this level, in order
    name = codes[at].astype(np.int64)
    size = 1
    while len(at):
        order, new = _names(name)
        rank = np.cumsum(new) - 1
        place = at[order]
        after = np.zeros(len(order), np.int64)  # words from a place to its successor
        after[:-1] = np.where(new[1:], 0, place[1:] - place[:-1])
        # Stretches of neighbouring places with one distance in (size / 2, size].
        step = np.zeros(n, np.int64)
        step[place] = np.where((2 * after > size) & (after <= size), after, 0)
        edge = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
        span, period = np.diff(np.append(edge, n)), step[edge]
        length = span + size - 1 + period
        good = (period > 0) & (length >= np.maximum(min_length, min_periods * period))
        found.append(np.stack([edge[good], length[good], period[good]], axis=1))
        # The next level: places whose name comes twice and whose second half is named.
        twice = np.zeros(len(order), bool)
        twice[:-1] |= ~new[1:]
        twice[1:] |= ~new[1:]
        held = np.full(n + size, -1, np.int64)
        held[place[twice]] = rank[twice]
        keep = np.flatnonzero((held[:n] >= 0) & (held[size:] >= 0))
        name = held[keep] * (rank[-1] + 1) + held[keep + size]
        at = keep
        size *= 2
    made = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return made[np.lexsort((made[:, 2], made[:, 0]))]


def dropped(n: int, found: np.ndarray) -> np.ndarray:
    """Whether each of n words is in a run after that run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:n]) > 0


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, and n_words, runs (by start, then period) and
    collapsed: the words that are in no run after its first period, joined by one
    space."""
    made = ("n_words", "runs", "collapsed")
    others = [c for c in docs.columns if c != text and c not in made]
    slim = docs.select(*others, text)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, len(others)):
                codes, begin, held = word_codes(piece.column(len(others)))
                count = np.diff(begin)
                ends = begin[1:] + np.arange(len(count))  # of texts, one mark behind each
                line = np.empty(len(codes) + len(count), np.int64)
                line[ends] = -1 - np.arange(len(count))
                word = np.ones(len(line), bool)
                word[ends] = False
                line[word] = codes
                found = runs(line)
                kept = ~dropped(len(line), found) & word
                starts = begin[:-1] + np.arange(len(count))
                of = np.searchsorted(found[:, 0], np.append(starts, len(line)))
                cells = [found[:, k] - (np.repeat(starts, np.diff(of)) if k == 0 else 0) for k in range(3)]
                structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cells], ["start", "length", "period"])
                words = held.take(pa.array(line[kept]))
                texts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[np.append(starts, len(line))], pa.int32()), words)
                columns = [pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(of, pa.int32()), structs).cast(run_type), pc.binary_join(texts, " ")]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *columns], [*others, *made])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(run, f"{kept}{', ' if kept else ''}n_words long, runs {RUN}, collapsed string")
