"""Periodic runs in the word sequences of documents, by multi-scale minimizers.

A run is a stretch of words with smallest period q and length of at least ``max(LEAST, 2 q)`` that cannot grow on
either side and keep period q. Inside a run, whatever is chosen by content alone repeats q words later. So at the scale
of periods q in [2k, 4k), the window minima of hashed k-word shingles repeat at distance q: pairs of equal
minimizers at such distances seed runs, and each seed is extended as far as words q apart are equal.

Shingles that have a period of at most k/2 themselves lie in a run of an earlier scale. They are no minimizers, so
equal minimizers lie more than k/2 apart and each has few partners. A run whose first period holds no other
shingles lies across two neighbouring runs of one smaller period, the first of which ends where the second begins: the
places one period before that end are the seeds there. Periods below ``2 * SHINGLE`` are scanned lag by lag.

All documents of an Arrow batch are one sequence of numbers for this, in which no word of a document equals one of
another. Nothing is shuffled: a document is read by one task, in memory that grows as n log n with its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, coded, mixed, python_ready, text_of

# Words of the shortest run, and of the shingles at the lowest scale (a power of two, not below the shortest run).
LEAST = 12
SHINGLE = 16
# Words of the documents read in one go; a longer document is read alone.
GO_WORDS = 150_000

_WORDS = re.compile(WORD)
_NONE = np.zeros((0, 3), np.int64)


def doubled_names(first: np.ndarray) -> list[np.ndarray]:
    """Names of the stretches of 1, 2, 4, .. words at each place: equal, and not negative, where the words are equal.

    Stretches that occur once have negative names that nothing else has, and are not looked at again. The list ends with
    the longest stretches that repeat. ``first`` ends with a name that occurs once.
    """
    n = len(first)
    once = -1 - np.arange(n, dtype=np.int64)
    names, width = [], 1
    at = np.flatnonzero(np.bincount(first)[first] > 1)
    named = first[at]
    while len(at):
        level = once.copy()
        level[at] = named
        names.append(level)
        at = at[(level[np.minimum(at + width, n - 1)] >= 0) & (at + width < n)]
        both = level[at] * n + level[at + width]
        code, _ = pd.factorize(both)
        again = np.bincount(code, minlength=1)[code] > 1 if len(code) else np.zeros(0, bool)
        at, named, width = at[again], code[again], 2 * width
    return names


def _ahead(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and from ``j`` on are equal."""
    n, i, j = len(names[0]), i.copy(), j.copy()
    start = i.copy()
    for t in range(len(names) - 1, -1, -1):
        inside = j < n
        step = inside & (names[t][np.where(inside, i, 0)] == names[t][np.where(inside, j, 0)]) & (i != j)
        i += step << t
        j += step << t
    return i - start


def _back(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before ``i`` and before ``j`` are equal."""
    i, j = i.copy(), j.copy()
    start = i.copy()
    for t in range(len(names) - 1, -1, -1):
        a, b = i - (1 << t), j - (1 << t)
        inside = a >= 0
        step = inside & (names[t][np.where(inside, a, 0)] == names[t][np.where(inside, b, 0)]) & (i != j)
        i -= step << t
        j -= step << t
    return start - i


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` values that follow each other."""
    out, have = x, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    more = width - have
    if more:
        out = pick(out[:-more], out[more:]) if len(out) > more else out[:0]
    return out


def minimizers(names: np.ndarray, usable: np.ndarray, width: int) -> np.ndarray:
    """Places whose hashed name is the least of some window of ``width`` places; equal ones of a window all count."""
    far = np.uint64(0xFFFFFFFFFFFFFFFF)
    rank = np.where(usable, mixed(names.astype(np.uint64)) >> np.uint64(1), far)
    if len(rank) < width:
        return np.zeros(0, np.int64)
    least = _sliding(rank, width, np.minimum)
    # The greatest of the window minima that a place takes part in is its own rank if it is the least of one.
    edge = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(usable & (best == rank))


def lag_scan(words: np.ndarray, lag: int, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, lag) of the longest stretches with period ``lag`` and at least ``max(least, 2 lag)`` words."""
    if len(words) <= lag:
        return _NONE
    equal = np.zeros(len(words) - lag + 2, np.int8)
    equal[1:-1] = words[:-lag] == words[lag:]
    turn = np.flatnonzero(np.diff(equal))
    start, end = turn[::2], turn[1::2] + lag
    long = end - start >= max(least, 2 * lag)
    return np.column_stack([start[long], end[long], np.full(int(long.sum()), lag)])


def _inside(runs: np.ndarray, width: int, n: int) -> np.ndarray:
    """Places whose next ``width`` words lie in one of the runs."""
    edge = np.zeros(n + 1, np.int64)
    fits = runs[runs[:, 1] - runs[:, 0] >= width]
    np.add.at(edge, fits[:, 0], 1)
    np.add.at(edge, fits[:, 1] - width + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _minimizer_seeds(names: np.ndarray, periodic: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, period) of equal minimizers 2k to 4k - 1 words apart."""
    chosen = minimizers(names, (names >= 0) & ~periodic, k + 1)
    order = np.lexsort([chosen, names[chosen]])
    at, name = chosen[order], names[chosen[order]]
    seeds, periods = [], []
    for step in range(1, 9):  # equal ones lie more than k/2 apart, so less than 8 are within reach
        if len(at) <= step:
            break
        gap = at[step:] - at[:-step]
        pair = (name[step:] == name[:-step]) & (gap >= 2 * k) & (gap < 4 * k)
        seeds.append(at[:-step][pair])
        periods.append(gap[pair])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *seeds]), np.concatenate([none, *periods])


def _border_seeds(runs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, period) across neighbouring runs of one period, the second beginning within a period of the first's end."""
    order = np.lexsort([runs[:, 0], runs[:, 2]])
    runs = runs[order]
    first, second = runs[:-1], runs[1:]
    shared = first[:, 1] - second[:, 0]
    near = (first[:, 2] == second[:, 2]) & (shared >= 0) & (shared < first[:, 2])
    first, second = first[near], second[near]
    most = np.minimum(np.minimum(first[:, 1] - first[:, 0], second[:, 1] - second[:, 0]), 4 * k - 1)
    count = np.maximum(most - 2 * k + 1, 0)
    period = 2 * k + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first[:, 1], count) - period, period


def find_runs(words: np.ndarray, least: int = LEAST, shingle: int = SHINGLE) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and then period.

    ``words``: numbers from 0, the last of which occurs nowhere else. ``shingle``: a power of two, ``least`` at least.
    """
    runs = _with(_NONE, np.concatenate([lag_scan(words[:-1], lag, least) for lag in range(1, 2 * shingle)]))
    names, n = doubled_names(words), len(words)
    for t in range(shingle.bit_length() - 1, len(names)):
        k = 1 << t
        small = runs[2 * runs[:, 2] <= k]
        places, periods = _minimizer_seeds(names[t], _inside(small, k, n), k)
        if len(small) > 1:
            more = _border_seeds(small, k)
            places, periods = np.concatenate([places, more[0]]), np.concatenate([periods, more[1]])
        if not len(places):
            continue
        start = places - _back(names, places, places + periods)
        end = places + periods + _ahead(names, places, places + periods)
        found = np.column_stack([start, end, periods])[end - start >= 2 * periods]
        runs = _with(runs, found)
    return runs[np.lexsort([runs[:, 2], runs[:, 0]])]


def _with(runs: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Both, with the smallest period of each stretch: a stretch found again has a multiple of its period."""
    if not len(found):
        return runs
    every = np.concatenate([runs, found])
    every = every[np.lexsort([every[:, 2], every[:, 1], every[:, 0]])]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    return every[new]


def _numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, no number in two texts, each text followed by a number of its own; and where each text begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = [w for words in texts for w in words]
    code, distinct = coded(flat)
    text = np.repeat(np.arange(len(texts)), sizes)
    own, _ = pd.factorize(text * max(len(distinct), 1) + code)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.empty(int(begin[-1]), np.int64)
    stops = begin[1:] - 1
    here = np.ones(len(words), bool)
    here[stops] = False
    words[here] = own
    words[stops] = int(own.max(initial=-1)) + 1 + np.arange(len(texts))
    return words, begin


def _goes(texts: list[list[str]]) -> Iterator[list[list[str]]]:
    held, size = [], 0
    for words in texts:
        if held and size + len(words) > GO_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _describe(texts: list[list[str]]) -> Iterator[tuple[np.ndarray, str]]:
    """Runs of each text, its places counted from 0, and its words without the repetitions."""
    words, begin = _numbered(texts)
    runs = find_runs(words) if len(words) > 1 else _NONE
    repeated = np.zeros(len(words) + 1, np.int64)
    np.add.at(repeated, runs[:, 0] + runs[:, 2], 1)
    np.add.at(repeated, runs[:, 1], -1)
    keep = (np.cumsum(repeated[:-1]) == 0).tolist()
    cuts = np.searchsorted(runs[:, 0], begin)
    for k, own in enumerate(texts):
        mine = runs[cuts[k] : cuts[k + 1]]
        yield mine - [begin[k], begin[k], 0], " ".join(compress(own, keep[begin[k] : begin[k + 1] - 1]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [_WORDS.findall(t) for t in b.column("text").to_pylist()]
        got = [one for go in _goes(texts) for one in _describe(go)]
        every = np.concatenate([_NONE, *[runs for runs, _ in got]])
        offsets = np.concatenate([[0], np.cumsum([len(runs) for runs, _ in got])])
        spans = pa.StructArray.from_arrays(
            [pa.array(every[:, 0]), pa.array(every[:, 1] - every[:, 0]), pa.array(every[:, 2])], ["start", "length", "period"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array([text for _, text in got], pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start and period) and collapsed text of every row.

    Places are word numbers from 0. ``collapsed``: the words that lie in no run after its first period, joined by
    single spaces. All runs are found.

    A null or empty text has no words, no runs and an empty collapsed text. A null doc_id stays null; rows of equal ids
    and repeated rows are read each. Whole texts of any length are read. An empty table gives no rows. Other columns
    are not read.
    """
    python_ready(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return given.mapInArrow(
        _scan, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
