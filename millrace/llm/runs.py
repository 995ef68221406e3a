"""Periodic runs of words, by the branching-tandem test on enhanced suffix arrays.

A task takes the words of about two megabytes of documents at once. Prefix doubling gives
the rank of every suffix within its document and, of each level ``k``, numbers that are
equal where the ``2 ** k`` words from two places on agree. Suffix array, its inverse and the
LCP array come from these; the LCP intervals are read off the array by the nearest smaller
values to both sides, without tree nodes. In each interval of depth ``d`` the suffixes of all
child intervals but the largest are tested: where the suffix ``d`` words on (or back) lies in
the interval, but not in the same child, a square of period ``d`` begins that the word after
it breaks. Such a square is the last rotation of its run, so rotating it to the left, in
steps of falling powers of two on the doubling levels, gives the whole run. Squares of a
multiple of the period rotate into the same run and are merged with it.

A suffix is in a smaller child at most log(n) times, so a document of n words costs
O(n log n) however periodic it is. Documents are worked on by themselves, so no key is hot;
one document is the smallest unit, and a task needs about 400 bytes for each word of it.

Defined results: a null text has no words; a text without words has no runs and collapses to
the empty text. Repeated rows give equal rows. An empty table gives an empty result; other
columns are ignored. Words are told apart by 64-bit hashes within a document, by case, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import NONBLANK, pieces, raw, split_words, string_array

MIN_LENGTH = 12
HOPS = 32  # pointer jumps before the few places left are found by range minima
BLOCK = 1 << 20  # suffixes tested at once

RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

# Everything but blanks, with upper and lower case told apart.
CASED = np.where(NONBLANK > 0, np.arange(1, 257), 0).astype(np.uint16)

Order = Callable[[int, int], np.ndarray | None]


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a sorted array: where values begin, and for each place where its value began."""
    new = np.append(True, key[1:] != key[:-1])
    return new, np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))


def _levels(words: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first word, the first two, four and so on, until all suffixes differ.

    A place past the end has the rank -1, which equals no other.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][doc]
    key = (doc << 32) | np.unique(words, return_inverse=True)[1]
    who = np.argsort(key, kind="stable")
    new, first = _groups(key[who])
    rank = np.full(n + 1, -1, np.int32)
    rank[who] = first
    levels, step = [rank], 1
    who = who[~(new & np.append(new[1:], True))]
    while len(who):
        after = who + step
        second = np.where(after < end[who], rank[np.minimum(after, n)], -1)
        key = (rank[who].astype(np.int64) << 32) | (second + 1)
        order = np.argsort(key, kind="stable")
        who, key = who[order], key[order]
        old = rank[who]
        new, first = _groups(key)
        rank = rank.copy()
        rank[who] = old + (first - _groups(old)[1])
        levels.append(rank)
        step *= 2
        who = who[~(new & np.append(new[1:], True))]
    return levels


def _common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of each suffix with the one before it in the array; 0 at both ends."""
    lcp = np.zeros(len(sa) + 1, np.int32)
    at = np.flatnonzero(levels[0][sa[:-1]] == levels[0][sa[1:]])
    x, y = sa[at].astype(np.int64), sa[at + 1].astype(np.int64)
    begin = x.copy()
    for k in reversed(range(len(levels))):
        step = (levels[k][x] == levels[k][y]).astype(np.int64) << k
        x += step
        y += step
    lcp[at + 1] = x - begin
    return lcp


def _next_not_larger(values: np.ndarray) -> np.ndarray:
    """For each positive value the next place to the right that isn't larger; 0 ends the array."""
    n = len(values)
    to = np.arange(1, n + 1)
    left = np.flatnonzero(values > 0)
    for _ in range(HOPS):
        left = left[values[to[left]] > values[left]]
        if not len(left):
            return to
        to[left] = to[to[left]]
    mins = [values]
    while 2 << (len(mins) - 1) <= n:
        half = 1 << (len(mins) - 1)
        mins.append(np.minimum(mins[-1][:-half], mins[-1][half:]))
    at = to[left]
    for k in reversed(range(len(mins))):
        inside = np.minimum(at, len(mins[k]) - 1)
        at += ((at < len(mins[k])) & (mins[k][inside] > values[left])).astype(np.int64) << k
    to[left] = at
    return to


def _chain_ends(to: np.ndarray) -> np.ndarray:
    """Where the pointers lead in the end; a place that points to itself is an end."""
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def branching_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that the next word breaks."""
    isa = levels[-1].astype(np.int64)
    n = len(isa) - 1
    sa = np.empty(n, np.int64)
    sa[isa[:n]] = np.arange(n)
    lcp = _common_prefixes(sa, levels)
    after = _next_not_larger(lcp)
    before = n - _next_not_larger(lcp[::-1])[::-1]
    own = np.arange(n + 1)
    cuts = np.flatnonzero(lcp > 0)  # between two children of an interval
    if not len(cuts):
        return cuts, cuts
    first, last = own.copy(), own.copy()
    first[cuts] = np.where(lcp[before[cuts]] == lcp[cuts], before[cuts], cuts)
    last[cuts] = np.where(lcp[after[cuts]] == lcp[cuts], after[cuts], cuts)
    first, last = _chain_ends(first), _chain_ends(last)
    heads = cuts[first[cuts] == cuts]  # one cut for each interval; the child before it is the leftmost
    rep = np.concatenate([first[cuts], heads])
    start = np.concatenate([cuts, before[heads]])
    stop = np.concatenate([after[cuts], heads])
    size = stop - start
    largest = np.zeros(n + 1, np.int64)
    np.maximum.at(largest, rep, size)
    spared = np.zeros(n + 1, np.int64)  # one child of the greatest size
    full = np.flatnonzero(size == largest[rep])
    spared[rep[full]] = full
    small = np.flatnonzero(spared[rep] != np.arange(len(rep)))
    rep, start, stop, size = rep[small], start[small], stop[small], size[small]
    low, high, depth = before[rep], after[last[rep]], lcp[rep].astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")), at + 1)
        child = np.repeat(np.arange(at, to), size[at:to])
        within = np.arange(len(child)) - np.repeat(np.cumsum(size[at:to]) - size[at:to], size[at:to])
        place = sa[start[child] + within]
        for sign in (1, -1):
            other = place + sign * depth[child]
            rank = isa[np.clip(other, -1, n)]  # -1 is the place past the end
            hit = (rank >= low[child]) & (rank < high[child]) & ((rank < start[child]) | (rank >= stop[child]))
            found.append((np.minimum(place, other)[hit], depth[child][hit]))
        at = to
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, smallest period) of all runs, by start and period; starts count from the first text.

    ``words`` are the words' numbers, those of text ``i`` at ``bounds[i]:bounds[i + 1]``.
    """
    if len(words) < 2:
        return np.zeros((0, 3), np.int64)
    levels = _levels(words, bounds)
    start, period = branching_squares(levels)
    end = start + 2 * period
    begin = bounds[np.searchsorted(bounds, start, "right") - 1]
    for k in reversed(range(len(levels))):  # rotate to the left
        back = start - (1 << k)
        same = (back >= begin) & (levels[k][np.maximum(back, 0)] == levels[k][np.maximum(back, 0) + period])
        start = np.where(same, back, start)
    keep = end - start >= min_length
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else keep[:0]
    found = np.stack([start, end - start, period], axis=1)[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _find(batches: Iterator[pa.RecordBatch], order: Order | None, min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for low, piece in pieces(string_array(batch.column(1))):
            found = split_words(piece, CASED)
            bounds = found.bounds
            source: dict[int, np.ndarray] = {}
            place = np.arange(len(found.hashes))
            for i in range(len(piece)):
                n = int(bounds[i + 1] - bounds[i])
                own = order(ids[low + i], n) if order and n else None
                if own is not None:
                    source[i] = own
                    place[bounds[i] : bounds[i + 1]] = bounds[i] + own
            runs = runs_of(found.hashes[place], bounds, min_length)
            doc = np.searchsorted(bounds, runs[:, 0], "right") - 1
            runs[:, 0] -= bounds[doc]
            cuts = np.searchsorted(doc, np.arange(len(piece) + 1))
            data, offsets = raw(piece)
            listed, collapsed = [], []
            for i in range(len(piece)):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                own = runs[cuts[i] : cuts[i + 1]]
                if i in source:
                    words = [words[k] for k in source[i]]
                if len(own):
                    dropped = np.zeros(len(words) + 1, np.int64)
                    np.add.at(dropped, own[:, 0] + own[:, 2], 1)
                    np.add.at(dropped, own[:, 0] + own[:, 1], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
                collapsed.append(b" ".join(words))
                listed.append([{"start": s, "length": m, "period": p} for s, m, p in own.tolist()])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[low : low + len(piece)], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(listed, pa.list_(_RUN)),
                    pa.array(collapsed, pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    order: Order | None = None,
) -> DataFrame:
    """Per row: doc_id, n_words, the runs by start and period, and the text without their repetitions.

    A run is a longest stretch of at least ``min_length`` words and two periods in which words
    one period apart are the same. ``collapsed`` leaves out what any run holds after its first
    period and joins the other words by spaces. ``order`` may rearrange the words of a text
    first: it gets the id and the number of words and returns the place each word is taken from,
    or None.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(partial(_find, order=order, min_length=min_length), RUNS_SCHEMA)
