"""Cross-validated searches over random forests on many, mostly empty, features.

As ``forest_search``, one forest of the greatest number of trees and depth is grown for each training
set, and the other points are cut from it. Here the forests of all training sets grow side by side,
a level in a few passes over the rows, and a row costs by the features it has: a node's histograms
get the elements that are not zero, and zeros are what is left of the node's rows.

A tree is grown as Spark's are: splits by Gini impurity at 32 bins or fewer, whose bounds are Spark's
for the values of the training set (of all its rows, no sample), a random subset of features at each
node, rows drawn with replacement. Draws hang on the seed, tree, node and row alone, not on how the
rows are dealt to tasks; equal rows of one key are drawn together.

Rows are written once in blocks of one fold, as the bins of their elements by column. Tasks sum as
many histograms at once as ``CELLS`` allows and send them by tree; the best splits are found where
they are added, and the driver gets these alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import product
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators.fold_search import ALL, grouped_f1
from millrace.operators.softmax_search import slices

ROWS = 1024  # of a block
GRID = 1 << 24  # bins of a block as a full matrix, one row at least
CELLS = 12 << 20  # of the histograms that a task sums at once, those of a tree at least
PIECE = 1 << 17  # elements that meet the nodes at once, those of a feature at least
HELD = 1 << 20  # elements that a task takes at once, and counts of values that it adds up before it sends them
GROUP = 8 << 20  # bytes of blocks that are read at once
CHUNKS = 256  # of the columns whose bounds are found at once; near columns, of about as many values, are apart

_PARTS = {"fold": np.int32, "labels": np.int32, "draws": np.uint64, "columns": np.int32, "counts": np.int32, "rows": np.uint16, "bins": np.uint16}
_BLOCK = pa.schema([(name, pa.binary()) for name in _PARTS])
_VALUES = pa.schema([("chunk", pa.int32()), ("fold", pa.int32()), ("column", pa.int32()), ("value", pa.float64()), ("n", pa.int64())])
_BOUNDS = pa.schema([("column", pa.int32()), ("bound", pa.float64()), ("sets", pa.int64())])
_SUMS = pa.schema([("tree", pa.int32()), ("sums", pa.binary())])
_BEST = pa.schema([("tree", pa.int32()), ("best", pa.binary())])
_TOLD = pa.schema([("fold", pa.int32()), ("point", pa.int32()), ("label", pa.int32()), ("prediction", pa.int32()), ("n", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.binary(): "binary", pa.int32(): "int", pa.int64(): "long", pa.float64(): "double"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _elements(df: DataFrame, key: str, fold, seed: int) -> DataFrame:
    """(fold, label, draw, columns, values) of the rows that have all of them."""
    v = F.unwrap_udt("features")
    every = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    columns = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    draw = F.xxhash64(F.lit(seed), F.col(key), F.col("label"), v["indices"], v["values"])  # a key may be null or come twice
    rows = df.where(F.col("label").isNotNull() & F.col("features").isNotNull() & fold.isNotNull())
    return rows.select(
        fold.cast("int").alias("fold"), F.col("label").cast("int").alias("label"), draw.alias("draw"), columns.alias("columns"), v["values"].alias("values")
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return slices(batches, 3, HELD)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row, column and value of the elements that are not zero."""
    lists = batch.column(3)
    columns = lists.flatten().to_numpy().astype(np.int64)
    values = batch.column(4).flatten().to_numpy().astype(float)
    rows = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    has = values != 0
    return rows[has], columns[has], values[has]


def _sum_equal(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    order = np.lexsort(keys)
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    return [k[starts] for k in keys], np.add.reduceat(n, starts) if len(n) else n


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of a fold have a value in a column; column -1 has the rows."""
    held: list[tuple[list[np.ndarray], np.ndarray]] = []

    def sent() -> pa.RecordBatch:
        (value, column, fold), n = _sum_equal([np.concatenate(k) for k in zip(*(k for k, _ in held), strict=True)], np.concatenate([n for _, n in held]))
        parts = [np.where(column < 0, -1, column % CHUNKS).astype(np.int32), fold.astype(np.int32), column.astype(np.int32), value, n]
        return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], schema=_VALUES)

    for batch in _slices(batches):
        folds = batch.column(0).to_numpy().astype(np.int64)
        rows, columns, values = _flat(batch)
        known, code = np.unique(values, return_inverse=True)
        low, width = folds.min(initial=0), max(len(known), 1)
        span = columns.max(initial=0) + 1
        found, n = np.unique(((folds[rows] - low) * span + columns) * width + code, return_counts=True)
        held.append(([known[found % width] if len(known) else np.empty(0), found // width % span, found // width // span + low], n.astype(np.int64)))
        own, n = np.unique(folds, return_counts=True)
        held.append(([np.zeros(len(own)), np.full(len(own), -1), own], n.astype(np.int64)))
        if sum(len(n) for _, n in held) > HELD:
            yield sent()
            held = []
    if held:
        yield sent()


def _spark_bounds(values: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Bounds between the sorted values: all, or about as many rows between two of them."""
    between = (values[:-1] + values[1:]) / 2
    if len(between) < bins:
        return between
    stride, out, current = n.sum() / bins, [], int(n[0])
    target = stride
    for i in range(1, len(n)):
        before, current = current, current + int(n[i])
        if abs(before - target) < abs(current - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _bounds(table: pa.Table, sizes: dict[int, int], sets: list[int], bins: int) -> pa.Table:
    """The bounds of each column, with a bit for each training set that has them."""
    fold, column, value, n = (table[c].to_numpy() for c in ("fold", "column", "value", "n"))
    order = np.lexsort((value, column))
    fold, column, value, n = fold[order], column[order], value[order], n[order]
    out = []
    for at in np.split(np.arange(len(n)), np.flatnonzero(np.diff(column)) + 1) if len(n) else []:
        known, place = np.unique(value[at], return_inverse=True)
        bounds: dict[float, int] = {}
        for bit, left_out in enumerate(sets):
            own = fold[at] != left_out
            counts = np.bincount(place[own], n[at][own], len(known)).astype(np.int64)
            none = sum(size for f, size in sizes.items() if f != left_out) - counts.sum()
            with_zero, counts = (np.append(known, 0.0), np.append(counts, none)) if none > 0 else (known, counts)
            by = np.argsort(with_zero)
            by = by[counts[by] > 0]
            for b in _spark_bounds(with_zero[by], counts[by], bins).tolist():
                bounds[b] = bounds.get(b, 0) | 1 << bit
        out += [(int(column[at[0]]), b, bounds[b]) for b in sorted(bounds)]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_BOUNDS)], schema=_BOUNDS)


@dataclass
class _Bins:
    """The bounds of a column are those from ``starts`` on; a bin holds the values up to its bound."""

    starts: np.ndarray
    bounds: np.ndarray
    sets: np.ndarray  # a bit for each training set

    def of(self, columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.uint16)
        open_, at, end = np.arange(len(values)), self.starts[columns], self.starts[columns + 1]
        while len(open_):
            more = at < end
            more[more] = values[open_[more]] > self.bounds[at[more]]
            open_, at, end = open_[more], at[more] + 1, end[more]
            out[open_] += 1
        return out

    def of_zero(self) -> np.ndarray:
        return self.of(np.arange(len(self.starts) - 1), np.zeros(len(self.starts) - 1))

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts) + 1


def _blocks(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    bins: _Bins = model.value
    zero, most = bins.of_zero(), min(ROWS, max(1, GRID // (len(bins.starts) - 1)))
    for batch in _slices(batches):
        folds, labels, draws = (batch.column(c).to_numpy() for c in range(3))
        rows, columns, values = _flat(batch)
        inside = bins.of(columns, values)
        told = inside != zero[columns]
        rows, columns, inside = rows[told], columns[told], inside[told]
        order = np.argsort(folds, kind="stable")
        starts = np.flatnonzero(np.diff(folds[order])) + 1
        block = np.empty(batch.num_rows, np.int64)
        place = np.empty(batch.num_rows, np.int64)
        own = [part for same in np.split(order, starts) for part in np.array_split(same, max(1, -(-len(same) // most)))]
        for i, at in enumerate(own):
            block[at], place[at] = i, np.arange(len(at))
        order = np.lexsort((columns, block[rows]))
        rows, columns, inside = rows[order], columns[order], inside[order]
        ends = np.searchsorted(block[rows], np.arange(len(own) + 1))
        for i, at in enumerate(own):
            part = slice(ends[i], ends[i + 1])
            found, n = np.unique(columns[part], return_counts=True)
            row = {"fold": folds[at[:1]], "labels": labels[at], "draws": draws[at].view(np.uint64), "columns": found, "counts": n, "rows": place[rows[part]], "bins": inside[part]}
            yield pa.RecordBatch.from_pylist([{k: v.astype(_PARTS[k]).tobytes() for k, v in row.items()}], _BLOCK)


def _poisson(draws: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """trees x rows: how often a tree has a row, drawn with replacement."""
    with np.errstate(over="ignore"):
        x = draws[None, :] ^ ((trees[:, None].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x = ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)
    out, share = np.zeros(x.shape, np.uint8), 0.0
    for k in range(13):
        share += exp(-1) / factorial(k)
        out += x >= np.uint32(min(share * 2**32, 2**32 - 1))
    return out


@dataclass
class Forests:
    """Whole binary trees of each training set; the children of node i are 2 i + 1 and 2 i + 2. Rows of a leaf go on to the left."""

    sets: list[int]  # the folds that are left out
    features: np.ndarray  # sets x trees x nodes
    bins: np.ndarray  # the last bin that goes to the left
    stats: np.ndarray  # sets x trees x nodes x classes: the drawn rows
    grown: np.ndarray  # whether a node is open, at its level, or has been split

    def down(self, s: int, trees: slice, grid: np.ndarray, depth: int) -> np.ndarray:
        """trees x rows: the place within level ``depth``, from the left; ``grid`` has bins by column and row."""
        features, bins = self.features[s, trees], self.bins[s, trees]
        flat, n = grid.ravel(), grid.shape[1]
        rows, first = np.arange(n)[None, :], np.arange(len(features))[:, None] * features.shape[1]
        at = np.zeros((len(features), n), np.int64)
        for level in range(depth):
            node = first + (at + (2**level - 1))
            right = flat.take(features.ravel().take(node) * n + rows) > bins.ravel().take(node)
            at = 2 * at + right
        return at


class _Block:
    def __init__(self, row: dict, zero: np.ndarray):
        for name, kind in _PARTS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.zero = zero
        self.fold = int(self.fold[0])
        sizes = np.zeros(len(zero) + 1, np.int64)
        sizes[self.columns + 1] = self.counts
        self.starts = np.cumsum(sizes)

    def grid(self) -> np.ndarray:
        out = np.repeat(self.zero[:, None], len(self.labels), axis=1)
        out[np.repeat(self.columns, self.counts), self.rows] = self.bins
        return out


def _read(batches: Iterator[pa.RecordBatch], zero: np.ndarray) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block(batch.slice(i, 1).to_pylist()[0], zero)


def _weights(b: _Block, trees: slice, bootstrap: bool) -> np.ndarray:
    return _poisson(b.draws, np.arange(trees.start, trees.stop)) if bootstrap else np.ones((trees.stop - trees.start, len(b.labels)), np.uint8)


def _totals(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Drawn rows by fold, tree and class."""
    zero, n_folds, n_trees, n_classes, bootstrap = model.value
    total = np.zeros((n_folds, n_trees, n_classes))
    for b in _read(batches, zero):
        total[b.fold] += _weights(b, slice(0, n_trees), bootstrap).astype(float) @ (b.labels[:, None] == np.arange(n_classes))
    yield pa.RecordBatch.from_pylist([{"tree": 0, "sums": total.astype(np.int64).tobytes()}], _SUMS)


@dataclass
class _Pass:
    """What a pass sums: histograms of a level of some trees, in the forests of all training sets."""

    forests: Forests
    bins: _Bins
    n_classes: int
    bootstrap: bool
    level: int
    trees: slice
    subsets: np.ndarray  # trees x nodes of the level x features

    def __post_init__(self):
        low = 2**self.level - 1
        self.open = self.forests.grown[:, self.trees, low : 2 * low + 1]
        self.tree, self.node = np.nonzero(self.open.any(axis=0))
        each = self.subsets.shape[2]
        self.feature = self.subsets[self.tree, self.node].ravel()
        self.tree, self.node = np.repeat(self.tree, each), np.repeat(self.node, each)
        self.size = self.bins.sizes()[self.feature]
        ends = np.cumsum(self.size)
        self.at = ends - self.size  # of the feature's first bin
        n = self.trees.stop - self.trees.start
        self.ends = np.append(0, ends)[np.searchsorted(self.tree, np.arange(n + 1))]  # bins before each tree

    def told(self) -> list[tuple[int, int]]:
        return [(s, t) for s, t in np.argwhere(self.open.any(axis=2)).tolist()]


def _histograms(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """For each open node, feature of its subset and bin the drawn rows by class that are not zero there."""
    p: _Pass = model.value
    k, trees = p.n_classes, p.trees
    kind = np.uint8 if p.level < 8 else np.uint32
    idle = np.iinfo(kind).max
    node_of, total = p.node.astype(kind), np.zeros((len(p.open), int(p.ends[-1]) * k), np.int32)
    for b in _read(batches, _narrow(p.bins)):
        n = len(b.labels)
        drawn = _weights(b, trees, p.bootstrap)
        grid = b.grid() if p.level else np.zeros((1, n), np.uint8)
        places = {}
        for s, left_out in enumerate(p.forests.sets):
            if left_out != b.fold:
                at = p.forests.down(s, trees, grid, p.level)
                counted = (drawn > 0) & np.take_along_axis(p.open[s], at, axis=1)
                places[s] = np.where(counted, at, idle).astype(kind).ravel()
        drawn = drawn.ravel().astype(np.int32)
        code = b.bins.astype(np.int64) * k + b.labels[b.rows]
        lengths = b.starts[p.feature + 1] - b.starts[p.feature]
        met = np.flatnonzero(lengths)
        ends = np.cumsum(lengths[met])
        cuts = np.searchsorted(ends, np.arange(PIECE, ends[-1] if len(ends) else 0, PIECE))
        for own in np.split(met, np.unique(cuts)):
            if not len(own):
                continue
            each = lengths[own]
            first = np.cumsum(each) - each
            at = np.arange(first[-1] + each[-1]) + np.repeat(b.starts[p.feature[own]] - first, each)
            base = np.repeat(p.tree[own] * n, each) + b.rows.take(at)
            node = np.repeat(node_of[own], each)
            cell = np.repeat(p.at[own] * k, each) + code.take(at)
            for s, place in places.items():
                hit = np.flatnonzero(place.take(base) == node)
                np.add.at(total[s], cell[hit], drawn.take(base[hit]))
    for s, t in p.told():
        own = total[s, p.ends[t] * k : p.ends[t + 1] * k]
        yield pa.RecordBatch.from_pylist([{"tree": s * len(p.open[0]) + t, "sums": own.tobytes()}], _SUMS)


def _impurity(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.ones(len(n))
    for k in range(counts.shape[1]):
        share = counts[:, k] / np.maximum(n, 1)
        out -= share * share
    return np.where(n > 0, out, 0.0)


def _best(table: pa.Table, model) -> pa.Table:
    """Of a tree's open nodes the best split: gain, feature, bin and the rows by class that go to the left."""
    p: _Pass = model.value
    tree, k = table["tree"][0].as_py(), p.n_classes
    s, t = divmod(tree, len(p.open[0]))
    total: np.ndarray | int = 0
    for sums in table["sums"]:
        total = total + np.frombuffer(sums.as_buffer(), np.int32).astype(np.int64)
    h = total.reshape(-1, k)
    own = np.flatnonzero(p.tree == t)
    node, feature, size, at = p.node[own], p.feature[own], p.size[own], p.at[own] - p.ends[t]
    low = 2**p.level - 1
    stats = p.forests.stats[s, p.trees.start + t, low : 2 * low + 1].astype(np.int64)
    h[at + p.bins.of_zero()[feature]] += stats[node] - np.add.reduceat(h, at)
    left = np.cumsum(h, axis=0)
    left -= np.repeat(left[at] - h[at], size, axis=0)
    whole = np.repeat(stats[node], size, axis=0)
    right, n = whole - left, whole.sum(axis=1)
    n_left, n_right = left.sum(axis=1), right.sum(axis=1)
    inside = np.arange(len(h)) - np.repeat(at, size)
    last = inside == np.repeat(size, size) - 1
    bound = np.where(last, 0, np.repeat(p.bins.starts[feature], size) + inside)
    has = ~last & ((p.bins.sets[bound] >> s & 1) == 1) if len(p.bins.sets) else np.zeros(len(h), bool)
    gain = _impurity(whole, n) - n_left / np.maximum(n, 1) * _impurity(left, n_left) - n_right / np.maximum(n, 1) * _impurity(right, n_right)
    gain[~(has & (n_left > 0) & (n_right > 0))] = -np.inf
    out = np.full((2**p.level, 3 + k), -np.inf)
    of = np.repeat(node, size)
    for i in np.flatnonzero(p.open[s, t]):
        low, high = np.searchsorted(of, [i, i + 1])
        j = low + int(gain[low:high].argmax())
        out[i] = gain[j], np.repeat(feature, size)[j], inside[j], *left[j]
    return pa.Table.from_pylist([{"tree": tree, "best": out.tobytes()}], _BEST)


def _narrow(bins: _Bins) -> np.ndarray:
    zero = bins.of_zero()
    return zero.astype(np.uint8) if bins.sizes().max(initial=0) <= 256 else zero


def _subset(seed: int, tree: int, node: int, n: int, of: int) -> np.ndarray:
    return np.arange(of) if n >= of else np.sort(np.random.default_rng([seed, tree, node]).choice(of, n, replace=False))


def grow(table: DataFrame, bins: _Bins, sets: list[int], n_folds: int, n_trees: int, depth: int, n_classes: int, seed: int, every: bool, bootstrap: bool) -> Forests:
    """The forests of all training sets, level by level, over ``table`` of blocks."""
    spark, n_features = table.sparkSession, len(bins.starts) - 1
    each = n_features if every or n_trees == 1 else ceil(sqrt(n_features))
    nodes = 2 ** (depth + 1) - 1
    sent = spark.sparkContext.broadcast((_narrow(bins), n_folds, n_trees, n_classes, bootstrap))
    by_fold = sum(np.frombuffer(r.sums, np.int64) for r in table.mapInArrow(partial(_totals, model=sent), _ddl(_SUMS)).toLocalIterator())
    by_fold = by_fold.reshape(n_folds, n_trees, n_classes)
    sent.destroy()
    shape = (len(sets), n_trees, nodes)
    forests = Forests(sets, np.zeros(shape, np.int64), np.full(shape, 1 << 16), np.zeros((*shape, n_classes)), np.zeros(shape, bool))
    for s, fold in enumerate(sets):
        forests.stats[s, :, 0] = by_fold.sum(axis=0) - (by_fold[fold] if fold != ALL else 0)
    forests.grown[:, :, 0] = (forests.stats[:, :, 0] > 0).sum(axis=2) > 1
    for level in range(depth):
        low, wide = 2**level - 1, 2**level
        subsets = np.array([[_subset(seed, t, low + i, each, n_features) for i in range(wide)] for t in range(n_trees)])
        cells = len(sets) * n_classes * bins.sizes()[subsets].sum(axis=(1, 2))
        start = 0
        while start < n_trees:
            stop = max(start + 1, start + int(np.searchsorted(np.cumsum(cells[start:]), CELLS, "right")))
            work = _Pass(forests, bins, n_classes, bootstrap, level, slice(start, stop), subsets[start:stop])
            if work.open.any():
                sent = spark.sparkContext.broadcast(work)
                sums = table.mapInArrow(partial(_histograms, model=sent), _ddl(_SUMS))
                for row in sums.groupBy("tree").applyInArrow(lambda of: _best(of, sent), _ddl(_BEST)).collect():
                    s, t = divmod(row.tree, stop - start)
                    _split(forests, s, start + t, level, np.frombuffer(row.best).reshape(wide, -1), depth)
                sent.destroy()
            start = stop
    return forests


def _split(forests: Forests, s: int, t: int, level: int, best: np.ndarray, depth: int) -> None:
    low = 2**level - 1
    for i, (gain, feature, last, *left) in enumerate(best):
        node = low + i
        if not forests.grown[s, t, node]:
            continue
        forests.grown[s, t, node] = gain > 0
        if gain > 0:
            forests.features[s, t, node], forests.bins[s, t, node] = int(feature), int(last)
            children = forests.stats[s, t, 2 * node + 1 : 2 * node + 3]
            children[0], children[1] = left, forests.stats[s, t, node] - left
            forests.grown[s, t, 2 * node + 1 : 2 * node + 3] = ((children > 0).sum(axis=1) > 1) & (level + 1 < depth)


def _votes(forests: Forests, s: int, depth: int) -> np.ndarray:
    """trees x places of level ``depth`` x classes: the shares of the trees cut there. As in Spark, two leaves that say the same are one."""

    def cut(t: int, node: int, left: int) -> tuple[bool, int, list[np.ndarray]]:
        """Whether the subtree is one leaf, what the node says, and the shares below it."""
        stats = forests.stats[s, t, node]
        share, said = stats / max(stats.sum(), 1e-300), int(stats.argmax())
        if left == 0 or not forests.grown[s, t, node]:
            return True, said, [share] * 2**left
        sides = [cut(t, 2 * node + i, left - 1) for i in (1, 2)]
        if sides[0][0] and sides[1][0] and sides[0][1] == sides[1][1]:
            return True, said, [share] * 2**left
        return False, said, sides[0][2] + sides[1][2]

    return np.array([cut(t, 0, depth)[2] for t in range(forests.features.shape[1])])


def _tell(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """How many rows of a label each point takes for which class, the rows of a fold by the forest without it."""
    zero, forests, votes, points, depth = model.value
    tally: dict[tuple[int, int, int, int], int] = {}
    for b in _read(batches, zero):
        if b.fold not in forests.sets:  # no rows outside it, no forest
            continue
        s = forests.sets.index(b.fold)
        at = forests.down(s, slice(0, max(p[1] for p in points)), b.grid(), depth)
        for d in {p[2] for p in points}:
            total, done = 0.0, 0
            for point, trees, _ in sorted((p for p in points if p[2] == d), key=lambda p: p[1]):
                for t in range(done, trees):
                    total = total + votes[s, d][t][at[t] >> (depth - d)]
                done = trees
                pairs, n = np.unique(np.stack([b.labels, total.argmax(axis=1)]), axis=1, return_counts=True)
                for y, p, k in zip(*pairs.tolist(), n.tolist(), strict=True):
                    tally[b.fold, point, y, p] = tally.get((b.fold, point, y, p), 0) + k
    yield pa.RecordBatch.from_pylist([dict(zip(_TOLD.names, (*key, n), strict=True)) for key, n in tally.items()], _TOLD)


def _f1(table: DataFrame, bins: _Bins, forests: Forests, points: list[tuple[int, int, int]], depth: int) -> DataFrame:
    """F1 of (fold, point) on the rows of each fold, for points (number, trees, depth)."""
    votes = {(s, d): _votes(forests, s, d) for s in range(len(forests.sets)) for d in {p[2] for p in points}}
    sent = table.sparkSession.sparkContext.broadcast((_narrow(bins), forests, votes, points, depth))
    told = table.mapInArrow(partial(_tell, model=sent), _ddl(_TOLD))
    return grouped_f1(told.groupBy("fold", "point", "label", "prediction").agg(F.sum("n").alias("n")), ["fold", "point"])


def _stored(rows: DataFrame, bins: _Bins, n: int) -> DataFrame:
    """The rows in written blocks, read by no more tasks than there are cores: each sends its sums."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < (tasks := min(cores, n // ROWS)):
        rows = rows.repartition(tasks, "draw")
    sent = rows.sparkSession.sparkContext.broadcast(bins)
    return materialise(rows.mapInArrow(partial(_blocks, model=sent), _ddl(_BLOCK)), "blocks", GROUP).coalesce(cores)


def word_forest_search(
    folds: DataFrame, test: DataFrame, key: str, trees: list[int], depths: list[int], max_bins: int = 32,
    n_folds: int = 5, seed: int = 42, every_feature: bool = False, bootstrap: bool = True,
) -> DataFrame:
    """(point, mean_score, best_test_f1): each point's mean F1 over the folds, and on ``test`` the F1 of the best.

    ``folds`` is a written table of (key, label, features, ``_fold``), ``test`` one of (key, label, features);
    labels count from 0. A node chooses from the root of the number of features, or from ``every_feature``.
    """
    spark = folds.sparkSession
    schema = "point string, mean_score double, best_test_f1 double"
    rows = _elements(folds, key, F.col("_fold"), seed)
    first = folds.where("label IS NOT NULL AND features IS NOT NULL AND _fold IS NOT NULL").select("features").first()
    if first is None:
        return spark.createDataFrame([], schema)
    n_features, n_classes = len(first[0]), int(folds.agg(F.max("label")).first()[0]) + 1
    counts = rows.mapInArrow(_values, _ddl(_VALUES)).groupBy("chunk", "fold", "column", "value").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "values")
    sizes = {r.fold: r.n for r in counts.where("column < 0").collect()}
    sets = [f for f in [*range(n_folds), ALL] if sum(n for fold, n in sizes.items() if fold != f)]
    found = counts.where("column >= 0").groupBy("chunk").applyInArrow(lambda of: _bounds(of, sizes, sets, max_bins), _ddl(_BOUNDS))
    bounds = found.toArrow().sort_by([("column", "ascending"), ("bound", "ascending")])
    starts = np.searchsorted(bounds["column"].to_numpy(), np.arange(n_features + 1))
    bins = _Bins(starts, bounds["bound"].to_numpy(), bounds["sets"].to_numpy())
    table = _stored(rows, bins, sum(sizes.values()))
    depth = max(depths)
    forests = grow(table, bins, sets, n_folds, max(trees), depth, n_classes, seed, every_feature, bootstrap)
    grid = list(product(trees, depths))
    points = [(i, t, d) for i, (t, d) in enumerate(grid)]
    means = dict(_f1(table, bins, forests, points, depth).groupBy("point").agg(F.avg("f1")).collect())  # one number a point
    best = max(range(len(grid)), key=lambda i: means.get(i, -1.0))
    unseen = _elements(test, key, F.lit(ALL), seed)
    tested = _f1(_stored(unseen, bins, unseen.count()), bins, forests, [points[best]], depth).first()
    found = [(f"numTrees={t}, maxDepth={d}", means.get(i), tested.f1 if tested else None) for i, t, d in points]
    return spark.createDataFrame(found, schema)
