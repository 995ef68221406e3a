"""Cross-validated searches over logistic models of several classes and many, mostly empty, features.

As in ``fold_search``, the models of all grid points and folds are fitted side by side: a pass over
the rows sums the loss and gradient of every open model, whatever their number, and each model's
next step follows on the driver. There the models are held, 10 of their last steps each, which depends
on words and classes and not on the rows.

A model is the one that Spark's ``LogisticRegression`` fits to its training rows alone: standardised
features, the penalty on the weights of all classes (of one, if there are two), and the same steps,
limited-memory BFGS, kept to an orthant where a part of the penalty is L1.

Rows are written once in blocks of one fold, which meet the models without that fold only. Elements of
columns that many rows of a block have are held apart from the others: they meet the models in a matrix
product. Weights stand relative to those of the first class, and so do what tasks sum. Models with an L1
penalty meet only the columns that one of them has a weight for.

What a task holds depends on models, words and classes: a block, the weights and their sums twice each, and
the blocks of a small row group. There are as many tasks as cores at most, whose sums are added one by one.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators.fold_search import ALL, Point, grouped_f1

ROWS = 512  # of a block
DENSE = 1 / 64  # of a block's rows that have a column of the matrix product
PIECE = 1024  # elements of other columns that meet the models at once
ELEMENTS = 1 << 20  # that are made into blocks at once, one row at least
GROUP = 8 << 20  # bytes of blocks that are read at once
SLAB = 1 << 15  # sums in a row that tasks emit
HISTORY = 10  # steps that a model's curvature is taken from

_PARTS = {"folds": np.int32, "labels": np.int32, "found": np.int32, "n": np.uint16, "rows": np.uint16, "values": None}
_BLOCK = pa.schema([(name, pa.binary()) for name in _PARTS])
_SUMS = pa.schema([("slab", pa.int32()), ("sums", pa.binary())])
_TOLD = pa.schema([("fold", pa.int32()), ("point", pa.int32()), ("label", pa.int32()), ("prediction", pa.int32()), ("n", pa.int64())])


def _packed(values: np.ndarray) -> bytes:
    """In a byte or two each if they are whole numbers that fit, else as they are."""
    for kind in (np.uint8, np.uint16):
        if len(values) and 0 <= values.min() and values.max() <= np.iinfo(kind).max and (values == np.floor(values)).all():
            return values.astype(kind).tobytes()
    return values.tobytes()


def _unpacked(packed, n: int) -> np.ndarray:
    width = len(packed) // max(n, 1)
    return np.frombuffer(packed, {1: np.uint8, 2: np.uint16}.get(width, float)).astype(float)


def slices(batches: Iterator[pa.RecordBatch], column: int, elements: int) -> Iterator[pa.RecordBatch]:
    """Rows whose lists in ``column`` have about as many elements, one row at least."""
    for batch in batches:
        starts, low = batch.column(column).offsets.to_numpy(), 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + elements, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, label, indices, values) -> blocks of one fold, and of one label where there are enough rows."""
    for batch in slices(batches, 2, ELEMENTS):
        folds, labels = (batch.column(c).to_numpy().astype(np.int32) for c in (0, 1))
        order = np.lexsort((labels, folds))
        starts = np.flatnonzero(np.diff(folds[order], prepend=folds.min(initial=0) - 1))
        for at in [part for own in np.split(order, starts[1:]) for part in np.split(own, range(ROWS, len(own), ROWS)) if len(part)]:
            lists = batch.column(2).take(pa.array(at))
            columns = lists.flatten().to_numpy().astype(np.int32)
            values = batch.column(3).take(pa.array(at)).flatten().to_numpy().astype(float)
            rows = np.repeat(np.arange(len(at)), np.diff(lists.offsets.to_numpy()))
            has = values != 0
            columns, values, rows = columns[has], values[has], rows[has]
            order = np.argsort(columns, kind="stable")
            found, n = np.unique(columns, return_counts=True)
            row = {"folds": folds[at[:1]], "labels": labels[at], "found": found, "n": n, "rows": rows[order], "values": values[order]}
            yield pa.RecordBatch.from_pylist([{k: v.astype(_PARTS[k]).tobytes() if _PARTS[k] else _packed(v) for k, v in row.items()}], _BLOCK)


def blocks(df: DataFrame, label: str = "label", features: str = "features", fold: str = "_fold") -> DataFrame:
    """The rows in written blocks, read by no more tasks than there are cores; those without a label, features or fold are left out."""
    v = F.unwrap_udt(features)
    every = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    columns = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull() & F.col(fold).isNotNull())
    rows = rows.select(F.col(fold).cast("int"), F.col(label).cast("int"), columns.alias("columns"), v["values"].alias("values"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores and (tasks := min(cores, rows.count() // ROWS)) > rows.rdd.getNumPartitions():
        rows = rows.repartition(tasks, F.xxhash64(*rows.columns))
    return materialise(rows.mapInArrow(_blocks, ", ".join(f"{name} binary" for name in _PARTS)), "blocks", GROUP).coalesce(cores)


class _Block:
    def __init__(self, row: dict):
        for name, kind in _PARTS.items():
            if kind:
                setattr(self, name, np.frombuffer(row[name], kind))
        self.values = _unpacked(row["values"], len(self.rows))
        self.fold = int(self.folds[0])
        often = self.n >= DENSE * len(self.labels)
        self.columns, self.inside = self.found[often], np.repeat(often, self.n)
        self.of_columns = self.n[often]
        others = ~self.inside
        self.by_column = np.repeat(self.found[~often], self.n[~often]), self.rows[others], self.values[others]
        order = np.argsort(self.by_column[1], kind="stable")
        self.other_columns, self.other_rows, self.other_values = (part[order] for part in self.by_column)

    @cached_property
    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.labels), len(self.columns)))
        out[self.rows[self.inside], np.repeat(np.arange(len(self.columns)), self.of_columns)] = self.values[self.inside]
        return out

    def _others(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, source: np.ndarray, out: np.ndarray) -> None:
        """Add to each row of ``out`` the rows of ``source`` that its elements name; elements of a row stand together."""
        for low in range(0, len(rows), PIECE):
            own = rows[low : low + PIECE]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            met = source[columns[low : low + PIECE]] * values[low : low + PIECE, None]
            out[own[starts]] += np.add.reduceat(met, starts)

    def times(self, weights: np.ndarray, used: np.ndarray | None = None) -> np.ndarray:
        """rows x features times features x models; ``used``: which features have a weight."""
        if used is None:
            out = self.matrix @ weights[self.columns]
            self._others(self.other_rows, self.other_columns, self.other_values, weights, out)
            return out
        own, others = np.flatnonzero(used[self.columns]), np.flatnonzero(used[self.other_columns])
        out = self.matrix[:, own] @ weights[self.columns[own]]
        self._others(self.other_rows[others], self.other_columns[others], self.other_values[others], weights, out)
        return out

    def add_to(self, out: np.ndarray, of_rows: np.ndarray) -> None:
        """Add features x rows times rows x models."""
        out[self.columns] += self.matrix.T @ of_rows
        columns, rows, values = self.by_column
        self._others(columns, rows, values, of_rows, out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block({name: batch.column(k)[i].as_buffer() for k, name in enumerate(_PARTS)})


def _emit(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for slab, low in enumerate(range(0, sums.size, SLAB)):
        yield pa.RecordBatch.from_pylist([{"slab": slab, "sums": sums.ravel()[low : low + SLAB].tobytes()}], _SUMS)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a slab, added as they come."""
    total, slab = 0.0, 0
    for batch in batches:
        slab = batch.column(0)[0].as_py()
        for sums in batch.column(1):
            total = total + np.frombuffer(sums.as_buffer())
    yield pa.RecordBatch.from_pylist([{"slab": slab, "sums": total.tobytes()}], _SUMS)


def _summed(table: DataFrame, function) -> np.ndarray:
    """What the tasks emit in slabs, added: as many numbers as the models have."""
    kind = "slab int, sums binary"
    found = table.mapInArrow(function, kind).groupBy("slab").applyInArrow(_add, kind).collect()
    return np.concatenate([np.frombuffer(r.sums) for r in sorted(found)])


def _moments(batches: Iterator[pa.RecordBatch], folds: int, n_features: int, n_classes: int) -> Iterator[pa.RecordBatch]:
    """For each fold the sum and sum of squares of each feature, and the rows of each class."""
    sums = np.zeros((folds, 2 * n_features + n_classes))
    for b in _read(batches):
        columns = np.repeat(b.found, b.n)
        np.add.at(sums[b.fold], columns, b.values)
        np.add.at(sums[b.fold], columns + n_features, b.values * b.values)
        np.add.at(sums[b.fold], b.labels + 2 * n_features, 1.0)
    return _emit(sums)


@dataclass
class Softmax:
    """A model without the rows of ``fold``: ``weights`` of standardised features x classes, the intercepts last.

    Of two classes only the second has weights.
    """

    fold: int
    point: Point
    rows: float
    classes: int
    scale: np.ndarray  # the reciprocals of the standard deviations
    mean: np.ndarray  # of the standardised features
    weights: np.ndarray
    steps: Generator | None = None

    def plain(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the features as they are, and intercepts, of all classes but the first and relative to its."""
        w = self.weights[:, 1:] - self.weights[:, :1] if self.classes > 2 else self.weights
        return w[:-1] * self.scale[:, None], w[-1] - self.mean @ w[:-1]


def _side_by_side(models: list[Softmax]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate(parts, axis=-1) for parts in zip(*(m.plain() for m in models), strict=True))


def _margins(b: _Block, weights: np.ndarray, intercepts: np.ndarray, n_classes: int, used: np.ndarray | None = None) -> np.ndarray:
    """rows x models x classes"""
    m = (b.times(weights, used) + intercepts).reshape(len(b.labels), -1, n_classes - 1)
    return np.concatenate([np.zeros((*m.shape[:2], 1)), m], axis=2)


@dataclass
class _Open:
    """Models that rows meet together, those without one fold next to each other: their folds, weights and intercepts.

    Weights and sums stand twice side by side, so that the models of all folds but one are neighbours, too.
    """

    folds: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    n_classes: int

    def __post_init__(self):
        used = (self.weights != 0).any(axis=1)
        self.used = used if used.mean() < 0.5 else None
        self.weights = np.concatenate([self.weights] * 2, axis=1)
        self.intercepts = np.concatenate([self.intercepts] * 2)
        self.sums = np.zeros((len(self.weights) + 1, self.weights.shape[1]))
        self.loss = np.zeros(len(self.folds))

    def meet(self, b: _Block) -> None:
        own = np.flatnonzero(self.folds == b.fold)
        first, n = (int(own[-1]) + 1, len(self.folds) - len(own)) if len(own) else (0, len(self.folds))
        if not n:
            return
        k = self.n_classes - 1
        at = slice(first * k, (first + n) * k)
        m = _margins(b, self.weights[:, at], self.intercepts[at], self.n_classes, self.used)
        said = np.take_along_axis(m, b.labels[:, None, None], axis=2)[:, :, 0]
        top = m.max(axis=2)
        np.exp(m - top[:, :, None], out=m)
        norm = m.sum(axis=2)
        self.loss[np.arange(first, first + n) % len(self.folds)] += (np.log(norm) + top - said).sum(axis=0)
        m /= norm[:, :, None]
        m[np.arange(len(m)), :, b.labels] -= 1.0
        off = m[:, :, 1:].reshape(len(m), -1)
        b.add_to(self.sums[:-1, at], off)
        self.sums[-1, at] += off.sum(axis=0)

    def total(self) -> np.ndarray:
        width = len(self.folds) * (self.n_classes - 1)
        out = np.zeros((len(self.sums) + 1, width))
        out[:-1] = self.sums[:, :width] + self.sums[:, width:]
        out[-1, : len(self.folds)] = self.loss
        return out


def _slopes(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Per model the gradient in the weights and intercepts, and the loss, over the rows of the other folds."""
    groups, n_classes = model.value
    groups = [_Open(*group, n_classes) for group in groups]
    for b in _read(batches):
        for group in groups:
            group.meet(b)
    total = np.concatenate([group.total() for group in groups], axis=1)
    losses = np.concatenate([group.loss for group in groups])
    total[-1] = 0.0
    total[-1, : len(losses)] = losses
    return _emit(total)


class _Stuck(Exception):
    pass


Steps = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def _direction(gradient: np.ndarray, moves: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The way down by the curvature of the last moves, the newest first."""
    way, shares = -gradient, []
    for step, change in moves:
        shares.append((step @ way) / (step @ change))
        way = way - shares[-1] * change
    if moves:
        step, change = moves[0]
        way = way * ((step @ change) / (change @ change))
    for (step, change), share in zip(reversed(moves), reversed(shares), strict=True):
        way = way + (share - (change @ way) / (step @ change)) * step
    if not np.isfinite(way).all() or (moves and moves[0][0] @ moves[0][1] < 0):
        raise _Stuck
    return way


def _between(a: tuple, b: tuple) -> float:
    """The minimum of the cubic through two (place, value, slope), a tenth from both at least."""
    (s, f, df), (t, g, dg) = sorted((a, b))
    d1 = df + dg - 3 * (f - g) / (s - t)
    d2 = np.sqrt(d1 * d1 - df * dg)
    at = t - (t - s) * (dg + d2 - d1) / (dg - df + 2 * d2)
    return float(np.clip(at, s + 0.1 * (t - s), s + 0.9 * (t - s)))


def _wolfe(x: np.ndarray, value: float, gradient: np.ndarray, way: np.ndarray, first: float):
    """The place along ``way`` where value and slope have fallen enough, with value and gradient."""
    slope = float(gradient @ way)
    if slope > 0:
        raise _Stuck

    def at(t: float):
        f, g = yield x + t * way
        return (t, f, float(g @ way)), g

    def zoom(low: tuple, high: tuple):
        for _ in range(10):
            c, g = yield from at(_between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(slope):
                    return c, g
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Stuck

    t, low = first, (0.0, value, slope)
    for i in range(10):
        c, g = yield from at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(slope):
            return c, g
        if c[2] >= 0:
            return (yield from zoom(c, low))
        t, low = 1.5 * t, c
    raise _Stuck


def _with_lasso(x: np.ndarray, value: float, gradient: np.ndarray, lasso: np.ndarray) -> tuple[float, np.ndarray]:
    """Value and the steepest one-sided gradient under the L1 penalty."""
    at_zero = np.sign(gradient) * np.maximum(np.abs(gradient) - lasso, 0.0)
    return value + float((lasso * np.abs(x)).sum()), np.where(x != 0, gradient + np.sign(x) * lasso, at_zero)


def _orthant(
    x: np.ndarray, slopes: np.ndarray, plain: float, value: float, way: np.ndarray, lasso: np.ndarray, first: float, shrink: float
):
    """The next point, by steps ever smaller or greater, in the orthant of ``x``; with its value and gradient.

    The first step is judged by the value at ``x`` without the penalty, as in Spark's solver.
    """
    side = np.where(x != 0, np.sign(x), -np.sign(slopes))
    slope, t = float(slopes @ way), first
    for i in range(21):
        if i == 0 and plain > value + 1e-4 * t * slope:
            t *= shrink
            continue
        stepped = x + t * way
        stepped = stepped * (np.sign(stepped) == side)
        f, g = yield stepped
        full, adjusted = _with_lasso(stepped, f, g, lasso)
        along = float(adjusted @ way)
        if i > 0 and full > value + 1e-4 * t * slope:
            t *= shrink
        elif along < 0.9 * slope:
            t *= 2.1
        elif along > -0.9 * slope:
            t *= shrink
        else:
            return stepped, f, g
        if not 1e-10 <= t <= 1e10:
            raise _Stuck
    raise _Stuck


def minimum(x: np.ndarray, lasso: np.ndarray | None, max_iter: int, tol: float) -> Steps:
    """Yields places, takes (value, gradient) there, and returns the last place; ``lasso`` adds an L1 penalty."""
    value, gradient = yield x
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    done, failed = 0, False
    while done < max_iter:
        full, slopes = (value, gradient) if lasso is None else _with_lasso(x, value, gradient, lasso)
        if np.sqrt(slopes @ slopes) <= max(tol * full, 1e-8):
            break
        try:
            way = _direction(slopes, moves)
            if lasso is None:
                first = 1.0 if done else 1.0 / np.sqrt(way @ way)
                (t, new_value, _), new_gradient = yield from _wolfe(x, value, gradient, way, first)
                if t * np.sqrt(gradient @ gradient) < 1e-10:
                    raise _Stuck
                new = x + t * way
            else:
                way = np.where(way * slopes < 0, way, 0.0)
                first = 1.0 if done else 0.5 / np.sqrt(gradient @ gradient)
                new, new_value, new_gradient = yield from _orthant(x, slopes, value, full, way, lasso, first, 0.5 if done else 0.1)
        except _Stuck:
            if failed:
                break
            moves, failed = [], True
            continue
        moves = [(new - x, new_gradient - gradient), *moves][:HISTORY]
        x, value, gradient = new, new_value, new_gradient
        done, failed = done + 1, False
    return x


def _started(fold: int, point: Point, moments: np.ndarray, n_features: int, max_iter: int, tol: float) -> Softmax:
    sums, squares, sizes = np.split(moments, [n_features, 2 * n_features])
    n, n_classes = sizes.sum(), len(sizes)
    mean = sums / max(n, 1.0)
    deviation = np.sqrt(np.maximum(squares - n * mean * mean, 0.0) / max(n - 1.0, 1.0))
    deviation[deviation < 1e-9 * np.abs(mean)] = 0.0  # equal in all rows
    scale = np.divide(1.0, deviation, out=np.zeros(n_features), where=deviation > 0)
    weights = np.zeros((n_features + 1, n_classes if n_classes > 2 else 1))
    with np.errstate(divide="ignore"):
        weights[-1] = np.log1p(sizes) - np.log1p(sizes).mean() if n_classes > 2 else np.log(sizes[1]) - np.log(sizes[0])
    model = Softmax(fold, point, n, n_classes, scale, mean * scale, weights)
    if (sizes > 0).sum() > 1:
        lasso = None
        if point.reg * point.elastic > 0:
            lasso = np.full(weights.shape, point.reg * point.elastic)
            lasso[-1] = 0.0
            lasso = lasso.ravel()
        model.steps = minimum(weights.ravel(), lasso, max_iter, tol)
    return model


def fit_softmax(
    table: DataFrame, points: list[Point], folds: list[int], n_folds: int, n_features: int, n_classes: int,
    max_iter: int = 100, tol: float = 1e-6,
) -> list[Softmax]:
    """The models of all points without each of ``folds`` (``ALL``: of all rows), fitted in common passes over ``blocks``."""
    n_classes = max(n_classes, 2)
    spark = table.sparkSession
    moments = _summed(table, partial(_moments, folds=n_folds, n_features=n_features, n_classes=n_classes)).reshape(n_folds, -1)
    models = []
    for fold in folds:
        own = moments.sum(axis=0) - (moments[fold] if fold != ALL else 0.0)
        if own[2 * n_features :].sum() > 0:
            models += [_started(fold, point, own, n_features, max_iter, tol) for point in points]
    open_ = sorted((m for m in models if m.steps), key=lambda m: m.point.reg * m.point.elastic > 0)
    for m in open_:
        next(m.steps)  # where the weights are
    while open_:
        groups = [list(group) for _, group in groupby(open_, key=lambda m: m.point.reg * m.point.elastic > 0)]
        told = [(np.array([m.fold for m in group]), *_side_by_side(group)) for group in groups]
        sent = spark.sparkContext.broadcast((told, n_classes))
        sums = _summed(table, partial(_slopes, model=sent)).reshape(n_features + 2, -1)
        sent.destroy()
        left, width = [], n_classes - 1
        for k, m in enumerate(open_):
            s = sums[:, k * width : (k + 1) * width] / m.rows
            ridge, w = m.point.reg * (1 - m.point.elastic), m.weights[:-1]
            slopes = s[:-1].copy()
            if n_classes > 2:  # over all classes they add up to nothing
                slopes = np.concatenate([-slopes.sum(axis=1, keepdims=True), slopes], axis=1)
            slopes[:-1] = slopes[:-1] * m.scale[:, None] - m.mean[:, None] * slopes[-1] + ridge * w
            loss = sums[-1, k] / m.rows + 0.5 * ridge * (w * w).sum()
            try:
                m.weights = m.steps.send((float(loss), slopes.ravel())).reshape(m.weights.shape)
                left.append(m)
            except StopIteration as end:
                m.weights, m.steps = end.value.reshape(m.weights.shape), None
        open_ = left
    return models


def _tell(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """How many rows of a label each point's model takes for which class, the rows of a fold by the models without it."""
    n_classes, by_fold = model.value
    tally: dict[tuple[int, int, int, int], int] = {}
    for b in _read(batches):
        if b.fold not in by_fold:  # no rows outside it, no model
            continue
        points, weights, intercepts = by_fold[b.fold]
        said = _margins(b, weights, intercepts, n_classes).argmax(axis=2)
        for point, column in zip(points, said.T, strict=True):
            pairs, n = np.unique(np.stack([b.labels, column]), axis=1, return_counts=True)
            for y, p, k in zip(*pairs.tolist(), n.tolist(), strict=True):
                tally[b.fold, point, y, p] = tally.get((b.fold, point, y, p), 0) + k
    yield pa.RecordBatch.from_pylist([dict(zip(_TOLD.names, (*key, n), strict=True)) for key, n in tally.items()], _TOLD)


def _f1(table: DataFrame, models: list[Softmax], points: list[Point]) -> DataFrame:
    """F1 of (fold, point) on the rows of each fold, by the models that have not seen them."""
    by_fold = {}
    for fold in {m.fold for m in models}:
        own = [m for m in models if m.fold == fold]
        by_fold[fold] = ([points.index(m.point) for m in own], *_side_by_side(own))
    sent = table.sparkSession.sparkContext.broadcast((max([2, *(m.classes for m in models)]), by_fold))
    told = table.mapInArrow(partial(_tell, model=sent), "fold int, point int, label int, prediction int, n long")
    counts = told.groupBy("fold", "point", "label", "prediction").agg(F.sum("n").alias("n"))
    return grouped_f1(counts, ["fold", "point"])


def softmax_search(
    folds: DataFrame, test: DataFrame, regs: list[float], elastics: list[float], n_folds: int = 5, max_iter: int = 100, tol: float = 1e-6
) -> DataFrame:
    """(point, mean_score, best_test_f1): each point's mean F1 over the folds, and on ``test`` the F1 of the best.

    ``folds`` is a written table of (label, features, ``_fold``), ``test`` one of (label, features);
    labels count from 0.
    """
    spark = folds.sparkSession
    points = [Point(r, e) for r, e in product(regs, elastics)]
    first = folds.where("label IS NOT NULL AND features IS NOT NULL").select("features").first()
    if first is None:
        return spark.createDataFrame([], "point string, mean_score double, best_test_f1 double")
    n_classes = int(folds.agg(F.max("label")).first()[0]) + 1
    table = blocks(folds)
    fit = partial(fit_softmax, table, n_folds=n_folds, n_features=len(first[0]), n_classes=n_classes, max_iter=max_iter, tol=tol)
    scores = _f1(table, fit(points, list(range(n_folds))), points)
    means = dict(scores.groupBy("point").agg(F.avg("f1")).collect())  # one number a point
    best = max(range(len(points)), key=lambda i: means.get(i, -1.0))
    tested = _f1(blocks(test.withColumn("_fold", F.lit(ALL))), fit([points[best]], [ALL]), points).first()
    rows = [
        (f"regParam={p.reg}, elasticNetParam={p.elastic}", means.get(i), tested.f1 if tested else None) for i, p in enumerate(points)
    ]
    return spark.createDataFrame(rows, "point string, mean_score double, best_test_f1 double")
