"""Cross-validated searches from statistics that add up over the folds.

The folds are prepared once, as a written table with a fold number, and what a training set
is made of is gathered per fold: the statistics of a training set are the total less those
of the fold that is left out.

``logistic_search`` fits all models, of every grid point and every fold, side by side: each
pass over the rows sums the loss, gradient and second derivatives of all of them, and a
Newton step with the penalties follows on these few numbers. A pass costs one scan whatever
the number of models, and some ten passes do; thresholds share their model's scores.

``bayes_search`` counts the words of all texts once per fold and class, by sums that never hold a
row for a text and word. The models are counts of bounded vocabularies: ``vocab_size`` words for
each fold and class, whatever the number of texts. Tasks get these counts and score whole texts with
the model that has not seen them, for all smoothings in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import word_tokens
from millrace.lineage import materialise
from millrace.operators.ordered import running_sums
from millrace.operators.ranking import top_rows_per_group

ALL = -1  # the fold that leaves out nothing
SCORED_WORDS = 1 << 18  # words of texts whose weights are held at once, one text at least
SCORED_LABELS = 64


@dataclass(frozen=True)
class Point:
    """Strength of the penalty and the share of it that is L1, on standardised features."""

    reg: float
    elastic: float


@dataclass
class Logistic:
    """A model without the rows of ``fold``: the weights of the features, the intercept last."""

    fold: int
    point: Point
    weights: np.ndarray
    scale: np.ndarray  # standard deviations of its training rows
    rows: float


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.array(batch.column(2).flatten(), float).reshape(batch.num_rows, -1)
    one = np.ones((batch.num_rows, 1))
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.concatenate([x, one], axis=1)


def _emit(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for key, values in sums.items():
        at = np.arange(len(values))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(values), key), pa.int32()), pa.array(at, pa.int32()), pa.array(values)],
            names=["model", "at", "value"],
        )


def _added(rows: DataFrame, function) -> dict[int, np.ndarray]:
    """What the tasks emit, summed by model and place: as many numbers as the models have."""
    parts = rows.mapInArrow(function, "model int, at int, value double")
    found = parts.groupBy("model", "at").agg(F.sum("value").alias("value")).toArrow()
    model, at, value = (found[c].to_numpy() for c in ("model", "at", "value"))
    out = {}
    for m in np.unique(model).tolist():
        own = model == m
        out[m] = value[own][np.argsort(at[own])]
    return out


def _moments(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        fold, _, x = _matrix(batch)
        x[:, :-1] -= shift
        for f in np.unique(fold).tolist():
            own = x[fold == f]
            add = np.concatenate([own.sum(0), (own * own).sum(0)])
            sums[f] = sums.get(f, 0) + add
    return _emit(sums)


def _slopes(batches: Iterator[pa.RecordBatch], weights: np.ndarray, folds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per model loss, gradient and upper triangle of the second derivatives over the rows of the other folds."""
    d, n_models = weights.shape
    upper = np.triu_indices(d)
    total = np.zeros((1 + d + len(upper[0]), n_models))
    for batch in batches:
        for low in range(0, batch.num_rows, 4096):
            fold, y, x = _matrix(batch.slice(low, 4096))
            margin = x @ weights
            p = 0.5 * (1.0 + np.tanh(0.5 * margin))
            seen = fold[:, None] != folds[None, :]
            total[0] += ((np.logaddexp(0.0, margin) - y[:, None] * margin) * seen).sum(0)
            total[1 : 1 + d] += x.T @ ((p - y[:, None]) * seen)
            total[1 + d :] += (x[:, upper[0]] * x[:, upper[1]]).T @ (p * (1.0 - p) * seen)
    return _emit({m: total[:, m] for m in range(n_models)})


def _penalty(model: Logistic, w: np.ndarray) -> float:
    b = np.abs(w[:-1] * model.scale)
    return model.point.reg * (model.point.elastic * b.sum() + 0.5 * (1 - model.point.elastic) * (b * b).sum())


def _step(model: Logistic, gradient: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The minimum of the second-order expansion with the penalty, by coordinates."""
    start, w = model.weights, model.weights.copy()
    ridge = np.append(model.point.reg * (1 - model.point.elastic) * model.scale**2, 0.0)
    lasso = np.append(model.point.reg * model.point.elastic * model.scale, 0.0)
    free = [j for j in range(len(w)) if second[j, j] + ridge[j] > 1e-12 and (j == len(w) - 1 or model.scale[j] > 0)]
    for _ in range(10_000):
        moved = 0.0
        for j in free:
            slope = gradient[j] + second[j] @ (w - start) - second[j, j] * w[j]
            value = -np.sign(slope) * max(abs(slope) - lasso[j], 0.0) / (second[j, j] + ridge[j])
            moved = max(moved, abs(value - w[j]) / (1.0 + abs(value)))
            w[j] = value
        if moved < 1e-12:
            break
    return w


def fit_logistic(rows: DataFrame, points: list[Point], folds: list[int], max_passes: int = 50, tol: float = 1e-9) -> list[Logistic]:
    """The models of all points and folds, and of all rows (``ALL``), fitted in common passes over ``rows``.

    ``rows`` is a written table of (fold, label 0 or 1, features as an array).
    """
    first = rows.select("features").first()
    if first is None:
        return []
    shift = np.array(first[0], float)
    sums = _added(rows, partial(_moments, shift=shift))
    total = sum(sums.values())
    d = len(shift)
    models = []
    for fold in [*folds, ALL]:
        s = total - sums.get(fold, 0.0)
        n = s[d]
        mean = s[:d] / max(n, 1.0)
        scale = np.sqrt(np.maximum(s[d + 1 : 2 * d + 1] - n * mean * mean, 0.0) / max(n - 1.0, 1.0))
        models += [Logistic(fold, point, np.zeros(d + 1), scale, n) for point in points]
    open_ = [m for m in models if m.rows > 0]
    best: dict[int, tuple[float, np.ndarray]] = {}  # the best objective of each open model, and where it was
    for _ in range(max_passes):
        if not open_:
            break
        weights, own = np.stack([m.weights for m in open_], axis=1), np.array([m.fold for m in open_])
        slopes = _added(rows, partial(_slopes, weights=weights, folds=own))
        left = []
        for k, model in enumerate(open_):
            s = slopes[k] / model.rows
            objective = s[0] + _penalty(model, model.weights)
            before = best.get(id(model))
            if before and objective > before[0] + 1e-12 * abs(before[0]):  # too far: half of the step
                model.weights = 0.5 * (model.weights + before[1])
                if np.abs(model.weights - before[1]).max() > tol:
                    left.append(model)
                else:
                    model.weights = before[1]
                continue
            best[id(model)] = (objective, model.weights)
            second = np.zeros((d + 1, d + 1))
            second[np.triu_indices(d + 1)] = s[2 + d :]
            second = second + np.triu(second, 1).T
            new = _step(model, s[1 : 2 + d], second)
            if np.abs(new - model.weights).max() > tol * (1.0 + np.abs(new).max()):
                model.weights = new
                left.append(model)
        open_ = left
    return models


def _by_fold(spark, models: list[Logistic], points: list[Point]) -> DataFrame:
    """The weights as rows, one for each model."""
    rows = [(m.fold, points.index(m.point), m.weights[:-1].tolist(), float(m.weights[-1])) for m in models]
    return spark.createDataFrame(rows, "model_fold int, point int, weights array<double>, intercept double")


def _margin() -> Column:
    product = F.zip_with("features", "weights", lambda a, b: a * b)
    return F.aggregate(product, F.lit(0.0), lambda total, x: total + x) + F.col("intercept")


def grouped_auroc(scored: DataFrame, groups: list[str], score: str, label: str, n: str | None = None) -> DataFrame:
    """Area under the ROC curve of each group, exact, ties half; ``n`` counts equal rows."""
    rows = F.col(n) if n else F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    hit, other = F.when(F.col(label) == 1, rows).otherwise(none), F.when(F.col(label) == 1, none).otherwise(rows)
    steps = scored.groupBy(*groups, score).agg(F.sum(hit).alias("p"), F.sum(other).alias("q"))
    upto = running_sums(steps, [F.col(score)], {"below": F.col("q")}, groups)
    won = F.sum(F.col("p") * (F.col("below") - F.col("q") / 2.0))
    pairs = F.sum("p").cast("double") * F.sum("q")
    return upto.groupBy(*groups).agg(F.try_divide(won, pairs).alias("auroc"))  # null where a class is absent


def grouped_f1(counts: DataFrame, groups: list[str]) -> DataFrame:
    """F1 averaged over the classes by their size, from (groups, label, prediction, n)."""
    none, n = F.lit(0).cast("bigint"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    entries = F.array(
        F.struct(F.col("label"), n.alias("n"), hit.alias("hit"), none.alias("said")),
        F.struct(F.col("prediction").alias("label"), none.alias("n"), none.alias("hit"), n.alias("said")),
    )
    classes = counts.select(*groups, F.inline(entries)).groupBy(*groups, "label")
    classes = classes.agg(*[F.sum(c).alias(c) for c in ("n", "hit", "said")])
    f1 = F.when(F.col("hit") > 0, 2.0 * F.col("hit") / (F.col("n") + F.col("said"))).otherwise(0.0)
    return classes.groupBy(*groups).agg((F.sum(f1 * F.col("n")) / F.sum("n")).alias("f1"))


def prepared(df: DataFrame, label: str = "label", features: str = "features", fold: str = "_fold") -> DataFrame:
    """The folds as a written table; rows without a label or features are left out."""
    array = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
    rows = df.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("label"), array.alias("features"))
    return materialise(rows.where("fold IS NOT NULL AND label IS NOT NULL AND features IS NOT NULL"), "folds")


def logistic_search(
    train: DataFrame, test: DataFrame, regs: list[float], elastics: list[float], thresholds: list[float], folds: int = 5
) -> DataFrame:
    """Per grid point: reg, elastic, threshold, the means of AUROC and weighted F1 over the folds, and F1 on ``test``.

    ``train`` and ``test`` are tables made by ``prepared``; ``test`` needs no folds.
    """
    points = [Point(r, e) for r in regs for e in elastics]
    models = fit_logistic(train, points, list(range(folds)))
    spark = train.sparkSession
    tables = _by_fold(spark, models, points)  # a row for each model
    cut = [(i, float(t), float(np.log(t / (1 - t)))) for i, t in enumerate(thresholds)]
    cuts = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(m).alias("margin_cut")) for _, t, m in cut]))

    def scored(rows: DataFrame, fold: Column) -> DataFrame:
        met = rows.withColumn("own", fold).join(tables, F.col("own") == F.col("model_fold"))
        return materialise(met.select("own", "point", "label", _margin().alias("margin")), "scored")

    def f1(rows: DataFrame) -> DataFrame:
        said = rows.select("*", cuts.alias("cut"))
        said = said.withColumn("prediction", (F.col("margin") > F.col("cut.margin_cut")).cast("double"))
        keys = ["own", "point", F.col("cut.threshold").alias("threshold")]
        counts = said.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        return grouped_f1(counts, ["own", "point", "threshold"])

    held = scored(train, F.col("fold"))
    ranked = grouped_auroc(held, ["own", "point"], "margin", "label").groupBy("point").agg(F.avg("auroc").alias("mean_auroc"))
    mean = f1(held).groupBy("point", "threshold").agg(F.avg("f1").alias("mean_f1"))
    tested = f1(scored(test, F.lit(ALL))).select("point", "threshold", F.col("f1").alias("test_f1"))
    rows = [(i, float(p.reg), float(p.elastic)) for i, p in enumerate(points)]
    grid = spark.createDataFrame(rows, "point int, reg double, elastic double")
    out = mean.join(tested, ["point", "threshold"], "left").join(ranked, "point").join(grid, "point")
    return out.select("reg", "elastic", "threshold", "mean_auroc", "mean_f1", "test_f1")


def word_counts(texts: DataFrame, text: str, label: str, fold: str, stop_words: list[str]) -> DataFrame:
    """(fold, word, label, n, n_texts): occurrences and texts of each word, as written table.

    Each text is exploded twice, with all its words and with the distinct ones, so that both
    numbers come from one shuffle of partial sums.
    """
    words = texts.select(F.col(label).alias("label"), F.col(fold).cast("int").alias("fold"), word_tokens(text).alias("_all"))
    both = words.select("label", "fold", F.posexplode(F.array("_all", F.array_distinct("_all"))).alias("_kind", "_words"))
    kept = both.select("label", "fold", "_kind", F.explode("_words").alias("word"))
    kept = kept.where((F.col("word") != "") & ~F.col("word").isin(stop_words))
    counts = kept.groupBy("fold", "word", "label").agg(
        F.count_if(F.col("_kind") == 0).alias("n"), F.count_if(F.col("_kind") == 1).alias("n_texts")
    )
    return materialise(counts, "counts")


def _others(folds: int) -> Column:
    """The training sets that hold a row of ``fold``: those without another fold, and ``ALL``."""
    return F.explode(F.filter(F.sequence(F.lit(ALL), F.lit(folds - 1)), lambda f: f != F.col("fold"))).alias("without")


def training_counts(counts: DataFrame, folds: int, min_df: int) -> DataFrame:
    """(fold, word, label, n, n_texts) of each training set: what all folds but ``fold`` hold; ``ALL`` holds all.

    Words in fewer than ``min_df`` texts of all folds are in no vocabulary, and are left out.
    """
    often = counts.groupBy("word").agg(F.sum("n_texts").alias("_texts")).where(F.col("_texts") >= min_df)
    spread = counts.join(often, "word", "left_semi").select(_others(folds), "word", "label", "n", "n_texts")
    summed = spread.groupBy(F.col("without").alias("fold"), "word", "label")
    return summed.agg(F.sum("n").alias("n"), F.sum("n_texts").alias("n_texts"))


@dataclass
class Bayes:
    """Word counts of all training sets; the place of a fold is its number, that of ``ALL`` is the last."""

    words: list[str]  # of all vocabularies
    labels: np.ndarray  # ascending
    seen: np.ndarray  # folds x words x labels
    known: np.ndarray  # folds x words: 1 where the word is in the vocabulary
    texts: np.ndarray  # folds x labels


def _models(summed: DataFrame, vocabulary: DataFrame, priors: DataFrame, folds: int) -> Bayes:
    """The counts of the vocabularies, which are as many as the models have, whatever the number of texts."""
    inside = summed.join(vocabulary, ["fold", "word"]).select("fold", "word", F.col("label").cast("double").alias("label"), "n")
    found, texts = inside.toArrow(), priors.select("fold", F.col("label").cast("double").alias("label"), "texts").toArrow()
    labels = np.unique(texts["label"].to_numpy())
    words = pc.unique(found["word"])
    fold, word = found["fold"].to_numpy(), pc.index_in(found["word"], words).to_numpy()
    seen = np.zeros((folds + 1, len(words), len(labels)))
    seen[fold, word, np.searchsorted(labels, found["label"].to_numpy())] = found["n"].to_numpy()
    known = np.zeros((folds + 1, len(words)))
    known[fold, word] = 1.0
    own = np.zeros((folds + 1, len(labels)))
    own[texts["fold"].to_numpy(), np.searchsorted(labels, texts["label"].to_numpy())] = texts["texts"].to_numpy()
    return Bayes(words.to_pylist(), labels, seen, known, own)


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive lists of ``SCORED_WORDS`` elements in all, or one list of more."""
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SCORED_WORDS, "right")) - 1)
        yield low, high
        low = high


def _said(batches: Iterator[pa.RecordBatch], model, smoothings: list[float]) -> Iterator[pa.RecordBatch]:
    """(fold, label, words) -> how many rows of a fold and label each smoothing takes for which label."""
    m: Bayes = model.value
    n_words, n_labels = len(m.words), len(m.labels)
    weights: dict[tuple[int, float], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for fold in range(ALL, len(m.seen) - 1):
        if not m.known[fold].any():  # no vocabulary, no model
            continue
        total, texts = m.seen[fold].sum(0), m.texts[fold]
        for s in smoothings:
            gain = np.log((m.seen[fold] + s) / s)  # over a word that the class lacks
            with np.errstate(divide="ignore"):
                prior = np.where(texts > 0, np.log(texts + s) - np.log(texts.sum() + (texts > 0).sum() * s), -np.inf)
            weights[fold, s] = gain, prior, np.log(s) - np.log(total + m.known[fold].sum() * s)
    tally: dict[tuple[int, float, float, float], int] = {}
    for batch in batches:
        lists = batch.column(2)
        offsets = np.zeros(len(lists) + 1, np.int64)
        offsets[1:] = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        flat = lists.flatten()
        codes = pc.fill_null(pc.index_in(flat, pa.array(m.words, flat.type)), -1).to_numpy(zero_copy_only=False)
        folds, truth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for low, high in _runs(offsets):
            code = codes[offsets[low] : offsets[high]].astype(np.int64)
            row = np.repeat(np.arange(high - low), np.diff(offsets[low : high + 1]))
            cell, n = np.unique((row * n_words + code)[code >= 0], return_counts=True)
            row, code = cell // max(n_words, 1), cell % max(n_words, 1)
            for fold in np.unique(folds[low:high]).tolist():
                chosen = folds[low:high] == fold
                own = chosen[row] & (m.known[fold][code] > 0)
                at, c, times = row[own], code[own], n[own].astype(float)
                length = np.bincount(at, times, high - low)
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                for s in smoothings:
                    if (fold, s) not in weights:
                        continue
                    gain, prior, absent = weights[fold, s]
                    value = prior + length[:, None] * absent
                    for a in range(0, n_labels, SCORED_LABELS):
                        part = slice(a, a + SCORED_LABELS)
                        if len(at):
                            value[at[starts], part] += np.add.reduceat(times[:, None] * gain[c, part], starts)
                    said = m.labels[value[chosen].argmax(1)]  # equals: the smallest label
                    pairs, rows = np.unique(np.stack([truth[low:high][chosen], said]), axis=1, return_counts=True)
                    for y, p, k in zip(*pairs.tolist(), rows.tolist(), strict=True):
                        tally[fold, s, y, p] = tally.get((fold, s, y, p), 0) + k
    kinds = [pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    columns = zip(*[(*key, k) for key, k in tally.items()], strict=True) if tally else [[]] * 5
    arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["fold", "smoothing", "label", "prediction", "n"])


def bayes_search(
    texts: DataFrame,
    test: DataFrame,
    text: str,
    label: str,
    key: str,
    smoothings: list[float],
    folds: int = 5,
    min_df: int = 5,
    vocab_size: int = 10000,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Per smoothing the mean weighted F1 over the folds, and F1 on ``test``, of multinomial naive Bayes.

    ``texts`` has a ``_fold`` column. The vocabulary of a model is that of its training texts: the
    ``vocab_size`` commonest words (ties in alphabetical order) that ``min_df`` of them hold.
    """
    spark = texts.sparkSession
    labelled = texts.where(F.col(label).isNotNull() & F.col(key).isNotNull() & F.col("_fold").isNotNull())
    counts = word_counts(labelled, text, label, "_fold", stop_words or [])
    summed = materialise(training_counts(counts, folds, min_df), "training")
    whole = summed.groupBy("fold", "word").agg(F.sum("n").alias("n"), F.sum("n_texts").alias("n_texts"))
    often = whole.where(F.col("n_texts") >= min_df)
    first = top_rows_per_group(often, ["fold"], [F.desc("n"), F.asc("word")], vocab_size)
    vocabulary = materialise(first.select("fold", "word"), "vocabulary")
    priors = labelled.groupBy(F.col("_fold").cast("int").alias("fold"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    priors = priors.select(_others(folds), "label", "n").groupBy(F.col("without").alias("fold"), "label")
    model = spark.sparkContext.broadcast(_models(summed, vocabulary, priors.agg(F.sum("n").alias("texts")), folds))

    def predicted(rows: DataFrame, fold: Column) -> DataFrame:
        """F1 of (fold, smoothing) over rows scored by the model of their fold."""
        words = rows.select(fold.cast("int").alias("fold"), F.col(label).cast("double").alias("label"), word_tokens(text).alias("words"))
        said = words.mapInArrow(
            partial(_said, model=model, smoothings=smoothings), "fold int, smoothing double, label double, prediction double, n long"
        )
        counts = said.groupBy("fold", "smoothing", "label", "prediction").agg(F.sum("n").alias("n"))
        return grouped_f1(materialise(counts, "said"), ["fold", "smoothing"])

    held = predicted(labelled, F.col("_fold")).groupBy("smoothing").agg(F.avg("f1").alias("mean_f1"))
    tested = predicted(test.where(F.col(label).isNotNull() & F.col(key).isNotNull()), F.lit(ALL))
    return held.join(tested.select("smoothing", F.col("f1").alias("test_f1")), "smoothing", "left")
