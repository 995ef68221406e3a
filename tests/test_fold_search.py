"""Searches from additive statistics against models that are fitted anew on each training set."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.operators import fold_search as FS
from millrace.operators import mljobs as L
from millrace.operators.metrics import multiclass_summary


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(3)
    rows = []
    for i in range(500):
        y = int(r.random() < 0.3)
        x = [r.gauss(1.2 * y, 1.0), 100 + 5 * r.gauss(-y, 2.0), r.gauss(0, 0.1), 4.0]  # the last one is constant
        rows.append((i, float(y), x))
    df = spark.createDataFrame(rows, "id int, label double, features array<double>")
    return FS.prepared(L.with_folds(df, "id", 3))


GRID = [FS.Point(0.0, 0.0), FS.Point(0.01, 1.0), FS.Point(0.1, 0.0), FS.Point(0.1, 0.4)]


def test_logistic_models_equal_those_fitted_anew(points):
    vectors = points.withColumn("features", array_to_vector("features")).cache()
    for model in FS.fit_logistic(points, GRID, [0, 1, 2]):
        solver = LogisticRegression(regParam=model.point.reg, elasticNetParam=model.point.elastic, maxIter=500, tol=1e-13)
        fitted = solver.fit(vectors.where(F.col("fold") != model.fold))
        assert model.weights[:-1] == pytest.approx(fitted.coefficients.toArray(), abs=2e-5)
        assert model.weights[-1] == pytest.approx(fitted.intercept, abs=2e-3)


def test_search_equals_scoring_each_fold(points):
    train, test = points.where("fold != 2"), points.where("fold = 2")
    got = FS.logistic_search(train, test, [0.0, 0.1], [0.0, 1.0], [0.3, 0.5], folds=2).collect()
    assert len(got) == 8
    vectors = train.withColumn("features", array_to_vector("features")).cache()
    for row in got:
        f1, auroc = [], []
        for fold in (0, 1):
            solver = LogisticRegression(
                regParam=row.reg, elasticNetParam=row.elastic, threshold=row.threshold, maxIter=500, tol=1e-13
            )
            pred = solver.fit(vectors.where(F.col("fold") != fold)).transform(vectors.where(F.col("fold") == fold))
            f1.append(multiclass_summary(pred).first().weighted_f1)
            auroc.append(BinaryClassificationEvaluator(numBins=0).evaluate(pred))
        assert row.mean_f1 == pytest.approx(np.mean(f1), abs=1e-9)
        assert row.mean_auroc == pytest.approx(np.mean(auroc), abs=1e-9)
        assert 0 < row.test_f1 <= 1


def test_separable_rows_and_one_class(spark):
    """Without a penalty the weights of separable rows grow; the passes end, and the order of the rows is right."""
    rows = [(i % 2, float(i >= 20), [float(i)]) for i in range(40)]
    train = spark.createDataFrame(rows, "fold int, label double, features array<double>")
    models = FS.fit_logistic(train, [FS.Point(0.0, 0.0), FS.Point(1.0, 0.0)], [0, 1], max_passes=30)
    assert all(np.isfinite(m.weights).all() and m.weights[0] > 0 for m in models) and len(models) == 6
    same = train.withColumn("label", F.lit(1.0))
    assert all(np.isfinite(m.weights).all() for m in FS.fit_logistic(same, [FS.Point(0.1, 0.0)], [0, 1], max_passes=30))
    assert FS.fit_logistic(train.limit(0), GRID, [0]) == []


def test_bayes_equals_models_fitted_anew(spark):
    r = random.Random(4)
    own = [["cat", "dog", "the"], ["chat", "chien", "the"], ["gato", "perro", "the"]]
    rows = []
    for i in range(150):
        c = i % 3
        words = [r.choice(own[c] if r.random() < 0.6 else own[r.randrange(3)]) for _ in range(r.randint(0, 6))]
        rows.append((i, None if i == 7 else float(c), " ".join(words)))
    texts = L.with_folds(spark.createDataFrame(rows, "id int, label double, text string"), "id", 3).cache()
    train, test = texts.where("id < 120"), texts.where("id >= 120")
    got = FS.bayes_search(train, test, "text", "label", "id", [0.5, 1.0], folds=3, min_df=4, vocab_size=6, stop_words=["the"])
    got = {g.smoothing: g for g in got.collect()}
    labelled = train.where("label IS NOT NULL")
    for smoothing in (0.5, 1.0):
        f1 = []
        for fold in (0, 1, 2, None):
            seen = labelled if fold is None else labelled.where(F.col("_fold") != fold)
            held = test if fold is None else labelled.where(F.col("_fold") == fold)
            words = [v.word for v in L.vocabulary(seen, "text", 6, 4, ["the"]).collect()]
            steps = L._words("text", ["the"])
            counter = CountVectorizerModel.from_vocabulary(words, inputCol="_kept", outputCol="features")

            def ready(df, counter=counter, steps=steps):
                for step in steps:
                    df = step.transform(df)
                return counter.transform(df)

            pred = NaiveBayes(smoothing=smoothing).fit(ready(seen)).transform(ready(held))
            f1.append(multiclass_summary(pred).first().weighted_f1)
        assert got[smoothing].mean_f1 == pytest.approx(np.mean(f1[:3]), abs=1e-12)
        assert got[smoothing].test_f1 == pytest.approx(f1[3], abs=1e-12)


def test_areas_by_group(spark):
    rows = [("a", 1.0, 1), ("a", 0.5, 0), ("a", 0.5, 1), ("b", 0.1, 1), ("b", 0.9, 0), ("c", 0.3, 1)]
    got = FS.grouped_auroc(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], "s", "y").collect()
    areas = {r.g: r.auroc for r in got}
    assert areas["a"] == 0.75 and areas["b"] == 0.0 and areas["c"] is None


def test_counts_have_no_row_for_each_text(spark, rows):
    texts = [(i, 0, 1.0, "a a b") for i in range(50)] + [(60, 1, 1.0, "the, A"), (61, 1, 0.0, None)]
    df = spark.createDataFrame(texts, "id int, _fold int, label double, text string")
    counts = FS.word_counts(df, "text", "label", "_fold", ["the"])
    assert rows(counts) == [(0, "a", 1.0, 100, 50), (0, "b", 1.0, 50, 50), (1, "a", 1.0, 1, 1)]
    assert rows(FS.training_counts(counts, 2, 51)) == [(-1, "a", 1.0, 101, 51), (0, "a", 1.0, 1, 1), (1, "a", 1.0, 100, 50)]


def test_scores_do_not_depend_on_the_pieces(monkeypatch):
    """Texts in pieces of a few words and labels one by one; a text without words, and one longer than a piece."""
    r = np.random.default_rng(1)
    seen = r.integers(0, 9, (3, 5, 4)).astype(float)
    model = FS.Bayes(list("abcde"), np.arange(4.0), seen, (seen.sum(2) > 0) * 1.0, np.full((3, 4), 2.0))
    words = [None, [], list("abcdeabcdezz"), *[list(r.choice(list("abcdexy"), 4)) for _ in range(40)]]
    columns = [[i % 3 - 1 for i in range(len(words))], [float(i % 4) for i in range(len(words))], words]
    kinds = [pa.int32(), pa.float64(), pa.list_(pa.string())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["fold", "label", "words"])

    def said():
        (out,) = FS._said(iter([batch]), SimpleNamespace(value=model), [0.5, 1.0])
        return sorted(tuple(x.values()) for x in out.to_pylist())

    whole = said()
    assert sum(x[-1] for x in whole) == 2 * len(words)
    monkeypatch.setattr(FS, "SCORED_WORDS", 3)
    monkeypatch.setattr(FS, "SCORED_LABELS", 1)
    assert said() == whole
