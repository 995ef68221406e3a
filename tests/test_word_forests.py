"""Forests grown side by side against Spark's own fits, and draws that don't depend on how rows are dealt."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators import mljobs as L
from millrace.operators import word_forests as W
from millrace.plans import ml_queries
from millrace.plans.registry import Tables

WORDS = 31


@pytest.fixture(scope="module")
def counts(spark):
    """Sparse vectors, a few dense; some features of many values, below zero too, and one that no row has."""
    r = random.Random(3)
    rows = []
    for i in range(700):
        y, found = r.randrange(3), {}
        for _ in range(r.randint(0, 15)):
            w = r.randrange(7) + 7 * y if r.random() < 0.3 else r.randrange(WORDS - 1)
            found[w] = found.get(w, 0.0) + (3 * r.random() - 1 if w % 5 == 0 else 1.0)
        v = Vectors.sparse(WORDS, found)
        rows.append((i, float(y), Vectors.dense(v.toArray()) if i % 50 == 0 else v))
    return materialise(L.with_folds(spark.createDataFrame(rows, ["id", "label", "features"]), "id", 3), "counts")


def scores(df):
    return [tuple(r) for r in df.collect()]


def test_trees_without_draws_are_sparks(counts):
    train, test = counts.where("id < 500"), counts.where("id >= 500").drop("_fold")
    judge = MulticlassClassificationEvaluator(metricName="f1")
    means, tested = [], []
    for depth in (1, 2, 4):
        tree = RandomForestClassifier(numTrees=1, maxDepth=depth, maxBins=6, featureSubsetStrategy="all", bootstrap=False)
        folds = [tree.fit(train.where(F.col("_fold") != f)).transform(train.where(F.col("_fold") == f)) for f in range(3)]
        means.append(np.mean([judge.evaluate(p) for p in folds]))
        tested.append(judge.evaluate(tree.fit(train).transform(test)))
    got = W.word_forest_search(train, test, "id", [1], [1, 2, 4], 6, n_folds=3, every_feature=True, bootstrap=False).collect()
    assert [r.point for r in got] == [f"numTrees=1, maxDepth={d}" for d in (1, 2, 4)]
    assert [r.mean_score for r in got] == pytest.approx(means, abs=1e-12)
    assert [r.best_test_f1 for r in got] == pytest.approx([tested[int(np.argmax(means))]] * 3, abs=1e-12)


def test_draws_do_not_depend_on_partitions_and_passes(counts, monkeypatch):
    test = counts.where("id < 200")
    want = scores(W.word_forest_search(counts, test, "id", [3, 9], [2, 3], n_folds=3))
    assert all(0.4 < mean <= 1 for _, mean, _ in want) and len({mean for _, mean, _ in want}) == 4
    monkeypatch.setattr(W, "CELLS", 1000)  # a pass for each tree
    monkeypatch.setattr(W, "ROWS", 100)  # seven tasks
    assert scores(W.word_forest_search(counts.coalesce(1), test, "id", [3, 9], [2, 3], n_folds=3)) == want


def test_rows_are_drawn_with_replacement():
    drawn = W._poisson(np.random.default_rng(0).integers(0, 2**64, 5000, np.uint64), np.arange(20))
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    assert abs(np.corrcoef(drawn)[np.triu_indices(20, 1)]).max() < 0.07


def test_few_rows_labels_and_folds(counts):
    """No rows, one label only, a fold without rows, rows without a label or key, and only one fold."""
    assert W.word_forest_search(counts.limit(0), counts, "id", [3], [2], n_folds=3).collect() == []
    same = counts.withColumn("label", F.lit(1.0))
    assert [r[1:] for r in scores(W.word_forest_search(same, same, "id", [1, 3], [2], n_folds=3))] == [(1.0, 1.0)] * 2
    gaps = counts.where("_fold <> 1").withColumn("label", F.when(F.col("id") % 9 > 0, F.col("label")))
    gaps = gaps.withColumn("id", F.when(F.col("id") % 2 > 0, F.col("id")))
    got = scores(W.word_forest_search(gaps, counts.limit(0), "id", [5], [3], n_folds=3))
    assert 0 < got[0][1] <= 1 and got[0][2] is None
    one = scores(W.word_forest_search(counts.where("_fold = 1"), counts, "id", [5], [3], n_folds=3))
    assert one[0][1] is None and 0 < one[0][2] <= 1


def test_query_holds_no_dense_rows(spark, tmp_path, monkeypatch):
    """The words of a text go to the forests as they are; a fit of Spark's keeps a number for each word of the vocabulary."""
    r = random.Random(1)
    texts = [(i, " ".join(f"{'ab'[i % 2] if r.random() < 0.6 else 'c'}{r.randrange(30)}" for _ in range(20)), "xy"[i % 2]) for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *_: pytest.fail("a fit on dense rows"))
    got = ml_queries.tuned_text_forest(Tables(spark, str(tmp_path))).collect()
    assert len(got) == 9 and all(r.mean_score > 0.8 and r.best_test_f1 > 0.8 for r in got)


def test_elements_taken_at_once_are_bounded(monkeypatch):
    lists = [[1, 2, 3], [], [4], [5, 6, 7, 8, 9], [0], [1]]
    columns = pa.array(lists, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(6))] * 3 + [columns, columns.cast(pa.list_(pa.float64()))], names=list("abcde"))
    monkeypatch.setattr(W, "HELD", 4)
    parts = list(W._slices(iter([batch])))
    assert [p.num_rows for p in parts] == [3, 1, 2]
    assert [W._flat(p)[1].tolist() for p in parts] == [[1, 2, 3, 4], [5, 6, 7, 8, 9], [1]]
