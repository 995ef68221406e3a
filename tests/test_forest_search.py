"""Forests cut from one fit against Spark's own fits, and rows dealt to tasks."""

import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors

from millrace.lineage import materialise
from millrace.operators.forest_search import dealt, forest_search


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(4)
    rows = []
    for i in range(400):
        x = [r.random() for _ in range(4)]
        rows.append((i, i % 3, float(int(2.99 * x[0]) if r.random() < 0.7 else r.randrange(3)), Vectors.dense(x)))
    return materialise(spark.createDataFrame(rows, ["id", "_fold", "label", "features"]), "forest")


def test_cut_forests_equal_fits(table, monkeypatch):
    """All features at each node leave no draw to the depth, so forests of less depth are Spark's own."""
    fits, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: (fits.append(self), fit(self, df))[1])
    got = forest_search(table, table, "id", [6], [1, 2, 4], n_folds=3, seed=7, featureSubsetStrategy="all").collect()
    assert len(fits) == 4  # one a fold, and the best
    judge = MulticlassClassificationEvaluator(metricName="f1")
    want = []
    for depth in (1, 2, 4):
        forest = RandomForestClassifier(numTrees=6, maxDepth=depth, maxBins=32, seed=7, featureSubsetStrategy="all")
        want.append(sum(judge.evaluate(fit(forest, table.where(f"_fold != {f}")).transform(table.where(f"_fold = {f}"))) for f in range(3)) / 3)
    assert [r.point for r in got] == [f"numTrees=6, maxDepth={d}" for d in (1, 2, 4)]
    assert [r.mean_score for r in got] == pytest.approx(want, abs=1e-12)


def test_first_trees_are_a_forest(table):
    got = forest_search(table.where("label < 2"), table.where("label < 2"), "id", [1, 3, 9], [3], [8, 16], metric="auroc", n_folds=3, seed=7).collect()
    assert len(got) == 6 and all(0.6 < r.mean_score <= 1 for r in got) and len({r.best_test_f1 for r in got}) == 1
    assert len({r.mean_score for r in got}) > 3


def test_rows_of_a_task_are_bounded(table):
    own = dealt(table, "id", task_bytes=40 * 16)  # 40 rows of four features
    assert own.count() == 400 and own.rdd.getNumPartitions() == 10
    assert dealt(table, "id", task_bytes=1 << 14).rdd.getNumPartitions() == 7  # 6,400 bytes, 1,024 a task while there are cores
    assert dealt(table, "id").rdd.getNumPartitions() == table.rdd.getNumPartitions()
