"""Models of several classes that are fitted side by side against Spark's, each fitted by itself."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import mljobs as L
from millrace.operators import softmax_search as S
from millrace.operators.fold_search import ALL, Point
from millrace.operators.metrics import multiclass_summary

POINTS = [Point(0.0, 0.0), Point(0.1, 0.0), Point(0.1, 0.2), Point(0.3, 1.0)]
WORDS = 40


def counts(spark, n, n_classes):
    """Word counts as sparse vectors, a few dense; one word in all texts, one in none."""
    r = random.Random(n_classes)
    rows = []
    for i in range(n):
        y = r.randrange(n_classes)
        found = {0: 2.0}
        for _ in range(r.randint(0, 15)):
            w = 1 + (r.randrange(7) + 7 * y if r.random() < 0.4 else r.randrange(WORDS - 2))
            found[w] = found.get(w, 0.0) + 1.0
        v = Vectors.sparse(WORDS, found)
        rows.append((i, float(y), Vectors.dense(v.toArray()) if i % 50 == 0 else v))
    return L.with_folds(spark.createDataFrame(rows, ["id", "label", "features"]), "id", 3)


@pytest.mark.parametrize("n_classes, max_iter", [(4, 20), (2, 6)])
def test_models_equal_those_fitted_by_themselves(spark, n_classes, max_iter):
    df = counts(spark, 600, n_classes).coalesce(2).cache()
    models = S.fit_softmax(S.blocks(df), POINTS, [1, ALL], 3, WORDS, n_classes, max_iter=max_iter)
    assert len(models) == 8
    for m in models:
        solver = LogisticRegression(maxIter=max_iter, regParam=m.point.reg, elasticNetParam=m.point.elastic)
        fitted = solver.fit(df.where(F.col("_fold") != m.fold))
        weights, intercepts = m.plain()
        wanted, at = fitted.coefficientMatrix.toArray().T, fitted.interceptVector.toArray()
        if n_classes > 2:
            wanted, at = wanted[:, 1:] - wanted[:, :1], at[1:] - at[0]
        assert weights == pytest.approx(wanted, abs=1e-7)
        assert intercepts == pytest.approx(at, abs=1e-7)


@pytest.mark.parametrize("n_classes", [2, 4])
def test_search_equals_separate_fits(spark, n_classes):
    df = counts(spark, 400, n_classes).coalesce(2).cache()
    train, test = df.where("id < 300"), df.where("id >= 300").drop("_fold")
    got = S.softmax_search(train, test, [0.1], [0.0, 0.2], n_folds=3, max_iter=20).collect()
    means, tested = [], []
    for reg in (0.1,):
        for elastic in (0.0, 0.2):
            solver = LogisticRegression(maxIter=20, regParam=reg, elasticNetParam=elastic)
            folds = [
                solver.fit(train.where(F.col("_fold") != f)).transform(train.where(F.col("_fold") == f)) for f in range(3)
            ]
            means.append(np.mean([multiclass_summary(p).first().weighted_f1 for p in folds]))
            tested.append(multiclass_summary(solver.fit(train).transform(test)).first().weighted_f1)
    assert [r.mean_score for r in got] == pytest.approx(means, abs=1e-12)
    assert [r.best_test_f1 for r in got] == pytest.approx([tested[int(np.argmax(means))]] * 2, abs=1e-12)
    assert got[1].point == "regParam=0.1, elasticNetParam=0.2"


def test_few_rows_labels_and_folds(spark):
    """No rows, one label only, a fold without rows, rows without label or words, and pieces of few elements."""
    df = counts(spark, 60, 3).coalesce(2)
    assert S.softmax_search(df.limit(0), df, [0.1], [0.0], n_folds=3).collect() == []
    same = df.withColumn("label", F.lit(1.0))
    assert [(r.mean_score, r.best_test_f1) for r in S.softmax_search(same, same.drop("_fold"), [0.1], [0.0, 0.5], n_folds=3).collect()] == [(1.0, 1.0)] * 2
    gaps = df.withColumn("label", F.when(F.col("id") % 9 > 0, F.col("label"))).where("_fold != 1")
    got = S.softmax_search(gaps, df.drop("_fold").limit(0), [0.1], [0.0], n_folds=3).collect()
    assert 0 < got[0].mean_score <= 1 and got[0].best_test_f1 is None


def test_sums_do_not_depend_on_blocks_and_pieces(spark, monkeypatch):
    df = counts(spark, 300, 3).coalesce(1)
    for name, size in (("ROWS", 40), ("DENSE", 0.3), ("PIECE", 7)):
        monkeypatch.setattr(S, name, size)
    v = F.unwrap_udt("features")
    rows = df.where(F.col("id") % 50 > 0).select("_fold", "label", v["indices"].alias("indices"), v["values"].alias("values"))
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    parts = [S._Block(row) for b in S._blocks(iter([batch])) for row in b.to_pylist()]
    assert len(parts) >= 8 and any(len(p.other_rows) > 7 for p in parts) and any(len(p.columns) for p in parts)
    weights = np.random.default_rng(0).normal(size=(WORDS, 5))
    ordered = df.where(F.col("id") % 50 > 0).orderBy("_fold", "label", "id").collect()
    vectors = np.array([r.features.toArray() for r in ordered])
    assert np.concatenate([p.times(weights) for p in parts]) == pytest.approx(vectors @ weights)
    of_rows = np.array([(r.label + 1.0, r._fold) for r in ordered])
    total = np.zeros((WORDS, 2))
    for p in parts:
        p.add_to(total, np.stack([p.labels + 1.0, np.full(len(p.labels), p.fold)], axis=1))
    assert total == pytest.approx(vectors.T @ of_rows)


def test_blocks_are_read_a_row_group_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 1)
    table = S.blocks(counts(spark, 300, 3).repartition(11))
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in table.inputFiles()]
    assert sum(m.num_rows for m in files) == sum(m.num_row_groups for m in files) >= 9  # each holds one row
    assert table.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sum(len(row.labels) // 4 for row in table.collect()) == 300


def test_sums_are_added_as_they_come():
    batches = (b for v in range(1, 5) for b in S._emit(np.arange(5.0) * v))
    assert np.frombuffer(next(S._add(batches)).column(1)[0].as_py()).tolist() == [0, 10, 20, 30, 40]


def test_values_are_packed_exactly():
    for values in ([1, 255], [0, 256, 65535], [65536], [-1, 2], [0.5], []):
        wanted = np.array(values, float)
        assert S._unpacked(S._packed(wanted), len(values)).tolist() == values
    assert [len(S._packed(np.array(v, float))) for v in ([3, 4], [3, 400], [3, 4.5])] == [2, 4, 16]


def test_models_meet_the_columns_they_use(spark):
    df = counts(spark, 300, 3).coalesce(1)
    parts = [b for b in S._read(iter(S.blocks(df).toArrow().combine_chunks().to_batches()))]
    weights = np.random.default_rng(0).normal(size=(WORDS, 4)) * (np.arange(WORDS)[:, None] % 5 == 0)
    for b in parts:
        assert b.times(weights, (weights != 0).any(axis=1)) == pytest.approx(b.times(weights), abs=1e-12)


def test_rows_of_one_task_are_dealt_out(spark, monkeypatch):
    df = counts(spark, 300, 3).coalesce(1)
    monkeypatch.setattr(S, "ROWS", 60)
    table = S.blocks(df)
    assert len(table.inputFiles()) > 1 and sum(len(row.labels) // 4 for row in table.collect()) == 300
