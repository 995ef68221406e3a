import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RankingEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from millrace.operators import metrics as M


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    data = [(float(rng.random() < 0.3), rng.choice([0.1, 0.2, 0.5, rng.random()])) for _ in range(2000)]
    return spark.createDataFrame(data, "label double, score double").withColumn(
        "prediction", (F.col("score") > 0.4).cast("double")
    ).cache()


def test_auroc_equals_the_evaluator(scored):
    got = M.auroc(scored, "score", "label").first()[0]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert got == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_binary_metrics(scored):
    got = M.binary_metrics(scored).first()
    assert got["total"] == got["positive"] + got["negative"] == 2000
    assert got["tp"] + got["fp"] == got["predicted_positive"]
    for name, metric in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")):
        evaluator = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0)
        assert got[name] == pytest.approx(evaluator.evaluate(scored))


def test_nothing_predicted_scores_zero(scored):
    got = M.binary_metrics(scored.withColumn("prediction", F.lit(0.0))).first()
    assert (got["tp"], got["precision"], got["recall"], got["f1"]) == (0, 0.0, 0.0, 0.0)


def test_multiclass_equals_the_evaluator(spark):
    rng = random.Random(2)
    data = [(float(rng.choice([0, 0, 0, 1, 2, 3])), float(rng.randrange(3))) for _ in range(800)]
    pred = spark.createDataFrame(data, "label double, prediction double")
    got = M.multiclass_summary(pred).first()
    for name, metric in (
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("weighted_f1", "f1"),
        ("accuracy", "accuracy"),
    ):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(pred))
    classes = {r["label"]: r for r in M.per_class_metrics(pred).collect()}
    assert classes[3.0]["n_predicted"] == 0 and classes[3.0]["precision"] == 0.0 and classes[3.0]["f1"] == 0.0


def test_rmse_skips_missing_predictions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, float("nan")), (5.0, 2.0)], "label double, prediction double")
    known = df.filter("NOT isnan(prediction)")
    assert M.rmse(df, "label", "prediction").first()[0] == pytest.approx(RegressionEvaluator().evaluate(known))


def test_ranking_metrics_equal_the_evaluator(spark):
    rng = random.Random(4)
    data = [
        (
            [float(x) for x in rng.sample(range(30), rng.choice([3, 10]))],
            [float(x) for x in rng.sample(range(30), rng.choice([0, 1, 4, 15]))],
        )
        for _ in range(60)
    ]
    df = spark.createDataFrame(data, "prediction array<double>, label array<double>")
    columns = {"recommended": "prediction", "relevant": "label"}
    want = {
        "precisionAtK": M.precision_at(df, 5, **columns),
        "ndcgAtK": M.ndcg_at(df, 5, **columns),
        "meanAveragePrecision": M.mean_average_precision(df, **columns),
    }
    for metric, got in want.items():
        assert got.first()[0] == pytest.approx(RankingEvaluator(metricName=metric, k=5).evaluate(df)), metric


def test_missing_labels_and_values(spark):
    """Rows without a label neither count as negatives nor are thinned; a correlation uses the rows with both values."""
    from millrace.operators import metrics, sampling, stats

    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0), (0.95, None)], "score double, label int")
    assert metrics.auroc(scored, "score", "label").first()[0] == 0.75
    rows = [(i, 0) for i in range(900)] + [(900 + i, 1) for i in range(50)] + [(950 + i, None) for i in range(200)]
    kept = sampling.downsample(spark.createDataFrame(rows, "id int, label int"), "label", 0, 1.0, "id", 1)
    assert kept.where("label IS NULL").count() == 200
    pairs = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 3.0, 1.0), (3.0, 2.0, 2.0), (4.0, 3.0, None)], "a double, b double, c double")
    want = pairs.selectExpr("corr(a, b)").first()[0]
    assert stats.corr_matrix(pairs, ["a", "b", "c"]).where("a = 'a' AND b = 'b'").first()["corr"] == want
