"""Text counts, series, statistics, models, recommendation."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import mljobs as L
from millrace.operators import recommend as R
from millrace.operators import series as S
from millrace.operators import stats as Q
from millrace.operators import textcount as W
from millrace.plans import ml_queries
from millrace.plans.registry import Tables


def lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value string")


def test_the_echo_line(spark, rows):
    echo = lines(spark, "foo foo quux labs foo bar quux")
    want = [("bar", 1), ("foo", 3), ("labs", 1), ("quux", 2)]
    assert all(rows(W.word_count(echo, mode)) == want for mode in ("space", "whitespace", "pig"))


def test_dialects_differ(spark, rows):
    text = lines(spark, 'a  b\t"c"', "", " a")
    assert rows(W.word_count(text, "space")) == [("", 3), ("a", 2), ('b\t"c"', 1)]
    assert rows(W.word_count(text, "whitespace")) == [('"c"', 1), ("a", 2), ("b", 1)]
    assert rows(W.word_count(text, "pig")) == [("a", 2), ("b\t", 1), ("c", 1)]


def test_lines_and_characters(spark, rows):
    text = lines(spark, "hello world", "hello world", "", "né 日")
    assert rows(W.line_count(text)) == [("", 1), ("hello world", 2), ("né 日", 1)]
    got = dict(rows(W.char_count(text)))
    assert got["l"] == 6 and got["é"] == 1 and got["日"] == 1 and " " not in got and "" not in got


def test_bad_counts_are_skipped(spark, rows):
    pairs = W.parse_pairs(lines(spark, "a\t1", "a\t2", "a\tx", "b\t3\t4", "c", "d\t-1"))
    assert rows(W.sum_counts(pairs, "word", "count")) == [("a", 3), ("d", -1)]


def test_series(spark, rows):
    df = spark.createDataFrame(
        [("2014-12-31", "A", 1.0, None), ("2015-01-01", "A", 2.0, "Q"), ("2015-06-01", "B", 4.0, " ")],
        "day string, k string, v double, flag string",
    ).withColumn("day", F.to_date("day"))
    assert rows(S.resample_year(df, "day", "v")) == [(2014, 1.0), (2015, 3.0)]
    assert rows(S.pivot_mean(df.withColumn("y", F.year("day")), ["y"], "k", "v", ["A", "B", "C"])) == [
        (2014, 1.0, None, None),
        (2015, 2.0, 4.0, None),
    ]
    assert S.only_unflagged(df, "flag").count() == 2
    assert [tuple(r) for r in S.ranked(df.select("v"), "v", []).orderBy("rank").collect()] == [(4.0, 1), (2.0, 2), (1.0, 3)]


def test_regional_daily(spark, rows):
    fact = spark.createDataFrame([("a", 1, "W", 2.0), ("b", 1, "W", 4.0), ("c", 1, "W", 9.0), ("a", 1, "P", 7.0)], "id string, day int, e string, v double")
    dim = spark.createDataFrame([("a", "US", "NY"), ("b", "US", "NY"), ("c", "NZ", "")], "id string, country string, state string")
    got = S.regional_daily(fact, dim, "id", F.col("e") == "W", F.col("country") == "US", ["day", "state"], "v")
    assert rows(got) == [(1, "NY", 3.0)]


def test_statistics(spark, rows):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 6.0)], "a int, b double")
    described = {r["column"]: r for r in Q.describe_long(df, ["a", "b"]).collect()}
    assert described["b"]["count"] == 2 and described["b"]["mean"] == 4.0 and described["a"]["max"] == 3.0
    assert rows(Q.column_profile(df)) == [("a", "int", 3), ("b", "double", 2)]
    bins = rows(Q.histogram(spark.range(11).withColumn("x", F.col("id") * 1.0), "x", 10), "bin", "n")
    assert bins == [(i, 1 if i < 9 else 2) for i in range(10)]
    same = rows(Q.histogram(df.filter("b = 2"), "b"), "bin", "n")
    assert same == [(0, 1)]
    assert rows(Q.histogram(df.filter("b > 99"), "b"), "bin", "n") == []
    assert rows(Q.class_balance(df, "a"))[0] == (1, 1, pytest.approx(1 / 3))
    corr = {(r["a"], r["b"]): r["corr"] for r in Q.corr_matrix(df, ["a", "b"]).collect()}
    assert corr["a", "b"] == pytest.approx(1.0) and len(corr) == 4


def test_label_index_ties_alphabetically(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert rows(L.index_label(df, "x", "i")) == [("a", 1), ("b", 2), ("c", 0), ("c", 0), (None, None)]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    data = []
    for i in range(400):
        y = int(i % 5 == 0)
        data.append((i, y, *[rng.gauss(2.0 * y * (j < 3), 1 + j) for j in range(6)]))
    return spark.createDataFrame(data, "id int, label int, " + ", ".join(f"f{j} double" for j in range(6))).cache()


COLS = [f"f{j}" for j in range(6)]


@pytest.fixture(scope="module")
def features(points):
    return L.reduce_features(COLS, 5).fit(points).transform(points).select("id", "label", "features").cache()


def test_component_variance_falls(points):
    model = L.reduce_features(COLS, 5).fit(points)
    shares = list(model.stages[-1].explainedVariance.toArray())
    assert len(shares) == 5 and shares == sorted(shares, reverse=True)


def test_models_are_compared_over_training_sets(features):
    train, test = features.filter("id % 4 <> 0"), features.filter("id % 4 = 0")
    models = {"lr": LogisticRegression()}
    out = L.compare(models, {"all": train, "half": train.filter("id % 2 = 0")}, test).collect()
    assert [(r["train_set"], r["model"], r["total"]) for r in out] == [("all", "lr", 100), ("half", "lr", 100)]
    assert all(0.7 < r["auroc"] <= 1 and 0.7 < r["accuracy"] <= 1 for r in out)


def test_weights_and_threshold_raise_recall(features):
    train, test = features.filter("id % 4 <> 0"), features.filter("id % 4 = 0")
    weighted = train.withColumn("w", F.when(F.col("label") == 1, 10.0).otherwise(1.0))
    plain = L.train_eval("p", LogisticRegression(), train, test).first()
    heavy = L.train_eval("w", LogisticRegression(), weighted, test, weight_col="w").first()
    low = L.train_eval("t", LogisticRegression(), weighted, test, weight_col="w", threshold=0.2).first()
    assert plain["recall"] <= heavy["recall"] <= low["recall"]
    assert low["predicted_positive"] > plain["predicted_positive"]


def test_grid_applies_to_the_estimator(features):
    search = L.tune(LogisticRegression(maxIter=10), {"regParam": [0.0, 100.0]}, L.f1_evaluator(), folds=2)
    best = search.fit(L.with_folds(features, "id", 2))
    assert best.avgMetrics[0] > best.avgMetrics[1]
    assert best.bestModel.getRegParam() == 0.0
    folds = L.with_folds(features, "id", 5).groupBy("_fold").count().collect()
    assert {r["_fold"] for r in folds} == {0, 1, 2, 3, 4}


def test_every_classifier_fits(features):
    train, test = features.filter("id % 4 <> 0"), features.filter("id % 4 = 0")
    for name, model in L.binary_classifiers().items():
        assert L.train_eval(name, model, train, test).first()["total"] == 100


def test_text_features(spark):
    texts = ["The cat sat; the CAT ran", "a cat, a dog", "the dog http", "dog cat", "cat dog bird"]
    df = spark.createDataFrame([(i, float(i % 2), x) for i, x in enumerate(texts)], "id int, label double, text string")
    model = L.bag_of_words(df, "text", vocab_size=3, min_df=2)
    assert model.stages[-1].vocabulary == ["cat", "dog"]
    want = [tuple(r) for r in L.vocabulary(df, "text", vocab_size=3, min_df=2).collect()]
    assert want == [("cat", 5, 4), ("dog", 4, 4)]
    assert sorted(tuple(r) for r in L.vector_totals(model.transform(df)).collect()) == [(0, 4, 5.0), (1, 4, 4.0)]
    fitted = CountVectorizer(inputCol="_kept", outputCol="x", vocabSize=3, minDF=2).fit(model.transform(df).drop("x"))
    assert fitted.vocabulary == ["cat", "dog"]
    kept = L.bag_of_words(df, "text", min_df=1, keep_default=True)
    assert "a" not in kept.stages[-1].vocabulary and "a" in StopWordsRemover.loadDefaultStopWords("english")
    weights = L.tf_idf(df, "text", n_features=64, min_doc_freq=2).transform(df)
    assert weights.select(F.size(F.filter(vector_to_array("features"), lambda x: x != 0))).first()[0] > 0
    scores = L.train_eval_multiclass("nb", L.multiclass_classifiers()["naive_bayes"], model.transform(df), model.transform(df))
    assert 0 <= scores.first()["accuracy"] <= 1


def test_recommendation(spark):
    pairs = [(f"u{u}", f"i{i}", 1 + (u + i) % 3) for u in range(30) for i in range(20) if (u % 2) == (i % 2) and (u * i) % 3]
    df = R.index_pairs(spark.createDataFrame(pairs, "u string, i string, n int"), "u", "i", "user", "item").cache()
    assert dict(df.dtypes)["user"] == "int"
    ids = {r[0] for r in df.select("user").distinct().collect()}
    assert ids == set(range(len(ids)))
    model = R.fit_als(df, "user", "item", "n", rank=4)
    known = df.limit(5).select("user", "item")
    unknown = spark.createDataFrame([(9999, 0)], "user int, item int")
    scored = R.score(model, known.union(unknown)).collect()
    assert len(scored) == 5 and [(r["user"], r["item"]) for r in scored] == sorted((r["user"], r["item"]) for r in scored)
    top = R.recommend(model, 4).collect()
    assert len(top) == len(ids) and all(len(set(r["recommended"])) == 4 for r in top)


def test_training_rows_are_written_by_numbers_alone(spark, monkeypatch):
    """Ids are kept for the rows to be scored; what is fitted, and what is scored, is split by the hash of the ids as ever."""
    written, fitted, write = {}, {}, ml_queries.materialise
    monkeypatch.setattr(ml_queries, "materialise", lambda df, name: written.setdefault(name, write(df, name)))
    monkeypatch.setattr(ml_queries.recommend, "fit_als", lambda df, *cols: fitted.setdefault(cols, df))
    train, test = ml_queries._fitted(Tables(spark, "/root/testdata/sf0.001"))
    assert list(fitted) == [("user", "item", "plays")] and train.columns == ["user", "item", "plays"]
    stored = written["indexed"].where("in_train")
    assert stored.count() > 0 and stored.where("user_id IS NOT NULL OR item_id IS NOT NULL").count() == 0
    rows = R.index_pairs(written["plays"], "user_id", "item_id", "user", "item")
    halves = ml_queries._halves(rows, ["user_id", "item_id"], "r2", 0.7)
    for got, expected in zip((train, test), halves, strict=True):
        expected = expected.select(got.columns)
        assert got.count() == expected.count() > 0 and got.exceptAll(expected).isEmpty()
