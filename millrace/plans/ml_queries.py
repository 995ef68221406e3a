"""Models, tuning and recommendation. Fitted numbers have no SQL twin: the driver
checks that rows come out, and the tests check what must hold of them."""

from __future__ import annotations

from functools import partial

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import hash_below, hash_threshold
from millrace.lineage import materialise
from millrace.operators import fold_search as FS
from millrace.operators import mljobs as L
from millrace.operators import ranking as R
from millrace.operators import recommend
from millrace.operators import sampling as X
from millrace.operators.forest_search import dealt, forest_search
from millrace.operators.joins import union_all
from millrace.operators.softmax_search import softmax_search
from millrace.operators.word_forests import word_forest_search
from millrace.plans.registry import Tables, query
from millrace.plans.views import FEATURES, feat, plays


def _halves(df: DataFrame, key: str | list[str], seed: str, fraction: float) -> tuple[DataFrame, DataFrame]:
    in_train = hash_below(key, seed, fraction)
    return df.filter(in_train), df.filter(~in_train)


@query()
def pca_features(t: Tables) -> DataFrame:
    rows = feat(t)
    train, _ = _halves(rows, "vec_id", "pca", 0.8)
    model = L.reduce_features(FEATURES, 5).fit(train)
    parts = vector_to_array("features")
    return model.transform(rows).select(
        "vec_id", *[F.get(parts, F.lit(i)).alias(f"pc{i + 1}") for i in range(5)]
    )


def _binary(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, one label against the others, with features fitted on the training rows."""
    marked = feat(t).withColumn("class", (F.col("label") == 0).cast("int")).drop("label")
    split = materialise(X.stratified_split_exact(marked, "class", 0.8, "vec_id", "l6"), "split")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    model = L.reduce_features(FEATURES, 5).fit(train)
    ready = [model.transform(df).select("vec_id", F.col("class").alias("label"), "features") for df in (train, test)]
    return materialise(ready[0], "train"), materialise(ready[1], "test")


@query()
def binary_models(t: Tables) -> DataFrame:
    train, test = _binary(t)
    calls = [partial(L.train_eval, name, m, train, test) for name, m in L.binary_classifiers().items()]
    return union_all(L.side_by_side(t.spark, calls))


@query()
def weighted_model(t: Tables) -> DataFrame:
    train, test = _binary(t)
    weighted = X.class_weights(train, "label", {0: 1.0, 1: 10.0})
    model = LogisticRegression()
    return union_all(
        [
            L.train_eval("weighted", model, weighted, test, weight_col="weight"),
            L.train_eval("weighted, threshold 0.4", model, weighted, test, weight_col="weight", threshold=0.4),
        ]
    )


@query()
def compare_models(t: Tables) -> DataFrame:
    """Three models on the training rows as they are, thinned, and thinned and multiplied."""
    train, test = _binary(t)
    thinned = materialise(X.downsample(train, "label", 0, 6.0, "vec_id", "l11"), "thinned")
    multiplied = materialise(X.oversample(thinned, "label", 1, 10, 0.6, "vec_id", "l11").drop("copy"), "multiplied")
    variants = {"as is": train, "downsampled": thinned, "down- and oversampled": multiplied}
    return L.compare(L.binary_classifiers(), variants, test)


def _balanced(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Training rows thinned and multiplied, with the fold of their key, and test rows."""
    train, test = _binary(t)
    thinned = X.downsample(train, "label", 0, 6.0, "vec_id", "l11")
    multiplied = X.oversample(thinned, "label", 1, 10, 0.6, "vec_id", "l11").drop("copy")
    return L.with_folds(multiplied, "vec_id", 5), test


# The grids of the searches.


@query()
def tuned_model(t: Tables) -> DataFrame:
    """Penalties and thresholds of a logistic regression, all models of five folds side by side."""
    train, test = _balanced(t)
    rows = FS.prepared(train), FS.prepared(test.withColumn("_fold", F.lit(0)))
    return FS.logistic_search(*rows, [0.0, 0.01, 0.1], [0.0, 1.0], [0.2, 0.5, 0.8])


@query()
def tuned_forest(t: Tables) -> DataFrame:
    """Trees, depth and bins of a forest, by AUROC; one fit a fold and number of bins."""
    train, test = _balanced(t)
    return forest_search(materialise(train, "folds"), test, "vec_id", [100, 150], [5, 10], [16, 32], metric="auroc", threads=4, seed=42)


def _documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text", "lang")


def _text_halves(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _halves(documents, "doc_id", "l9", 0.7)


def _text_model(t: Tables, fit=L.bag_of_words) -> tuple[DataFrame, DataFrame]:
    """Training and test texts as vectors fitted on the training texts, with the language as label; none without one."""
    labelled = L.index_label(_documents(t), "lang", "label").withColumn("label", F.col("label").cast("double"))
    train, test = _text_halves(labelled.where("label IS NOT NULL"))
    words = fit(train, "text")
    ready = [words.transform(df).select("doc_id", "lang", "label", "features") for df in (train, test)]
    return materialise(ready[0], "train"), materialise(ready[1], "test")


_STOP = ", ".join(f"'{w}'" for w in L.STOP_WORDS)


@query(
    f"""
SELECT word, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS n_texts
FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '\\W')) AS word FROM documents
      WHERE substring(md5('l9:' || doc_id), 1, 8) < '{hash_threshold(0.7)}') w
WHERE word <> '' AND word NOT IN ({_STOP}) GROUP BY word HAVING COUNT(DISTINCT doc_id) >= 5
ORDER BY n DESC, word LIMIT 10000"""
)
def bag_of_words(t: Tables) -> DataFrame:
    """Per vocabulary word what the vectors of the training texts add up to."""
    train, _ = _text_halves(_documents(t))
    model = L.bag_of_words(train, "text")
    words = t.spark.createDataFrame(list(enumerate(model.stages[-1].vocabulary)), "feature int, word string")
    totals = L.vector_totals(model.transform(train)).join(words, "feature")
    return totals.select("word", F.col("total").cast("bigint").alias("n"), F.col("n_rows").alias("n_texts"))


@query()
def tf_idf(t: Tables) -> DataFrame:
    """Per hashed word what the weighted vectors of the training texts add up to."""
    train, _ = _text_halves(_documents(t))
    model = L.tf_idf(train, "text")
    totals = L.vector_totals(model.transform(train))
    return totals.select("feature", F.col("n_rows").alias("n_texts"), F.col("total").alias("weight"))


@query()
def multiclass_models(t: Tables) -> DataFrame:
    train, test = _text_model(t)
    train = dealt(train, "doc_id")
    calls = [partial(L.train_eval_multiclass, name, m, train, test) for name, m in L.multiclass_classifiers().items()]
    return union_all(L.side_by_side(t.spark, calls))


@query()
def tf_idf_models(t: Tables) -> DataFrame:
    """The classifiers on hashed, weighted words instead of counts."""
    train, test = _text_model(t, L.tf_idf)
    train = dealt(train, "doc_id")
    calls = [partial(L.train_eval_multiclass, name, m, train, test) for name, m in L.multiclass_classifiers().items()]
    return union_all(L.side_by_side(t.spark, calls))


def _text_folds(t: Tables) -> tuple[DataFrame, DataFrame]:
    train, test = _text_model(t)
    return L.with_folds(train, "doc_id", 5), test


@query()
def tuned_text_model(t: Tables) -> DataFrame:
    """Penalties of a logistic regression on the words of the texts, all models of five folds side by side."""
    train, test = _text_folds(t)
    return softmax_search(materialise(train, "folds"), test, [0.1, 0.3, 0.5], [0.0, 0.1, 0.2], max_iter=20)


@query()
def tuned_text_forest(t: Tables) -> DataFrame:
    """Trees and depth of a forest on the words of the texts, the forests of all five folds side by side."""
    train, test = _text_folds(t)
    return word_forest_search(materialise(train, "folds"), test, "doc_id", [50, 100, 200], [3, 4, 5], seed=42)


@query()
def tuned_bayes(t: Tables) -> DataFrame:
    """Smoothing of a naive Bayes on the words of the texts, with the vocabulary of each training set."""
    labelled = L.index_label(_documents(t), "lang", "label").withColumn("label", F.col("label").cast("double"))
    train, test = _text_halves(labelled.where("label IS NOT NULL"))
    folds = materialise(L.with_folds(train, "doc_id", 5), "folds")
    return FS.bayes_search(folds, test, "text", "label", "doc_id", [0.1, 0.5, 1.0, 2.0], stop_words=L.STOP_WORDS)


@query()
def confident_texts(t: Tables) -> DataFrame:
    """The texts most surely taken for the commonest language."""
    train, test = _text_model(t)
    pred = L.multiclass_classifiers()["logistic_regression"].fit(train).transform(test)
    return R.top_confident(pred, 0, 10, "doc_id").select("doc_id", "lang", "confidence", "label", "prediction")


def _fitted(t: Tables):
    """A model of the training rows, and the test rows."""
    stored = materialise(plays(t), "plays")
    indexed = recommend.index_pairs(stored, "user_id", "item_id", "user", "item")
    # Hashed once; training rows are the most and go by their numbers alone.
    dealt_out = indexed.withColumn("in_train", hash_below(["user_id", "item_id"], "r2", 0.7))
    named = [F.when(~F.col("in_train"), F.col(c)).alias(c) for c in ("user_id", "item_id")]
    rows = materialise(dealt_out.select(*named, "plays", "user", "item", "in_train"), "indexed")
    train, test = rows.filter("in_train").select("user", "item", "plays"), rows.filter("NOT in_train").drop("in_train")
    return recommend.fit_als(train, "user", "item", "plays"), test


@query()
def als_fit(t: Tables) -> DataFrame:
    """The item factors."""
    model, _ = _fitted(t)
    return model.itemFactors.select("id", F.posexplode("features").alias("factor", "value"))


@query()
def als_user_factors(t: Tables) -> DataFrame:
    model, _ = _fitted(t)
    return model.userFactors.select("id", F.posexplode("features").alias("factor", "value"))


@query()
def als_score(t: Tables) -> DataFrame:
    model, test = _fitted(t)
    return recommend.score(model, test).select("user_id", "item_id", "plays", "prediction")


@query()
def als_recommend(t: Tables) -> DataFrame:
    model, _ = _fitted(t)
    return recommend.recommend(model, 10).select("user", F.posexplode("recommended").alias("position", "item"))


@query()
def als_search_work(t: Tables) -> DataFrame:
    """How many users met each block of items on the way to their best ten."""
    model, _ = _fitted(t)
    return recommend.search(model, 10)[1]
