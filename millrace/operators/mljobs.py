"""Training, tuning and comparing classifiers; the solvers are Spark's own.

Every fitted step takes the training rows only: split first, then fit.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizerModel,
    HashingTF,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import hash_fraction
from millrace.functions.text import word_tokens
from millrace.lineage import materialise
from millrace.operators.joins import lookup, union_all
from millrace.operators.metrics import binary_metrics, multiclass_summary
from millrace.operators.ordered import number_rows

# Words a text model leaves out.
STOP_WORDS = ["http", "https", "amp", "rt", "t", "c", "the"]


def reduce_features(cols: list[str], k: int = 5, output: str = "features") -> Pipeline:
    """Numeric columns to ``k`` principal components of the scaled, not centred, values."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=cols, outputCol="_assembled"),
            StandardScaler(inputCol="_assembled", outputCol="_scaled"),
            PCA(k=k, inputCol="_scaled", outputCol=output),
        ]
    )


def label_index(df: DataFrame, col: str, name: str) -> DataFrame:
    """The labels of a column numbered from 0 by falling frequency, ties in alphabetical order."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    numbered = number_rows(counts, [F.desc("_n"), F.col(col).asc()], "_row")
    return materialise(numbered.select(col, (F.col("_row") - 1).cast("bigint").alias(name)), "index")


def index_label(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add the number of each row's label.

    The numbering is a table that is joined back, so there may be as many labels as
    there are users; null labels stay without a number.
    """
    return lookup(df, label_index(df, col, name), col, col, {name: name})


def _stop_list(extra: list[str], keep_default: bool) -> list[str]:
    return (StopWordsRemover.loadDefaultStopWords("english") if keep_default else []) + extra


def _words(text: str, stop_words: list[str]) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern="\\W"),
        StopWordsRemover(inputCol="_words", outputCol="_kept").setStopWords(stop_words),
    ]


def bag_of_words(
    train: DataFrame,
    text: str,
    vocab_size: int = 10000,
    min_df: int = 5,
    output: str = "features",
    stop_words: list[str] = STOP_WORDS,
    keep_default: bool = False,
) -> PipelineModel:
    """Word counts over the ``vocab_size`` most frequent words of the training texts.

    ``keep_default`` adds the stop words to the usual English list; otherwise they
    stand in for it. Words of equal frequency at the cut go in alphabetical order.
    """
    stops = _stop_list(stop_words, keep_default)
    words = [row["word"] for row in vocabulary(train, text, vocab_size, min_df, stops).collect()]
    counter = CountVectorizerModel.from_vocabulary(words, inputCol="_kept", outputCol=output)
    return PipelineModel(stages=[*_words(text, stops), counter])


def tf_idf(
    train: DataFrame,
    text: str,
    n_features: int = 10000,
    min_doc_freq: int = 5,
    output: str = "features",
    stop_words: list[str] = STOP_WORDS,
    keep_default: bool = False,
) -> PipelineModel:
    """Hashed word counts weighted by how few of the training texts hold the word."""
    stages = [
        *_words(text, _stop_list(stop_words, keep_default)),
        HashingTF(inputCol="_kept", outputCol="_raw", numFeatures=n_features),
        IDF(inputCol="_raw", outputCol=output, minDocFreq=min_doc_freq),
    ]
    return Pipeline(stages=stages).fit(train)


def vector_totals(df: DataFrame, features: str = "features") -> DataFrame:
    """Per vector element that is not 0 everywhere: feature, n_rows that have it, and their total."""
    elements = df.select(F.posexplode(vector_to_array(features)).alias("feature", "value")).where("value != 0")
    return elements.groupBy("feature").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))


def vocabulary(
    df: DataFrame,
    text: str,
    vocab_size: int = 10000,
    min_df: int = 5,
    stop_words: list[str] = STOP_WORDS,
) -> DataFrame:
    """The words ``bag_of_words`` counts, with their number of texts and of occurrences.

    Each text is exploded twice, with all its words and with the distinct ones, so
    that both numbers come from one shuffle of partial sums.
    """
    words = df.select(word_tokens(text).alias("_all")).select(
        F.posexplode(F.array("_all", F.array_distinct("_all"))).alias("_kind", "_words")
    )
    kept = words.select("_kind", F.explode("_words").alias("word")).filter(
        (F.col("word") != "") & ~F.col("word").isin(stop_words)
    )
    counts = kept.groupBy("word").agg(
        F.count_if(F.col("_kind") == 0).alias("n"), F.count_if(F.col("_kind") == 1).alias("n_texts")
    )
    return counts.filter(F.col("n_texts") >= min_df).orderBy(F.desc("n"), "word").limit(vocab_size)


def with_threshold(pred: DataFrame, threshold: float, probability: str = "probability", name: str = "custom_prediction") -> DataFrame:
    """Class 1 where its probability exceeds the threshold."""
    kind = dict(pred.dtypes)[probability]
    p = F.col(probability) if kind == "double" else F.get(vector_to_array(probability), F.lit(1))
    return pred.withColumn(name, (p > threshold).cast("int"))


def binary_classifiers(features: str = "features", label: str = "label") -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(featuresCol=features, labelCol=label),
        "linear_svc": LinearSVC(featuresCol=features, labelCol=label),
        "random_forest": RandomForestClassifier(featuresCol=features, labelCol=label, seed=42),
    }


def multiclass_classifiers(features: str = "features", label: str = "label") -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(
            featuresCol=features, labelCol=label, maxIter=20, regParam=0.3, elasticNetParam=0.0
        ),
        "naive_bayes": NaiveBayes(featuresCol=features, labelCol=label, smoothing=1.0),
        "random_forest": RandomForestClassifier(
            featuresCol=features, labelCol=label, numTrees=100, maxDepth=4, maxBins=32, seed=42
        ),
    }


def train_eval(
    name: str,
    estimator: Estimator,
    train: DataFrame,
    test: DataFrame,
    label: str = "label",
    weight_col: str | None = None,
    threshold: float | None = None,
) -> DataFrame:
    """Fit on ``train`` and return the binary metrics on ``test`` as one row."""
    if weight_col:
        estimator = estimator.copy({estimator.getParam("weightCol"): weight_col})
    pred = estimator.fit(train).transform(test)
    decided = "prediction"
    if threshold is not None:
        pred, decided = with_threshold(pred, threshold), "custom_prediction"
    scored = materialise(
        pred.select(label, decided, F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score")), "scored"
    )
    ranker = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol=label, numBins=0)
    return binary_metrics(scored, label, decided).select(
        F.lit(name).alias("model"), "*", F.lit(ranker.evaluate(scored)).alias("auroc")
    )


def train_eval_multiclass(
    name: str, estimator: Estimator, train: DataFrame, test: DataFrame, label: str = "label"
) -> DataFrame:
    """Fit on ``train`` and return the class-weighted metrics on ``test`` as one row."""
    pred = estimator.fit(train).transform(test)
    return multiclass_summary(pred, label).select(F.lit(name).alias("model"), "*")


def tune(
    estimator: Estimator,
    grid: dict[str, list],
    evaluator: Evaluator,
    folds: int = 5,
    parallelism: int = 4,
) -> CrossValidator:
    """A cross-validated grid search, to be fitted on a frame prepared by ``with_folds``.

    The grid names parameters of the estimator that is passed, so it always applies.
    """
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(estimator.getParam(param), values)
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )


def with_folds(df: DataFrame, key: str, folds: int = 5, seed: int | str = 42) -> DataFrame:
    """Add the fold of each row, by the hash of its key."""
    return df.withColumn("_fold", F.floor(hash_fraction(key, f"fold{seed}") * folds).cast("int"))


def side_by_side(spark: SparkSession, calls: list[Callable[[], DataFrame]], threads: int = 4) -> list[DataFrame]:
    """The results of calls that fit and evaluate, some at a time: small fits leave most of a cluster idle."""
    run = inheritable_thread_target(spark)(lambda call: call())
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(run, calls))


def compare(
    models: dict[str, Estimator], train_sets: dict[str, DataFrame], test: DataFrame, label: str = "label"
) -> DataFrame:
    """The binary metrics of every model trained on every variant of the training set."""

    def evaluated(variant: str, name: str) -> DataFrame:
        found = train_eval(name, models[name], train_sets[variant], test, label)
        return found.select(F.lit(variant).alias("train_set"), "*")

    return union_all(
        side_by_side(test.sparkSession, [partial(evaluated, variant, name) for variant in train_sets for name in models])
    )


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
