"""Evaluation of classifiers, scores and recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import value_steps


def _ratio(a: Column, b: Column) -> Column:
    """a / b, zero where there is nothing to divide by."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts, precision, recall, F1 and accuracy in one pass; ratios of nothing are zero."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    not_y, not_p = F.col(label) == 0, F.col(prediction) == 0
    counts = pred.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(y).alias("positive"),
        F.count_if(not_y).alias("negative"),
        F.count_if(p).alias("predicted_positive"),
        F.count_if(not_p).alias("predicted_negative"),
        F.count_if(y & p).alias("tp"),
        F.count_if(not_y & p).alias("fp"),
        F.count_if(not_y & not_p).alias("tn"),
        F.count_if(y & not_p).alias("fn"),
    )
    tp = F.col("tp")
    rated = counts.withColumns(
        {
            "precision": _ratio(tp, tp + F.col("fp")),
            "recall": _ratio(tp, tp + F.col("fn")),
            "accuracy": _ratio(tp + F.col("tn"), F.col("total")),
        }
    )
    return rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def auroc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve, exact: the chance that a positive outscores a negative, ties half.

    Rows without a label don't count.
    """
    steps = value_steps(df.filter(F.col(label).isNotNull()), score, {"positives": F.when(F.col(label) == 1, 1).otherwise(0)})
    negatives = F.col("n") - F.col("positives")
    below = F.col("upto") - F.col("positives_upto") - negatives
    won = F.sum(F.col("positives") * (below + negatives / F.lit(2.0)))
    return steps.agg(
        (won / (F.sum("positives").cast("double") * F.sum(negatives).cast("double"))).alias("auroc")
    )


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of every true class.

    Each cell of the confusion table counts once for its true and once for its
    predicted class, so one pass over the predictions and no join will do.
    """
    none, n = F.lit(0).cast("bigint"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    entries = F.array(
        F.struct(F.col("label"), n.alias("n"), hit.alias("n_hit"), none.alias("n_predicted")),
        F.struct(F.col("prediction").alias("label"), none.alias("n"), none.alias("n_hit"), n.alias("n_predicted")),
    )
    counts = (
        confusion(pred, label, prediction)
        .select(F.inline(entries))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_hit", "n_predicted")])
        .filter(F.col("n") > 0)
    )
    rated = counts.withColumns(
        {
            "precision": _ratio(F.col("n_hit"), F.col("n_predicted")),
            "recall": _ratio(F.col("n_hit"), F.col("n")),
        }
    )
    return rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def multiclass_summary(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over the classes by their size."""
    classes = per_class_metrics(pred, label, prediction)
    by_size = {
        f"weighted_{m}": F.sum(F.col(m) * F.col("n")) / F.sum("n") for m in ("precision", "recall", "f1")
    }
    return classes.agg(
        *[column.alias(name) for name, column in by_size.items()],
        (F.sum("n_hit") / F.sum("n")).alias("accuracy"),
    )


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root of the mean squared error over the rows with a prediction.

    Scores of an implicit-feedback model are preferences, not counts; compared with
    counts the figure says little, and the ranking metrics are the measure.
    """
    error = F.col(label) - F.col(prediction)
    return df.filter(~F.isnan(F.col(prediction).cast("double"))).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


# Ranking metrics: one row a user, with the array of recommended items, best first,
# and the array of relevant items. A user without relevant items scores zero.


def precision_at(df: DataFrame, k: int, recommended: str = "recommended", relevant: str = "relevant") -> DataFrame:
    """Hits among the first ``k`` recommendations, out of ``k``, averaged over the users."""
    hits = F.filter(F.slice(recommended, 1, k), lambda x: F.array_contains(F.col(relevant), x))
    return df.agg(F.avg(F.size(hits) / F.lit(float(k))).alias(f"precision_at_{k}"))


def _discount(rank: Column) -> Column:
    return F.lit(1.0) / F.log(rank + F.lit(1.0))


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def ndcg_at(df: DataFrame, k: int, recommended: str = "recommended", relevant: str = "relevant") -> DataFrame:
    """Discounted gain of the first ``k`` recommendations over that of a perfect list."""
    gains = F.transform(
        F.slice(recommended, 1, k),
        lambda x, i: F.when(F.array_contains(F.col(relevant), x), _discount(i + 1)).otherwise(F.lit(0.0)),
    )
    attainable = F.least(F.size(F.array_distinct(relevant)), F.lit(k))
    ideal = F.transform(F.sequence(F.lit(1), F.greatest(attainable, F.lit(1))), _discount)
    gain = F.when(attainable > 0, _total(gains) / _total(ideal)).otherwise(F.lit(0.0))
    return df.agg(F.avg(gain).alias(f"ndcg_at_{k}"))


def mean_average_precision(df: DataFrame, recommended: str = "recommended", relevant: str = "relevant") -> DataFrame:
    """Precision at each hit, summed over the list, out of the number of relevant items."""
    hit = F.transform(F.col(recommended), lambda x: F.array_contains(F.col(relevant), x).cast("int"))
    start = F.struct(F.lit(0).alias("rank"), F.lit(0).alias("hits"), F.lit(0.0).alias("total"))
    summed = F.aggregate(
        hit,
        start,
        lambda seen, h: F.struct(
            (seen["rank"] + 1).alias("rank"),
            (seen["hits"] + h).alias("hits"),
            (seen["total"] + h * (seen["hits"] + h) / (seen["rank"] + F.lit(1.0))).alias("total"),
        ),
        lambda seen: seen["total"],
    )
    n_relevant = F.size(F.array_distinct(relevant))
    score = F.when(n_relevant > 0, summed / n_relevant).otherwise(F.lit(0.0))
    return df.agg(F.avg(score).alias("map"))
