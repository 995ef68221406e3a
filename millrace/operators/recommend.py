"""Recommendations from implicit feedback."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import shared_dir
from millrace.operators.inner_product import top_inner_products
from millrace.operators.joins import lookup
from millrace.operators.mljobs import label_index


def index_pairs(df: DataFrame, user: str, item: str, user_index: str, item_index: str) -> DataFrame:
    """Add contiguous integer ids for users and items, the busiest first.

    ``df`` is read three times, so it should come from storage.
    """
    indexed = df
    for col, name in ((user, user_index), (item, item_index)):
        index = label_index(df.select(col), col, name).withColumn(name, F.col(name).cast("int"))
        indexed = lookup(indexed, index, col, col, {name: name})
    return indexed


def fit_als(
    df: DataFrame,
    user: str,
    item: str,
    rating: str,
    rank: int = 10,
    max_iter: int = 5,
    reg: float = 0.01,
    seed: int = 42,
) -> ALSModel:
    """Factorise the user-item table, taking ``rating`` as the strength of a preference."""
    shared_dir(df.sparkSession)  # the solver cuts its lineage there
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        implicitPrefs=True,
        coldStartStrategy="drop",
        seed=seed,
    )
    return als.fit(df)


def score(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predicted preference of each pair both sides of which are known, in pair order."""
    user, item = model.getUserCol(), model.getItemCol()
    return model.transform(pairs).orderBy(user, item)


def recommend(model: ALSModel, k: int = 10, name: str = "recommended") -> DataFrame:
    """The ``k`` best items of every user, best first; ties go to the smaller item."""
    best, _ = search(model, k)
    listed = F.array_sort(F.collect_list(F.struct("position", "item")))
    items = F.transform(listed, lambda r: r["item"].cast("int"))
    return best.groupBy(F.col("user").cast("int").alias(model.getUserCol())).agg(items.alias(name))


def search(model: ALSModel, k: int = 10, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(user, position, item, score) of the ``k`` best items of every user, and the work that finding them took."""
    return top_inner_products(model.userFactors, model.itemFactors, k, **sizes)
