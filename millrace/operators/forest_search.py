"""Cross-validated searches over random forests, one fit for each training set and number of bins.

A forest of the greatest number of trees and depth holds those of the other points: its first
trees are a forest of fewer, and a tree cut at a level is one of that depth, since trees grow level
by level. As Spark's own forests do, cut trees join two leaves that predict the same. A row is
sent down each tree once; what each point says follows from its leaves.

The fits are Spark's. They hold each row as one number a feature, so wide rows are dealt to tasks
by ``dealt``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lineage import materialise, scratch_path
from millrace.operators.fold_search import ALL, grouped_auroc, grouped_f1
from millrace.operators.mljobs import side_by_side

TASK_BYTES = 1 << 28  # of the dense rows that a fit keeps in one task
_SAID = "label double, point int, prediction double, score double"
_ARROW = pa.schema([("label", pa.float64()), ("point", pa.int32()), ("prediction", pa.float64()), ("score", pa.float64())])


def dealt(df: DataFrame, key: str, features: str = "features", task_bytes: int = TASK_BYTES) -> DataFrame:
    """The rows of a written table dealt by key, so that 4 bytes a feature and row stay within ``task_bytes`` a task.

    A sixteenth of that is enough for a task as long as there are cores; more tasks send more histograms.
    """
    first = df.select(features).first()
    if first is None:
        return df
    held = df.count() * 4 * len(first[0])
    tasks = max(-(-held // task_bytes), min(-(-16 * held // task_bytes), df.sparkSession.sparkContext.defaultParallelism))
    return df.repartition(tasks, key) if tasks > 1 else df


def _votes(model: RandomForestClassificationModel, spark: SparkSession, depths: list[int]) -> list[list[np.ndarray]]:
    """For each depth and tree the class shares (leaves x classes) of the cut tree, by the leaves of the whole tree from the left."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", *[F.col(f"nodeData.{c}").alias(c) for c in ("id", "prediction", "impurityStats", "leftChild", "rightChild")]
    )
    trees: dict[int, dict[int, tuple]] = {}
    for tree, node, *rest in nodes.toLocalIterator():  # as many as the grid allows, whatever the rows
        trees.setdefault(tree, {})[node] = tuple(rest)

    def cut(tree: dict[int, tuple], node: int, level: int, depth: int) -> tuple[bool, float, list[np.ndarray]]:
        """Whether the subtree is one leaf, what the node predicts, and the shares below it."""
        prediction, stats, left, right = tree[node]
        if left < 0:
            return True, prediction, [np.array(stats) / max(sum(stats), 1e-300)]
        sides = [cut(tree, child, level + 1, depth) for child in (left, right)]
        shares = sides[0][2] + sides[1][2]
        if level == depth or (sides[0][0] and sides[1][0] and sides[0][1] == sides[1][1]):
            return True, prediction, [np.array(stats) / max(sum(stats), 1e-300)] * len(shares)
        return False, prediction, shares

    return [[np.stack(cut(trees[t], 0, 0, depth)[2]) for t in sorted(trees)] for depth in depths]


def _say(batches: Iterator[pa.RecordBatch], votes: list[list[np.ndarray]], points: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    """(label, leaves) -> what each of the points (number, trees, place of the depth) says of the row."""
    for batch in batches:
        leaves = np.array(batch.column(1).flatten(), float).reshape(batch.num_rows, -1).astype(np.int64)
        for place in {p[2] for p in points}:
            total, done = 0.0, 0
            for point, trees, _ in sorted((p for p in points if p[2] == place), key=lambda p: p[1]):
                for t in range(done, trees):
                    total = total + votes[place][t][leaves[:, t]]
                done = trees
                score = total[:, 1] if total.shape[1] > 1 else np.zeros(len(total))
                said = [batch.column(0), pa.array(np.full(len(total), point, np.int32)), pa.array(total.argmax(1).astype(float)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(said, schema=_ARROW)


def forest_search(
    folds: DataFrame,
    test: DataFrame,
    key: str,
    trees: list[int],
    depths: list[int],
    bins: list[int] = (32,),
    metric: str = "f1",
    n_folds: int = 5,
    threads: int = 2,
    **params,
) -> DataFrame:
    """(point, mean_score, best_test_f1): each point's mean F1 or AUROC over the folds, and on ``test`` the F1 of the best.

    ``folds`` is a written table of (key, label, features, ``_fold``); ``params`` go to the forests.
    """
    spark = folds.sparkSession
    if folds.isEmpty():
        return spark.createDataFrame([], "point string, mean_score double, best_test_f1 double")
    grid = list(product(trees, depths, bins))
    names = [f"numTrees={t}, maxDepth={d}" + f", maxBins={b}" * (len(bins) > 1) for t, d, b in grid]

    def said(train: DataFrame, rows: DataFrame, own: list[int], fold: int) -> DataFrame:
        """What points of equal bins say of ``rows`` after one fit."""
        held = [depths.index(grid[i][1]) for i in own]
        most = {"numTrees": max(grid[i][0] for i in own), "maxDepth": max(grid[i][1] for i in own), "maxBins": grid[own[0]][2]}
        model = RandomForestClassifier(leafCol="leaf", **most, **params).fit(dealt(train, key))
        points = [(i, grid[i][0], place) for i, place in zip(own, held, strict=True)]
        leaves = model.transform(rows).select(F.col("label").cast("double").alias("label"), vector_to_array("leaf").alias("leaves"))
        table = leaves.mapInArrow(partial(_say, votes=_votes(model, spark, depths), points=points), _SAID)
        if metric == "f1" or fold == ALL:
            table = table.groupBy("point", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        else:
            table = table.groupBy("point", "label", "score").agg(F.count(F.lit(1)).alias("n"))
        return materialise(table.withColumn("fold", F.lit(fold)), "said")

    of_bins = [[i for i, p in enumerate(grid) if p[2] == b] for b in bins]
    calls = [
        partial(said, folds.where(F.col("_fold") != f), folds.where(F.col("_fold") == f), own, f)
        for f in range(n_folds)
        for own in of_bins
    ]
    tables = reduce(DataFrame.unionByName, side_by_side(spark, calls, threads))
    if metric == "f1":
        scores = grouped_f1(tables, ["fold", "point"]).withColumnRenamed("f1", "score")
    else:
        scores = grouped_auroc(tables, ["fold", "point"], "score", "label", "n").withColumnRenamed("auroc", "score")
    means = dict(scores.groupBy("point").agg(F.avg("score")).collect())  # one number a point
    means = [means.get(i) for i in range(len(grid))]
    best = max(range(len(grid)), key=lambda i: -1.0 if means[i] is None else means[i])
    tested = grouped_f1(said(folds, test, [best], ALL), ["fold", "point"]).first()
    rows = [(name, mean, tested.f1 if tested else None) for name, mean in zip(names, means, strict=True)]
    return spark.createDataFrame(rows, "point string, mean_score double, best_test_f1 double")
