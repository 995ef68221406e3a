"""Sorting, top-n, top-k per group, numbering."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import key_hash
from millrace.lineage import materialise
from millrace.operators.ordered import value_steps


def ordered(df: DataFrame, cols: list[str | Column], tie_break: list[str]) -> DataFrame:
    """Sorted, with the tie-break columns last so that the order is the same every time."""
    return df.orderBy(*cols, *tie_break)


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys with their counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), key).limit(n)


def keep_top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows of the ``n`` most frequent keys; those are written, so that the planner knows their size."""
    return df.join(materialise(top_groups(df, key, n).select(key), "top"), key, "left_semi")


def top_rows_per_group(df: DataFrame, groups: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group, numbered.

    The rank is compared with ``k`` directly on the window, so every map task cuts its
    part of a group down to ``k`` rows before the shuffle. Spark does so up to a
    threshold; beyond it the groups are cut within each input partition first.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        within = Window.partitionBy(*groups, "_part").orderBy(*order)
        parts = df.withColumn("_part", F.spark_partition_id()).withColumn(rank, F.row_number().over(within))
        df = parts.filter(F.col(rank) <= k).drop("_part", rank)
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def top_k_per_group(
    df: DataFrame, group: str, item: str, weight: str, k: int, name: str = "items"
) -> DataFrame:
    """Per group the array of its ``k`` items of greatest weight; ties go to the smaller item."""
    top = top_rows_per_group(
        df.select(group, item, weight), [group], [F.desc(weight), F.asc(item)], k, "_rank"
    )
    listed = F.array_sort(F.collect_list(F.struct("_rank", item)))
    return top.groupBy(group).agg(F.transform(listed, lambda x: x[item]).alias(name))


def top_confident(
    pred: DataFrame,
    cls: int,
    n: int,
    key: str,
    probability: str = "probability",
    prediction: str = "prediction",
) -> DataFrame:
    """Rows predicted as class ``cls``, surest first: by that class's own probability."""
    kind = dict(pred.dtypes)[probability]
    sure = F.col(probability) if kind == "double" else F.get(vector_to_array(probability), F.lit(cls))
    return (
        pred.filter(F.col(prediction) == cls)
        .withColumn("confidence", sure)
        .orderBy(F.desc("confidence"), key)
        .limit(n)
    )


def number_in_class(df: DataFrame, label: str, key: str, seed: int | str, name: str = "row") -> DataFrame:
    """Number the rows of each class in a random but repeatable order of the unique key.

    The order is that of the keys' hashes. Rows are numbered within each class and
    16-bit hash prefix, on top of the count of the prefixes before, so that a class of
    any size is spread over many tasks.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed)).withColumn("_prefix", F.substring("_hash", 1, 4))
    counts = hashed.groupBy(F.col(label).alias("_label"), F.col("_prefix").alias("_part")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy("_label").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(  # at most 65536 rows a class
        counts.select("_label", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "offsets"
    )
    row = F.row_number().over(Window.partitionBy(label, "_prefix").orderBy("_hash", key))
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_prefix") == F.col("_part"))
    return (
        hashed.withColumn("_row", row)
        .join(offsets, same)
        .select(*df.columns, (F.col("_row") + F.col("_before")).alias(name))
    )


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """Share of the rows at or below each distinct value."""
    steps = value_steps(df, col)
    total = steps.agg(F.sum("n")).scalar()
    return steps.select(col, "n", (F.col("upto") / total).alias("ecdf"))


def every_nth(df: DataFrame, order: list[Column], n: int, upto: int) -> DataFrame:
    """Every ``n``-th of the first ``upto`` rows in a total order, the first one included."""
    head = df.orderBy(*order).limit(upto)  # one task from here on, of ``upto`` rows
    ranked = head.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.filter((F.col("rank") - 1) % n == 0)
