"""Descriptive statistics, one row per column or bin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.gram import correlations, gram_blocks
from millrace.operators.ordered import value_steps


def _long(row: DataFrame, cols: list[str], measures: list[str], key: str = "column") -> DataFrame:
    """From one wide row with fields ``<measure>_<i>`` to one row per column."""
    entries = [
        F.struct(F.lit(c).alias(key), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*entries)))


def describe_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per numeric column, in one pass."""
    measures = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    row = doubles.agg(
        *[fn(c).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, fn in measures.items()]
    )
    return _long(row, cols, list(measures))


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null count and type of every column, in one pass."""
    row = df.agg(*[F.count(c).alias(f"n_nonnull_{i}") for i, c in enumerate(df.columns)])
    kinds = row.select("*", *[F.lit(kind).alias(f"type_{i}") for i, (_, kind) in enumerate(df.dtypes)])
    return _long(kinds, df.columns, ["type", "n_nonnull"])


def quantiles(df: DataFrame, col: str, probs: list[float], err: float = 0.05) -> DataFrame:
    """Approximate quantiles; the rank of each is off by at most ``err`` of the rows."""
    accuracy = max(1, round(1 / err)) if err > 0 else 2**31 - 1
    values = df.agg(F.percentile_approx(col, probs, accuracy).alias("values"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("values").alias("value"))
    return values.select(F.inline(pairs))


def quantiles_exact(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Exact quantiles, interpolated between neighbouring ranks.

    Reads them off the counts of the distinct values, so that no task holds the column.
    """
    steps = value_steps(df.select(F.col(col).cast("double").alias("value")), "value")
    total = steps.agg(F.sum("n")).scalar()
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    # a value is picked when one of the two ranks around a position falls among its copies
    at = F.explode(wanted).alias("prob")
    position = F.col("prob") * (F.col("total") - 1)
    lower, upper = F.floor(position), F.ceil(position)
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    picked = (
        steps.withColumn("total", total)
        .select("value", "n", "upto", "total", at)
        .filter(lower.between(first, last) | upper.between(first, last))
        .withColumn("at_lower", F.when(lower.between(first, last), F.col("value")))
        .withColumn("at_upper", F.when(upper.between(first, last), F.col("value")))
        .withColumn("weight", position - lower)
    )
    low, high = F.max("at_lower"), F.max("at_upper")
    return picked.groupBy("prob").agg((low + (high - low) * F.max("weight")).alias("value"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlations as (a, b, corr) rows, each over the rows that have both values.

    See ``operators.gram``. A correlation is null where a column doesn't vary over these rows, and NaN where
    they hold a value that isn't finite.
    """
    names = F.array(*[F.lit(c) for c in cols])
    corr = correlations(gram_blocks(df, cols))
    return corr.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "corr")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between the smallest and the greatest value; the last bin is closed."""
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        low = high = 0.0  # no values, no bins
    width = (high - low) / bins or 1.0
    bin_of = F.least(F.floor((F.col("v") - low) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        values.groupBy(bin_of.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("low"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
            "n",
        )
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of the total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # a row per class
