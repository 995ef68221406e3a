"""Stored sketches that merge: quantiles and sets of any period without its rows.

A table has one sketch per key and, say, day. Sketches of any of its rows merge into that of
their union, in any order, so a month's quantiles or a year's distinct users are read off a few
kilobytes a day. ``error`` bounds the rank of a quantile, as a share of the rows, with 99 %
confidence; sets are exact up to ``2 ** size`` values, and beyond that known to about
``2 ** (-size / 2)`` of the larger set, one standard deviation.

Nulls are in no sketch; NaN isn't either. All values are summed up within the tasks first, so a
hot key is one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_SIZE = 400
SET_SIZE = 12


def quantile_error(size: int = QUANTILE_SIZE) -> float:
    """How far a rank may be off, as a share of the rows; for a pair of ranks, as both ends of a span."""
    return 2.446 / size**0.9433


def quantile_sketches(df: DataFrame, keys: list[str], value: str, size: int = QUANTILE_SIZE) -> DataFrame:
    """(keys, sketch): the values of each key."""
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).withColumn("_value", number)
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double("_value", size).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys, n, prob, value): of all sketches of a key together."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = [
        F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probs
    ]
    each = merged.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(F.array(*found)).alias("at"))
    return each.select(*keys, "n", "at.prob", "at.value")


def set_sketches(df: DataFrame, keys: list[str], members: list[str], size: int = SET_SIZE) -> DataFrame:
    """(keys, one sketch for each column of ``members``): the distinct values, all columns in one pass."""
    return df.groupBy(*keys).agg(*[F.theta_sketch_agg(c, size).alias(c) for c in members])


def union_of(sketch: str, size: int = SET_SIZE) -> Column:
    """An aggregate: the union of sets."""
    return F.theta_union_agg(sketch, size)


def distinct(sketch: str | Column) -> Column:
    """How many values a set has."""
    return F.theta_sketch_estimate(sketch)


def without(a: str | Column, b: str | Column) -> Column:
    """The values of one set that another lacks."""
    return F.theta_difference(a, b)
