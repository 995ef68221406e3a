"""Observation series: pivots, yearly means, regional means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import mean_by
from millrace.operators.joins import join_dim
from millrace.operators.ordered import following, number_rows


def pivot_mean(df: DataFrame, index: list[str], column: str, value: str, values: list) -> DataFrame:
    """One row per index, one column per listed value, each the mean of the group."""
    return df.groupBy(*index).pivot(column, values).agg(F.avg(value))


def resample_year(df: DataFrame, date: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Mean per calendar year (and key); years without rows stay absent."""
    yearly = df.withColumn("year", F.year(date))
    return mean_by(yearly, [*(keys or []), "year"], value)


def resample_calendar(
    df: DataFrame, time: str, value: str, keys: list[str], unit: str = "month", name: str = "period"
) -> DataFrame:
    """Mean per key and period of the calendar (day, week, month, quarter or year), empty periods included.

    From a key's first to its last period there is a row for each; one without rows carries the
    last mean on, and isn't ``observed``. Only the periods with rows are ordered, and a row is
    repeated up to the next of them, so there is neither a calendar to join nor a window over all.
    """
    step = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}[unit]
    period = F.to_date(F.date_trunc(unit, time)).alias(name)
    means = df.where(F.col(time).isNotNull()).groupBy(*keys, period).agg(F.avg(value).alias("mean"))
    spaced = following(means, name, keys, "_next")
    upto = F.coalesce(F.expr(f"_next - interval {step}").cast("date"), F.col(name))
    each = F.explode(F.sequence(F.col(name), upto, F.expr(f"interval {step}")))
    return spaced.select(*keys, each.alias("_at"), "mean", F.col(name)).select(
        *keys, F.col("_at").alias(name), "mean", (F.col("_at") == F.col(name)).alias("observed")
    )


def only_unflagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose quality flag is not set."""
    return df.filter(F.col(flag).isNull() | (F.trim(flag) == ""))


def regional_daily(
    fact: DataFrame, dim: DataFrame, on: str, where_fact: Column, where_dim: Column, keys: list[str], value: str
) -> DataFrame:
    """Mean per day and region of the selected facts within the selected places.

    The dimension carries only its key and region columns into the join, and is
    broadcast if it is small.
    """
    places = dim.filter(where_dim)
    region_columns = [c for c in keys if c in dim.columns]
    joined = join_dim(fact.filter(where_fact), places.select(on, *region_columns), on, broadcast=True)
    return mean_by(joined, keys, value)


def ranked(df: DataFrame, col: str, tie_break: list[str], name: str = "rank") -> DataFrame:
    """Numbered from the greatest value down."""
    return number_rows(df, [F.desc(col), *[F.col(c) for c in tie_break]], name)
