"""Pivots, yearly means, regional series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import series as S
from millrace.operators.filters import where_year
from millrace.plans.registry import Tables, query
from millrace.plans.views import edges, obs


@query(
    """
SELECT l_linestatus, CAST(YEAR(l_shipdate) AS INT) AS year,
       ROUND(AVG(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 5) AS a,
       ROUND(AVG(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END), 5) AS n,
       ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 5) AS r
FROM lineitem GROUP BY 1, 2"""
)
def pivot_mean(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_linestatus", F.year("l_shipdate").alias("year"), "l_returnflag", "l_extendedprice")
    wide = S.pivot_mean(rows, ["l_linestatus", "year"], "l_returnflag", "l_extendedprice", ["A", "N", "R"])
    return wide.select("l_linestatus", "year", *[F.round(c, 5).alias(c.lower()) for c in ("A", "N", "R")])


@query(
    """
SELECT l_returnflag, CAST(YEAR(day) AS INT) AS year, ROUND(AVG(mean), 6) AS mean
FROM (SELECT l_returnflag, l_shipdate AS day, AVG(l_quantity) AS mean FROM lineitem GROUP BY 1, 2) daily
GROUP BY 1, 2"""
)
def resample_year(t: Tables) -> DataFrame:
    """Yearly means of the daily means."""
    daily = A.mean_by(t.lineitem, ["l_returnflag", "l_shipdate"], "l_quantity", "daily_mean")
    return S.resample_year(daily, "l_shipdate", "daily_mean", ["l_returnflag"]).withColumn("mean", F.round("mean", 6))


_CALENDAR_SQL = """
WITH m AS (
  SELECT {key}, CAST(date_trunc('{unit}', {time}) AS DATE) AS period, ROUND(AVG({value}), 6) AS mean FROM {table} GROUP BY 1, 2),
s AS (
  SELECT {key}, CAST(unnest(generate_series(MIN(period), MAX(period), INTERVAL 1 {unit})) AS DATE) AS period FROM m GROUP BY 1)
SELECT {key}, strftime(period, '%Y-%m-%d') AS period,
       last_value(mean IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY period) AS mean, mean IS NOT NULL AS observed
FROM s LEFT JOIN m USING ({key}, period)"""


@query(_CALENDAR_SQL.format(key="user_id", unit="day", time="ts", value="value", table="events"))
def resample_days(t: Tables) -> DataFrame:
    """Each user's daily means, days without events filled from the last one with any."""
    days = S.resample_calendar(t.events, "ts", "value", ["user_id"], "day")
    return days.select("user_id", F.date_format("period", "yyyy-MM-dd").alias("period"), F.round("mean", 6).alias("mean"), "observed")


@query(_CALENDAR_SQL.format(key="o_custkey", unit="month", time="o_orderdate", value="o_totalprice", table="orders"))
def resample_months(t: Tables) -> DataFrame:
    """Each customer's monthly means, months without orders filled from the last one with any."""
    months = S.resample_calendar(t.orders, "o_orderdate", "o_totalprice", ["o_custkey"], "month")
    return months.select("o_custkey", F.date_format("period", "yyyy-MM-dd").alias("period"), F.round("mean", 6).alias("mean"), "observed")


@query("SELECT element, day, ROUND(AVG(value), 6) AS mean FROM obs GROUP BY element, day")
def daily_average(t: Tables) -> DataFrame:
    return A.mean_by(obs(t), ["element", "day"], "value").withColumn("mean", F.round("mean", 6))


@query("SELECT element, day, COUNT(id) AS n FROM obs GROUP BY element, day")
def daily_count(t: Tables) -> DataFrame:
    return A.count_nonnull(obs(t), ["element", "day"], "id")


_REGION_SQL = """
SELECT {names}, ROUND(AVG(l_quantity), 6) AS mean
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
WHERE l_returnflag = 'A' AND YEAR(l_shipdate) = 1998 AND s_nationkey < 12 GROUP BY {keys}"""


def _regional(t: Tables, keys: list[str]) -> DataFrame:
    suppliers = t.supplier.withColumnRenamed("s_suppkey", "l_suppkey")
    facts = where_year(t.lineitem, "l_shipdate", 1998)
    element, region = F.col("l_returnflag") == "A", F.col("s_nationkey") < 12
    means = S.regional_daily(facts, suppliers, "l_suppkey", element, region, keys, "l_quantity")
    return means.withColumn("mean", F.round("mean", 6))


@query(
    _REGION_SQL.format(
        names="strftime(l_shipdate, '%Y-%m-%d') AS day, s_nationkey", keys="l_shipdate, s_nationkey"
    )
)
def regional_series(t: Tables) -> DataFrame:
    means = _regional(t, ["l_shipdate", "s_nationkey"])
    return means.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "s_nationkey", "mean")


@query(_REGION_SQL.format(names="s_nationkey", keys="s_nationkey"))
def regional_annual(t: Tables) -> DataFrame:
    return _regional(t, ["s_nationkey"])


@query(
    """
WITH means AS (
  SELECT CAST(YEAR(shipdate) AS INT) AS year, dst_id, ROUND(AVG(quantity), 6) AS mean FROM edges GROUP BY 1, 2)
SELECT year, dst_id, mean, row_number() OVER (ORDER BY mean DESC, year, dst_id) AS rank FROM means"""
)
def ranked_yearly(t: Tables) -> DataFrame:
    yearly = edges(t).select(F.year("shipdate").alias("year"), "dst_id", "quantity")
    means = A.mean_by(yearly, ["year", "dst_id"], "quantity").withColumn("mean", F.round("mean", 6))
    return S.ranked(means, "mean", ["year", "dst_id"])


@query(
    """
SELECT o_orderstatus, COUNT(*) AS n FROM orders
WHERE o_orderpriority <> '4-NOT SPECIFIED' OR o_totalprice < 250000 GROUP BY o_orderstatus"""
)
def unflagged_count(t: Tables) -> DataFrame:
    """Rows without a quality flag: of one priority, the cheaper carry a blank one and the others a real one."""
    unclear = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    flag = F.when(unclear, F.when(F.col("o_totalprice") < 250000, " ").otherwise("Q"))
    return S.only_unflagged(t.orders.withColumn("flag", flag), "flag").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")
    )
