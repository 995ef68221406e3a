"""Merged sketches against exact ranks and sets; frequent keys against full counts."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators import heavy as H
from millrace.operators import sketches as K
from millrace.operators.ranking import top_groups


def test_quantiles_merge_in_any_order(spark):
    r = random.Random(1)
    rows = [(day, r.lognormvariate(0, 2)) for day in range(12) for _ in range(400 * (day + 1))] + [(0, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "day int, v double").repartition(6)
    stored = materialise(K.quantile_sketches(df, ["day"], "v"), "sketches")
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    for days in (range(12), (3,), (11, 2, 7)):
        values = sorted(v for day, v in rows if day in days and v is not None and v == v)
        for order in (F.asc("day"), F.desc("day")):
            some = stored.where(F.col("day").isin(*days)).orderBy(order).withColumn("all", F.lit(1))
            for got in K.merged_quantiles(some, ["all"], probs).collect():
                below = sum(v < got.value for v in values) / len(values)
                upto = sum(v <= got.value for v in values) / len(values)
                slack = K.quantile_error()
                assert got.n == len(values) and below - slack <= got.prob <= upto + slack


def test_sets_merge_exactly_up_to_their_size(spark):
    rows = [(day, (day * 37 + i * 7) % 500, f"x{i % 11}") for day in range(6) for i in range(200)] + [(0, None, None)]
    df = spark.createDataFrame(rows, "day int, u int, x string").repartition(4)
    stored = materialise(K.set_sketches(df, ["day"], ["u", "x"]), "sets")
    early, late = ({u for day, u, _ in rows if (day < 3) == first and u is not None} for first in (True, False))
    sides = stored.agg(
        K.union_of("u").alias("all"), K.union_of("x").alias("x"),
        F.theta_union_agg(F.when(F.col("day") < 3, F.col("u")), 12).alias("early"), F.theta_union_agg(F.when(F.col("day") >= 3, F.col("u")), 12).alias("late"),
    )
    got = sides.select(K.distinct("all"), K.distinct("x"), K.distinct(K.without("early", "late"))).first()
    assert tuple(got) == (len(early | late), 11, len(early - late))


def test_large_sets_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("u"))
    stored = K.set_sketches(df, ["k"], ["u"], 10)
    got = stored.agg(K.distinct(K.union_of("u", 10))).first()[0]
    assert abs(got - 60_000) < 4 * 60_000 / 2**5


@pytest.mark.parametrize("n", [1, 10, 1000])
def test_heavy_hitters_equal_full_counts(spark, n):
    r = random.Random(n)
    keys = [None if r.random() < 0.05 else f"k{int(r.paretovariate(0.7)) % 5000}" for _ in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    for counters in (4, 64, 100_000):
        assert H.heavy_hitters(df, "k", n, counters).collect() == top_groups(df, "k", n).collect()
    assert H.heavy_hitters(df.limit(0), "k", n).count() == 0


def test_heavy_hitters_shuffle_few_keys_and_know_when_they_prove_nothing(spark):
    skewed = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5).otherwise(F.col("id")).alias("k")).repartition(4)
    found = H.summary(skewed, "k", 100)
    assert found.where("_is_key").count() <= 400
    assert 5 <= H._candidates(found, 5, 1000).count() < 500
    flat = spark.range(40_000).select(F.col("id").alias("k"))
    assert H._candidates(H.summary(flat, "k", 100), 5, 1000) is None
    assert [tuple(r) for r in H.heavy_hitters(flat, "k", 3, 100).collect()] == [(0, 1), (1, 1), (2, 1)]
