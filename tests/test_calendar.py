"""Filled calendars and splits per key against plain versions, with groups cut into slabs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sampling as X
from millrace.operators import series as S
from millrace.operators.ordered import following


@pytest.fixture
def slabs(spark):
    """Ranges stay apart, so that a hot key is in several."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.unset(setting)


def test_following_over_slabs(spark, slabs):
    r = random.Random(2)
    values = {"hot": sorted(r.sample(range(10_000), 900)), "one": [5], None: [1, 7], "two": [3, 4]}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    r.shuffle(rows)
    got = following(spark.createDataFrame(rows, "k string, v int"), "v", ["k"], "after").collect()
    want = {(k, v): after for k, vs in values.items() for v, after in zip(vs, [*vs[1:], None], strict=True)}
    assert {(g.k, g.v): g.after for g in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_filled_calendar(spark, slabs, unit):
    r = random.Random(unit)
    start = dt.datetime(2019, 11, 3, 13)
    rows = [("a", start + dt.timedelta(days=r.randrange(0, 900)), float(i)) for i in range(25)]
    rows += [("b", start, 1.0), ("b", start, None), ("b", None, 9.0), (None, start, 2.0), (None, start + dt.timedelta(days=800), 4.0)]

    def first(t):
        return dt.date(t.year, 1 if unit == "year" else t.month, t.day if unit == "day" else 1)

    def after(d):
        if unit == "day":
            return d + dt.timedelta(days=1)
        return dt.date(d.year + 1, 1, 1) if unit == "year" or d.month == 12 else dt.date(d.year, d.month + 1, 1)

    want = {}
    for key in ("a", "b", None):
        own = {}
        for k, t, v in rows:
            if k == key and t is not None:
                own.setdefault(first(t), []).extend([] if v is None else [v])
        at, mean = min(own), None
        while at <= max(own):
            if at in own:
                mean = sum(own[at]) / len(own[at])
            want[key, at] = (pytest.approx(mean), at in own)
            at = after(at)
    got = S.resample_calendar(spark.createDataFrame(rows, "k string, t timestamp, v double"), "t", "v", ["k"], unit).collect()
    assert {(g.k, g.period): (g["mean"], g.observed) for g in got} == want and len(got) == len(want)


def test_split_per_key(spark, slabs):
    sizes = {"hot": 700, "one": 1, "two": 2, "ten": 10, None: 3}
    keys = [k for k, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate(keys)], "k string, id int, split_ string")
    split = X.split_per_key(df, "k", 0.7, "id", 5).cache()
    assert split.columns == ["k", "id", "split_", "split"] and split.count() == len(keys)
    train = {r.k: r["count"] for r in split.where("split = 'train'").groupBy("k").count().collect()}
    assert train == {"hot": 490, "one": 1, "two": 1, "ten": 7, None: 2}
    again = X.split_per_key(df.orderBy(F.desc("id")), "k", 0.7, "id", 5)
    assert split.exceptAll(again).isEmpty()
    assert X.split_per_key(df.limit(0), "k", 0.7, "id", 5).count() == 0
