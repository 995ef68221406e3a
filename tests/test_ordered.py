import random

import pytest
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators import ordered as O
from millrace.operators import ranking as R
from millrace.operators import stats as Q


@pytest.fixture(scope="module", autouse=True)
def many_slabs(spark):
    """Small tables would be merged into one slab."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, and many equal values."""
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else f"g{i % 11}", rng.choice([1, 1, 1, 2, 5, 8, rng.randrange(1000)])) for i in range(3000)]
    return spark.createDataFrame(data, "id int, g string, v int").repartition(5).cache()


def test_numbers_over_the_table(skewed):
    got = O.number_rows(skewed, [F.desc("v"), F.asc("id")]).collect()
    want = sorted(skewed.collect(), key=lambda r: (-r["v"], r["id"]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["row"])] == [r["id"] for r in want]
    assert sorted(r["row"] for r in got) == list(range(1, 3001))


def test_running_sums_within_groups(skewed):
    got = O.running_sums(skewed, [F.col("id").asc()], {"total": F.col("v"), "row": F.lit(1)}, ["g"]).collect()
    sums, counts, want = {}, {}, {}
    for r in sorted(skewed.collect(), key=lambda r: r["id"]):
        sums[r["g"]] = sums.get(r["g"], 0) + r["v"]
        counts[r["g"]] = counts.get(r["g"], 0) + 1
        want[r["id"]] = (sums[r["g"]], counts[r["g"]])
    assert {r["id"]: (r["total"], r["row"]) for r in got} == want


def test_a_hot_group_is_cut_into_slabs(skewed, monkeypatch):
    written = []

    def keep(df, name="table"):
        written.append(materialise(df, name))
        return written[-1]

    monkeypatch.setattr(O, "materialise", keep)
    O.number_rows(skewed.filter("g = 'hot'"), [F.col("id").asc()], "n", ["g"])
    assert written[0].select("_slab").distinct().count() == 4


def test_null_groups_and_nothing(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    assert rows(O.number_rows(df, [F.col("id").asc()], "n", ["g"])) == [(1, None, 1), (2, None, 2), (3, "a", 1)]
    assert O.number_rows(df.limit(0), [F.col("id").asc()]).count() == 0


def test_value_steps(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (3,), (None,), (2,)], "v int")
    assert rows(O.value_steps(df, "v")) == [(1, 2, 2), (2, 1, 3), (3, 1, 4)]


def test_ecdf_and_exact_quantiles(skewed, spark):
    values = sorted(r["v"] for r in skewed.collect())
    for r in R.ecdf(skewed, "v").collect():
        assert r["ecdf"] == pytest.approx(sum(x <= r["v"] for x in values) / len(values))
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 0.999, 1.0]
    got = {r["prob"]: r["value"] for r in Q.quantiles_exact(skewed, "v", probs).collect()}
    want = skewed.select(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert [got[p] for p in probs] == pytest.approx(want)


def test_approximate_quantiles_stay_within_the_error(skewed):
    values = sorted(r["v"] for r in skewed.collect())
    for r in Q.quantiles(skewed, "v", [0.25, 0.5, 0.75], 0.01).collect():
        low = sum(x < r["value"] for x in values) / len(values)
        high = sum(x <= r["value"] for x in values) / len(values)
        assert low - 0.01 <= r["prob"] <= high + 0.01


def test_number_in_class(skewed):
    got = R.number_in_class(skewed, "g", "id", "s").collect()
    by_class = {}
    for r in got:
        by_class.setdefault(r["g"], []).append(r["row"])
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in by_class.values())
    again = R.number_in_class(skewed.repartition(3), "g", "id", "s").collect()
    assert {(r["id"], r["row"]) for r in got} == {(r["id"], r["row"]) for r in again}
    in_order = [r["id"] for r in sorted(got, key=lambda r: r["row"]) if r["g"] == "hot"]
    assert in_order != sorted(in_order)
