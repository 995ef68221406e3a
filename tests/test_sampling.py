import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import kcore as K
from millrace.operators import sampling as X


@pytest.fixture(scope="module")
def classes(spark):
    """Classes of 900, 10, 7 and 1 rows, and one without a label."""
    sizes = {"big": 900, "ten": 10, "seven": 7, "one": 1, None: 5}
    data = [(c, i) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(c, k) for k, (c, _) in enumerate(data)], "c string, id int").cache()


def test_split_is_complete_and_disjoint(classes):
    parts = X.split(classes, "id", [0.7, 0.2, 0.1], 1)
    assert parts.count() == classes.count()
    sizes = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert set(sizes) == {0, 1, 2}
    assert abs(sizes[0] / 923 - 0.7) < 0.06


def test_exact_split(classes):
    split = X.stratified_split_exact(classes, "c", 0.8, "id", 5)
    assert split.count() == classes.count()
    train = {r["c"]: r["count"] for r in split.filter("split = 'train'").groupBy("c").count().collect()}
    assert train == {"big": 720, "ten": 8, "seven": 5, None: 4}
    again = X.stratified_split_exact(classes.repartition(7), "c", 0.8, "id", 5)
    assert split.exceptAll(again).isEmpty()


@pytest.mark.parametrize("frac, want", [(0.29, 290), (0.7, 700), (0.0, 0), (1.0, 1000)])
def test_exact_split_at_whole_numbers(spark, frac, want):
    df = spark.range(1000).withColumn("c", F.lit(1))
    assert X.stratified_split_exact(df, "c", frac, "id", 5).filter("split = 'train'").count() == want


def test_exact_split_does_not_shuffle_the_table(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("c", F.col("id") % 2).write.parquet(path)
    text = plan(X.stratified_split_exact(spark.read.parquet(path), "c", 0.8, "id", 5))
    assert text.count("Exchange hashpartitioning") == 1  # that of the rows at the cut
    assert text.count("BroadcastHashJoin") == 2


def test_stratified_sample(classes):
    got = X.stratified_sample(classes, "c", {"big": 0.5, "ten": 1.0}, "id", 3)
    drawn = {r["c"]: r["count"] for r in got.filter("sampled").groupBy("c").count().collect()}
    assert 380 < drawn.pop("big") < 520
    assert drawn == {"ten": 10}
    assert got.count() == classes.count()


def test_class_balancing(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 50 == 0).cast("int"))
    thinned = X.downsample(df, "y", 0, 6.0, "id", 1)
    n = {r["y"]: r["count"] for r in thinned.groupBy("y").count().collect()}
    assert n[1] == 100 and 480 < n[0] < 720
    grown = X.oversample(thinned, "y", 1, 10, 0.6, "id", 2)
    m = {r["y"]: r["count"] for r in grown.groupBy("y").count().collect()}
    assert m[0] == n[0] and 320 < m[1] < 480  # 100 rows, 10 draws, 4 copies on average
    weighted = X.class_weights(df, "y", {0: 1.0, 1: 10.0})
    assert {tuple(r) for r in weighted.select("y", "weight").distinct().collect()} == {(0, 1.0), (1, 10.0)}


def test_downsample_without_a_majority(spark):
    df = spark.range(5).withColumn("y", F.lit(1))
    assert X.downsample(df, "y", 0, 2.0, "id", 1).count() == 5


def test_uncovered(spark, rows):
    test = spark.createDataFrame([(1,), (2,), (2,), (3,)], "u int")
    train = spark.createDataFrame([(1,), (3,), (3,)], "u int")
    assert rows(X.uncovered(test, train, "u")) == [(2, 1)]


def brute_core(pairs, a, b, rounds):
    while rounds:
        users, items = {}, {}
        for u, i in pairs:
            users[u] = users.get(u, 0) + 1
            items[i] = items.get(i, 0) + 1
        kept = [(u, i) for u, i in pairs if users[u] > a and items[i] > b]
        if kept == pairs:
            break
        pairs, rounds = kept, rounds - 1
    return pairs


@pytest.mark.parametrize("rounds", [1, 2, None])
def test_core_equals_brute_force(spark, rows, rounds):
    pairs = sorted({(u, (u * 7 + k * k) % 40) for u in range(60) for k in range(u % 9)} | {(u, 0) for u in range(60)})
    df = spark.createDataFrame(pairs, "u int, i int")
    got = K.kcore(df, "u", "i", 3, 4, rounds)
    assert rows(got) == sorted(brute_core(pairs, 3, 4, -1 if rounds is None else rounds), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_core_of_repeated_rows_and_nulls(spark, rows, seed, monkeypatch):
    """Many rounds, several buckets and parts; rows without a key count once and go at once."""
    monkeypatch.setattr(K, "BUCKET_ROWS", 8)
    monkeypatch.setattr(K, "PART_ROWS", 2)
    r = random.Random(seed)
    pairs = [(u, f"i{u + d}") for u in range(14) for d in (0, 1) if r.random() < 0.97]  # a chain that unravels slowly
    pairs += [(r.randrange(8), f"i{r.randrange(8)}") for _ in range(60)]
    pairs += [(None, "i1"), (3, None), (None, None), (None, "i13")]

    def plain(table, rounds):
        while rounds:
            users, items = Counter(u for u, _ in table), Counter(i for _, i in table)
            kept = [(u, i) for u, i in table if u is not None and i is not None and users[u] > 1 and items[i] > 1]
            if kept == table:
                break
            table, rounds = kept, rounds - 1
        return sorted(table, key=str)

    df = spark.createDataFrame(pairs, "u int, i string")
    for rounds in (0, 1, 3, None):
        assert rows(K.kcore(df, "u", "i", 1, 1, rounds)) == plain(pairs, -1 if rounds is None else rounds)
    assert rows(K.kcore(df.limit(0), "u", "i", 1, 1)) == []


def test_a_round_opens_the_buckets_of_what_it_removes(spark, plan, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_ROWS", 8)
    df = spark.createDataFrame([(u, (u + d) % 50) for u in range(50) for d in range(4)] + [(99, 0)], "u int, i int")
    peeled = K._Peeling(df, "u", "i", 1, 1, None)
    pairs = peeled.pairs[True]
    assert peeled.buckets == 25 and pairs.count() == 200  # the first round took the pair of 99
    assert {r._bucket for r in pairs.select("_bucket").distinct().collect()} <= set(range(25))
    assert "PartitionFilters: [isnotnull(_bucket" in plan(pairs.where(F.col("_bucket").isin([3])))


def test_core_is_closed_and_keeps_its_columns(spark):
    df = spark.range(4000).select(
        (F.col("id") % 97).cast("string").alias("u"), (F.col("id") * F.col("id") % 61).alias("i"), F.lit(2).alias("w")
    ).distinct()
    core = K.kcore(df, "u", "i", 20, 30)
    assert core.columns == ["u", "i", "w"]
    assert core.groupBy("u").count().filter("count <= 20").isEmpty()
    assert core.groupBy("i").count().filter("count <= 30").isEmpty()
    assert K.kcore(df, "u", "i", 20, 10**6).isEmpty()


def test_retention(spark, rows):
    before = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2)], "u int, i int")
    got = rows(K.retention(before, before.filter("u = 1"), "u", "i"))
    assert got == [("items", 2, 2, 1.0), ("rows", 4, 2, 0.5), ("users", 2, 1, 0.5)]


def test_retention_of_the_core_from_counts(spark, rows):
    """The same as from its rows, with repeated rows and nulls; an empty table keeps no share."""
    r = random.Random(1)
    pairs = [(u, f"i{u + d}") for u in range(14) for d in (0, 1) if r.random() < 0.97]
    pairs += [(r.randrange(8), f"i{r.randrange(8)}") for _ in range(60)]
    pairs += [(None, "i1"), (3, None), (None, None), (None, "i13")]
    df = spark.createDataFrame(pairs, "u int, i string")
    expected = rows(K.retention(df, K.kcore(df, "u", "i", 2, 3), "u", "i"))
    assert rows(K.kcore_retention(df, "u", "i", 2, 3)) == expected and 0 < expected[1][2] < len(pairs)
    once = df.distinct()
    assert rows(K.kcore_retention(once, "u", "i", 1, 2, distinct=True)) == rows(K.kcore_retention(once, "u", "i", 1, 2))
    assert rows(K.kcore_retention(df.limit(0), "u", "i", 1, 1)) == [(m, 0, 0, None) for m in ("items", "rows", "users")]
