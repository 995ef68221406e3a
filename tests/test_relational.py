import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import filters as P
from millrace.operators import joins as J
from millrace.operators import ranking as R


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture(scope="module")
def inventory(spark):
    return frame(
        spark,
        "id string, element string, first int, last int",
        ("a", "P", 1950, 1960),
        ("a", "P", 1970, 1980),  # one element in two spans
        ("a", "T", 1955, 1990),
        ("b", "W", 2000, 2001),  # nothing from the core
        ("c", "P", 1990, 1991),
        ("d", "P", 1990, 1991),
        ("d", "W", 1980, 1981),
    )


CORE = ["P", "T"]


def test_element_counts(inventory, rows):
    counts = A.element_counts(inventory, "id", "element", CORE)
    assert rows(counts) == [("a", 2, 2, 0), ("b", 1, 0, 1), ("c", 1, 1, 0), ("d", 2, 1, 1)]
    assert rows(A.full_core(counts, CORE), "id") == [("a",)]


def test_only(inventory, rows):
    assert rows(A.only_core(inventory, "id", "element", CORE, "P")) == [("c",), ("d",)]
    assert rows(A.only(inventory, "id", "element", "P")) == [("c",)]


def test_span_and_activity_in_a_year(inventory, rows):
    assert rows(A.active_span(inventory, "id", "first", "last"))[0] == ("a", 1950, 1990)
    assert rows(P.active_in(inventory, "first", "last", 1980), "id") == [("a",), ("a",), ("d",)]


def test_flags(spark, rows):
    df = frame(spark, "id int, x string, y string", (1, "G", "H"), (2, "", "H"), (3, None, " "))
    assert rows(P.where_flags(df, ["x", "y"]), "id") == [(1,)]
    assert rows(P.where_flags(df, ["x", "y"], "any"), "id") == [(1,), (2,)]


def test_projections(spark):
    df = frame(spark, "a int, b double, c string, d double", (1, 2.0, "x", 3.0))
    assert P.select_except(df, ["a", "c"]).columns == ["b", "d"]
    assert P.select_by_type(df, ["double"]).columns == ["b", "d"]
    assert P.select_all_but_last(df).columns == ["a", "b", "c"]
    cased = P.case_column(df, "e", [(F.col("a") > 5, "big"), (F.col("a") > 0, "small")], "none")
    assert cased.first()["e"] == "small"


def test_membership_and_sign(spark, rows):
    df = frame(spark, "id int, x double", (1, -1.0), (2, 0.0), (3, 2.0), (4, None))
    assert rows(P.where_in(df, "id", [1, 3], negate=True), "id") == [(2,), (4,)]
    assert [rows(P.where_sign(df, "x", s), "id") for s in (-1, 0, 1)] == [[(1,)], [(2,)], [(3,)]]
    assert rows(P.where_equal(df, "id", 1, negate=True), "id") == [(2,), (3,), (4,)]


def test_rows_of_a_year(spark, rows):
    df = frame(spark, "id int, d string", (1, "20150101"), (2, "2015-12-31"), (3, "20160101"), (4, None))
    dated = df.withColumn("t", F.coalesce(F.try_to_date("d", "yyyyMMdd"), F.try_to_date("d", "yyyy-MM-dd")))
    stamped = dated.withColumn("s", F.col("t").cast("timestamp_ntz"))
    assert all(rows(P.where_year(stamped, c, 2015), "id") == [(1,), (2,)] for c in ("d", "t", "s"))


def test_counts_fill_zero(spark, rows):
    dim = frame(spark, "code string", ("NZ",), ("AQ",))
    fact = frame(spark, "c string", ("NZ",), ("NZ",), ("XX",))
    assert rows(J.count_into(dim, fact, "code", "c")) == [("AQ", 0), ("NZ", 2)]


def test_lookup_keeps_unmatched(spark, rows):
    dim = frame(spark, "code string, name string", ("NZ", "New Zealand"))
    fact = frame(spark, "id int, c string", (1, "NZ"), (2, "XX"), (3, None))
    got = rows(J.lookup(fact, dim, "c", "code", {"name": "country"}), "id", "country")
    assert got == [(1, "New Zealand"), (2, None), (3, None)]
    assert rows(J.lookup_few(fact, dim, "c", "code", {"name": "country"}), "id", "country") == got


def test_string_keys_against_numbers(spark, rows):
    routes = frame(spark, "src string", ("1",), ("\\N",))
    airports = frame(spark, "airport_id int, name string", (1, "A"))
    keyed = routes.withColumn("src", F.col("src").try_cast("int"))
    assert rows(J.lookup(keyed, airports, "src", "airport_id", {"name": "name"}), "name") == [("A",), (None,)]


def test_rejected_and_accepted(spark, rows):
    fact = frame(spark, "song string, user int", ("s1", 1), ("s2", 1), ("s3", 2), ("s3", 3))
    rejected = frame(spark, "song string, track string", ("s1", "t1"), ("s2", "t2"), ("s2", "t9"))
    accepted = frame(spark, "song string, track string", ("s2", "t2"))
    assert rows(J.drop_rejected(fact, rejected, accepted, ["song"]), "song") == [("s2",), ("s3",), ("s3",)]
    strict = J.drop_rejected(fact, rejected, accepted, ["song"], ["song", "track"])
    assert rows(strict, "song") == [("s3",), ("s3",)]


def test_two_routes_to_missing_keys(spark, rows):
    fact = frame(spark, "id string", ("a",), ("a",), ("b",), (None,))
    dim = frame(spark, "id string", ("b",))
    assert rows(J.missing_keys(fact, dim, "id")) == rows(J.missing_keys(fact, dim, "id", via="except")) == [("a",)]


def test_second_chance_key(spark, rows):
    df = frame(spark, "name string, two string", ("New Zealand", "NZ"), ("Aotearoa", "NZ"), ("Nowhere", "ZZ"))
    dim = frame(spark, "country string, a2 string, a3 string", ("New Zealand", "NZ", "NZL"))
    got = J.lookup_with_fallback(df, dim, [("name", "country"), ("two", "a2")], "a3", "code")
    assert rows(got, "name", "code") == [("Aotearoa", "NZL"), ("New Zealand", "NZL"), ("Nowhere", None)]


def test_serving(spark, rows):
    edges = frame(spark, "line int, s string, d string", (1, "AKL", "SYD"), (2, "SYD", "AKL"), (2, "AKL", "SYD"), (3, "X", "Y"))
    lines = frame(spark, "line int, name string", (1, "One"), (2, "Two"), (3, "Three"))
    assert rows(J.serving(edges, lines, "AKL", "s", "d", "line", "name")) == [(1, "One"), (2, "Two")]


def test_namesakes_are_not_merged(spark, rows):
    edges = frame(spark, "s int, d int", (1, 3), (2, 3), (2, 3))
    nodes = frame(spark, "id int, name string, lat double", (1, "Same", 10.0), (2, "Same", 20.0), (3, "South", -5.0))
    by_src = A.crossing_counts(edges, nodes, "s", "d", "id", "name", "lat", "src")
    assert rows(by_src) == [(1, "Same", 1), (2, "Same", 2)]
    by_dst = A.crossing_counts(edges, nodes, "s", "d", "id", "name", "lat", "dst")
    assert rows(by_dst) == [(3, "South", 3)]


def test_top_by_edges_orders_outside_and_breaks_ties(spark):
    edges = frame(spark, "s int, d int", *[(s, d) for s in (1, 2, 3) for d in range(s % 2 + 1)], (9, 1))
    nodes = frame(spark, "id int, name string", (1, "a"), (2, "b"), (3, "c"))
    got = [tuple(r) for r in A.top_by_edges(edges, nodes, "s", "d", "id", "name", 3).collect()]
    assert got == [(1, "a", 2), (3, "c", 2), (2, "b", 1)]
    assert A.top_by_edges(edges, nodes, "s", "d", "id", "name").collect()[-1] == (9, None, 1)
    reach = frame(spark, "s int, d int", (1, 1), (1, 1), (2, 1), (2, 2))
    assert [r[0] for r in A.top_by_reach(reach, nodes, "s", "d", "id", "name", 5).collect()] == [2, 1]


def test_has_without(spark, rows):
    df = frame(spark, "id int, e string", (1, "min"), (1, "max"), (2, "min"), (3, "max"), (4, "min"), (4, "other"))
    assert rows(A.has_without(df, ["id"], "e", "min", "max")) == [(2,), (4,)]


def test_means(spark, rows):
    df = frame(spark, "y int, c string, v double", (1, "a", 1.0), (1, "a", 3.0), (2, "a", 10.0))
    assert rows(A.mean_by(df, ["y", "c"], "v")) == [(1, "a", 2.0), (2, "a", 10.0)]
    assert rows(A.mean_of_means(df, ["y"], ["c"], "v")) == [("a", 6.0)]


def test_broadcast_only_when_small(spark, plan):
    big, small = spark.range(1000), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(J.join_dim(big, small, "id", broadcast=True))
        assert "BroadcastHashJoin" not in plan(big.join(J.broadcast_if_small(small, max_rows=9), "id"))
        assert "BroadcastHashJoin" not in plan(big.join(J.broadcast_if_small(small, max_bytes=20), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_breaks_ties_by_item(spark, rows):
    df = frame(spark, "u int, i int, w int", (1, 5, 2), (1, 4, 2), (1, 6, 2), (1, 7, 9), (2, 1, 1))
    assert rows(R.top_k_per_group(df, "u", "i", "w", 3)) == [(1, [7, 4, 5]), (2, [1])]


def test_top_k_is_cut_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("u"), F.col("id").alias("i"), F.col("id").alias("w"))
    assert plan(R.top_k_per_group(df, "u", "i", "w", 3)).count("WindowGroupLimit") == 2


def test_top_groups(spark, rows):
    df = frame(spark, "e string, id int", ("x", 1), ("x", 2), ("y", 3), ("z", 4), ("z", 5))
    assert [tuple(r) for r in R.top_groups(df, "e", 2).collect()] == [("x", 2), ("z", 2)]
    assert rows(R.keep_top_groups(df, "e", 1), "id") == [(1,), (2,)]


def test_every_nth(spark):
    df = spark.range(35).withColumn("n", 100 - F.col("id"))
    got = R.every_nth(df, [F.desc("n"), F.asc("id")], 10, 25).orderBy("rank").collect()
    assert [(r["id"], r["rank"]) for r in got] == [(0, 1), (10, 11), (20, 21)]


def test_top_confident_sorts_by_the_class_itself(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(1, Vectors.dense(0.4, 0.6), 1.0), (2, Vectors.dense(0.1, 0.9), 1.0), (3, Vectors.dense(0.8, 0.2), 0.0)],
        ["id", "probability", "prediction"],
    )
    assert [r["id"] for r in R.top_confident(df, 1, 5, "id").collect()] == [2, 1]


def test_top_rows_beyond_the_group_limit(spark, rows):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v")).repartition(6)
    top = R.top_rows_per_group(df, ["g"], [F.desc("v")], 1500)
    assert top.count() == 3000
    assert top.agg(F.min("v")).first()[0] == 2000
    assert rows(top.filter("rank = 1"), "g", "v") == [(0, 4998), (1, 4999)]


def test_hot_keys_are_split_in_joins(spark, tmp_path, rows):
    """Two thirds of the rows under one key: adaptive execution cuts that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    path = str(tmp_path / "facts")
    hot = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000)
    spark.range(60000).select(hot.alias("k"), F.col("id").alias("v")).repartition(6).write.parquet(path)
    fact = spark.read.parquet(path)
    keys = fact.filter("k < 500").select("k")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = J.keep_matching(fact, keys, "k")
        assert kept.count() == fact.filter("k < 500").count()
        kept.write.format("noop").mode("overwrite").save()
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
        dropped = J.drop_rejected(fact, keys, keys.limit(0), ["k"])
        assert dropped.count() == fact.filter("k >= 500").count()
    finally:
        for name in settings:
            spark.conf.unset(name)
