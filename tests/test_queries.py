"""Every registered query against its SQL twin, and the shape of its plan."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from millrace import lineage
from tests import oracle

FOLDER = "/root/testdata/sf0.001"
EMPTY_HERE = {"active_in_period"}  # nothing of that day in the smallest tables


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, con, plan, name):
    """The same rows, with no cross join and no rows through Python."""
    df = queries()[name](spark, FOLDER)
    problem = oracle.compare(con, df, oracle_sql()[name])
    assert problem is None or (problem == "no rows" and name in EMPTY_HERE)
    text = plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def test_the_comparison_sees_differences(spark, con):
    right, sql = queries()["count_by_type"](spark, FOLDER), oracle_sql()["count_by_type"]
    assert oracle.compare(con, right, sql) is None
    assert "differ" in oracle.compare(con, right.withColumn("n", F.col("n") + 1), sql)
    assert "rows against" in oracle.compare(con, right.limit(2), sql)
    assert "columns" in oracle.compare(con, right.withColumnRenamed("n", "m"), sql)
    assert "types" in oracle.compare(con, right.withColumn("n", F.col("n").cast("double")), sql)


def test_entry(spark):
    got = entry(spark).collect()
    assert got and got[0]["n_edges"] == max(r["n_edges"] for r in got)


def test_two_routes_agree(spark):
    """The route question in SQL and in DataFrames, ordered outside the join."""
    routes = [[tuple(r) for r in queries()[n](spark, FOLDER).collect()] for n in ("top_by_edges", "top_by_edges_sql")]
    assert routes[0] == routes[1]


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(queries()["name_like"](spark, FOLDER))
    assert "StringContains(c_mktsegment,HOLD)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    text = plan(queries()["southern_stations"](spark, FOLDER))
    assert "ReadSchema: struct<s_suppkey:bigint>" in text
    text = plan(queries()["regional_series"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in text and "LessThan(l_shipdate,1999" in text
    assert "EqualTo(l_returnflag,A)" in text and "LessThan(s_nationkey,12)" in text
    text = plan(queries()["count_by_type"](spark, FOLDER))
    assert "ReadSchema: struct<event_type:string>" in text


class _Session:
    """As much of a session as the choice of the scratch folder looks at."""

    def __init__(self, master, settings, checkpoint_dir=None):
        self.sparkContext = self
        self.conf = settings
        self.master = master
        self.checkpoint_dir = checkpoint_dir

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, folder):
        self.checkpoint_dir = folder


def test_scratch_folder_is_the_clusters():
    named = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/checkpoints/"})
    assert lineage.shared_dir(named) == "hdfs:///shared/checkpoints"
    assert named.checkpoint_dir == "hdfs:///shared/checkpoints/"
    assert lineage.shared_dir(_Session("yarn", {}, "hdfs:///by/hand")) == "hdfs:///by/hand"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.shared_dir(_Session("yarn", {}))


def test_written_tables_cut_the_lineage(spark, plan):
    written = lineage.materialise(spark.range(3).withColumn("x", F.lit("a")), "probe")
    assert f"{lineage.shared_dir(spark).removeprefix('file:')}/millrace-" in written.inputFiles()[0]
    assert written.count() == 3 and "Range" not in plan(written)
