import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.sources import delimited, lines, tables


def test_glob_folder_and_gzip(spark, tmp_path, rows):
    for year in (2009, 2010, 2015, 2017):
        with gzip.open(tmp_path / f"{year}.csv.gz", "wt") as f:
            f.write(f"A,{year}0101,7\nB,{year}0102,\n")
    schema = "id string, day string, value int"
    one = delimited.read_delimited(spark, str(tmp_path / "2010.csv.gz"), schema)
    assert rows(one) == [("A", "20100101", 7), ("B", "20100102", None)]
    assert delimited.read_delimited(spark, str(tmp_path / "201[0-5].csv.gz"), schema).count() == 4
    assert delimited.read_delimited(spark, str(tmp_path), schema, spread=3).rdd.getNumPartitions() == 3
    assert delimited.read_delimited(spark, str(tmp_path), schema).count() == 8


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x,name\n1,2.5,u\n2,3.5,v\n")
    assert delimited.read_inferred(spark, str(tmp_path / "a.csv")).dtypes == [
        ("id", "int"),
        ("x", "double"),
        ("name", "string"),
    ]


def test_fixed_width(spark, tmp_path, rows):
    (tmp_path / "f.txt").write_text("AB1  12.5  Some name\nAB2        Other\nAB3\nAB4  oops  \n")
    spec = [("id", 1, 4, "string"), ("x", 6, 5, "double"), ("name", 12, 10, "string")]
    assert rows(lines.read_fixed_width(spark, str(tmp_path / "f.txt"), spec)) == [
        ("AB1", 12.5, "Some name"),
        ("AB2", None, "Other"),
        ("AB3", None, None),
        ("AB4", None, None),
    ]


def test_match_log(spark, rows):
    a, b = "SO" + "1" * 16, "TR" + "2" * 16
    text = [
        f"ERROR: <{a} {b}> An Artist  -  A Title  !=  Another  -  Its Title  -  live",
        f"< ERROR: <{a} {b}> Ok  -  Yes  !=  Oh  -  No",
        f"ERROR: <{a} {b}> no marks here",
        "something else",
        "",
    ]
    df = spark.createDataFrame([(x,) for x in text], "value string")
    assert rows(lines.parse_match_log(df)) == [(a, "An Artist", "A Title", b, "Another", "Its Title  -  live")]
    assert rows(lines.parse_match_log(df, "< ERROR: ")) == [(a, "Ok", "Yes", b, "Oh", "No")]


def test_attributes(spark, tmp_path, rows):
    (tmp_path / "attributes").mkdir()
    (tmp_path / "features").mkdir()
    (tmp_path / "attributes/m.attributes.csv").write_text("x,real\ny,NUMERIC\nid,string\nz,STRING\n")
    (tmp_path / "attributes/n.attributes.csv").write_text("x,real\n")
    (tmp_path / "features/m.csv").write_text("1.5,2,'TR',q\n")
    (tmp_path / "features/n.csv").write_text("4\n")
    loaded = delimited.load_many(spark, ["m", "n"], str(tmp_path))
    assert loaded["m"].dtypes == [("x", "double"), ("y", "double"), ("id", "string"), ("z", "string")]
    assert rows(loaded["m"]) == [(1.5, 2.0, "'TR'", "q")]
    assert rows(loaded["n"]) == [(4.0,)]
    types = delimited.attribute_types(spark, str(tmp_path / "attributes/*"))
    assert rows(types) == [("NUMERIC",), ("STRING",), ("real",), ("string",)]
    (tmp_path / "bad.csv").write_text("x,integer\n")
    with pytest.raises(ValueError, match="integer"):
        delimited.attribute_schema(spark, str(tmp_path / "bad.csv"))


def test_writing(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    path = str(tmp_path / "out")
    tables.write_table(df, path)
    tables.write_table(df.filter("n = 2"), path)
    assert rows(tables.read_table(spark, path)) == [("b", 2)]
    with pytest.raises(AnalysisException):
        tables.write_table(df, path, mode="error")
    tables.write_table(df, path + "_text", format="text")
    assert rows(lines.read_lines(spark, path + "_text")) == [("a\t1",), ("b\t2",)]
    tables.write_table(df, path + "_by", partition_by=["k"])
    by_key = tables.read_table(spark, path + "_by").filter("k = 'a'")
    assert by_key.count() == 1 and len(by_key.inputFiles()) == 2
    assert "PartitionFilters: [isnotnull(k" in by_key._jdf.queryExecution().executedPlan().toString()


def test_profile_and_peek(spark, rows):
    df = spark.range(5)
    assert rows(tables.profile({"r": df, "e": df.limit(0)})) == [("e", 0, 1, "id bigint"), ("r", 5, 1, "id bigint")]
    assert rows(tables.first_n(df, 2, [F.desc("id")])) == [(3,), (4,)]


def test_family_in_one_job_with_bad_lines(spark, tmp_path, rows):
    (tmp_path / "attributes").mkdir()
    (tmp_path / "features").mkdir()
    (tmp_path / "attributes/m.attributes.csv").write_text("x,real\r\ny, NUMERIC\n\n'id',string\n")
    (tmp_path / "attributes/n.attributes.csv").write_text("x,real\n")
    (tmp_path / "features/m.csv").write_text("1.5,2,'a'\nword,3,'b'\n4,5\n6,7,'c',8\n,,\n")
    (tmp_path / "features/n.csv").mkdir()
    (tmp_path / "features/n.csv/part-0.csv").write_text("1\n2\n")
    (tmp_path / "features/n.csv/part-1.csv").write_text("oops\n")
    tracker, group = spark.sparkContext.statusTracker(), "family"
    spark.sparkContext.setJobGroup(group, group)
    family = delimited.load_family(spark, ["m", "n"], str(tmp_path))
    spark.sparkContext.setJobGroup("after", "after")
    assert len(tracker.getJobIdsForGroup(group)) == 1
    assert family["m"].dtypes[:3] == [("x", "double"), ("y", "double"), ("'id'", "string")]
    got = rows(delimited.bad_lines(family))
    assert got == [("m", "m.csv", 5, 3), ("n", "part-0.csv", 2, 0), ("n", "part-1.csv", 1, 1)]
    bad = {r["_corrupt"]: (r["x"], r["y"]) for r in family["m"].where("_corrupt IS NOT NULL").collect()}
    assert bad == {"word,3,'b'": (None, 3.0), "4,5": (4.0, 5.0), "6,7,'c',8": (6.0, 7.0)}
    (tmp_path / "attributes/n.attributes.csv").write_text("x,real\ny,blob\n")
    with pytest.raises(ValueError, match="blob"):
        delimited.load_family(spark, ["m", "n"], str(tmp_path))
