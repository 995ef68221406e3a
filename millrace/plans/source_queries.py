"""Sources and sinks: tables rendered to text in the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.lineage import scratch_path
from millrace.operators.joins import union_all
from millrace.operators.textcount import parse_pairs
from millrace.plans.registry import TABLE_NAMES, Tables, query
from millrace.plans.views import FEATURES, feat
from millrace.sources import delimited, lines, tables

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day string"


def _orders(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def read_delimited_roundtrip(t: Tables) -> DataFrame:
    """Compressed tab-separated files, a folder per year, read back as one table."""
    path = scratch_path(t.spark, "tsv")
    by_year = _orders(t).withColumn("year", C.year_of("day"))
    by_year.write.partitionBy("year").option("sep", "\t").option("compression", "gzip").csv(path)
    return delimited.read_delimited(t.spark, path, _ORDERS, sep="\t").drop("year")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_inferred_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    tables.write_table(t.customer, path, format="csv")
    read = delimited.read_inferred(t.spark, path)
    return read.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query(
    """
SELECT s_suppkey, CASE WHEN s_nationkey = 7 OR s_acctbal < 0 OR s_acctbal > 9000 THEN -1 ELSE s_acctbal END AS s_acctbal,
       CASE WHEN s_nationkey IN (3, 7) THEN '-' ELSE s_name END AS s_name
FROM supplier"""
)
def read_fixed_width(t: Tables) -> DataFrame:
    """Blank numbers, numbers that do not read as such, blank names, and lines cut short."""
    owed, nation = F.col("s_acctbal"), F.col("s_nationkey")
    balance = F.when(owed < 0, F.lit("")).when(owed > 9000, F.lit("n/a")).otherwise(owed.cast("string"))
    name = F.when(nation == 3, F.lit("")).otherwise(F.col("s_name"))
    key = F.rpad(F.col("s_suppkey").cast("string"), 11, " ")
    line = F.concat_ws(" ", key, F.rpad(balance, 8, " "), F.rpad(name, 25, " "))
    path = scratch_path(t.spark, "fixed")
    t.supplier.select(F.when(nation == 7, F.substring(line, 1, 11)).otherwise(line).alias("value")).write.text(path)
    spec = [("s_suppkey", 1, 11, "bigint"), ("s_acctbal", 13, 8, "double"), ("s_name", 22, 25, "string")]
    return lines.read_fixed_width(t.spark, path, spec).fillna({"s_acctbal": -1.0, "s_name": "-"})


@query(
    """
SELECT CASE WHEN p_brand LIKE 'Brand#1%' THEN 'accepted' ELSE 'mismatch' END AS kind,
       'SO' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS song_id, p_brand AS song_artist,
       CASE WHEN p_size > 40 THEN p_name || '  -  live' ELSE p_name END AS song_title,
       'TR' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS track_id, p_type AS track_artist, p_name AS track_title
FROM part WHERE p_type <> 'PROMO'"""
)
def parse_match_log(t: Tables) -> DataFrame:
    """Mismatches, matches accepted by hand, and lines of neither kind."""
    number = F.lpad(F.col("p_partkey").cast("string"), 16, "0")
    title = F.when(F.col("p_size") > 40, F.concat("p_name", F.lit("  -  live"))).otherwise(F.col("p_name"))
    prefix = (
        F.when(F.col("p_type") == "PROMO", "NOTE: ")
        .when(F.col("p_brand").like("Brand#1%"), "< ERROR: ")
        .otherwise("ERROR: ")
    )
    line = F.concat(
        prefix,
        F.concat(F.lit("<SO"), number, F.lit(" TR"), number, F.lit("> ")),
        F.concat_ws("  !=  ", F.concat_ws("  -  ", "p_brand", title), F.concat_ws("  -  ", "p_type", "p_name")),
    )
    path = scratch_path(t.spark, "log")
    t.part.select(line.alias("value")).write.text(path)
    log = lines.read_lines(t.spark, path)
    return union_all(
        [
            lines.parse_match_log(log, mark).select(F.lit(kind).alias("kind"), "*")
            for kind, mark in (("mismatch", "ERROR: "), ("accepted", "< ERROR: "))
        ]
    )


_DATASETS = {"moments": (FEATURES[:32], "real", "STRING"), "spectrum": (FEATURES[32:], "NUMERIC", "string")}


def _write_feature_files(t: Tables) -> str:
    """Two datasets, each of half the features and a quoted id, with their attribute files."""
    root = scratch_path(t.spark, "features")
    track = F.concat(F.lit("'TR"), F.lpad(F.col("vec_id").cast("string"), 16, "0"), F.lit("'"))
    for name, (cols, number, text) in _DATASETS.items():
        feat(t).select(*cols, track.alias("track")).write.csv(f"{root}/features/{name}.csv")
        listing = [(c, number) for c in cols] + [("track_id", text)]
        t.spark.createDataFrame(listing, "name string, type string").coalesce(1).write.csv(
            f"{root}/attributes/{name}.attributes.csv"
        )
    return root


@query(
    "SELECT 'TR' || lpad(CAST(vec_id AS VARCHAR), 16, '0') AS track_id, "
    + ", ".join(f"ROUND(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS {c}" for i, c in enumerate(FEATURES))
    + " FROM embeddings"
)
def read_with_attributes(t: Tables) -> DataFrame:
    loaded = delimited.load_many(t.spark, list(_DATASETS), _write_feature_files(t))
    keyed = {
        name: df.withColumn("track_id", C.strip_quotes("track_id")) for name, df in loaded.items()
    }
    joined = keyed["moments"].join(keyed["spectrum"], "track_id")
    return joined.select("track_id", *[F.round(c, 6).alias(c) for c in FEATURES])


@query(
    """
SELECT dataset, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE CASE dataset WHEN 'moments' THEN vec_id % 7 = 0 ELSE vec_id % 5 = 0 END) AS n_bad
FROM embeddings, (SELECT unnest(['moments', 'spectrum']) AS dataset) d GROUP BY dataset"""
)
def family_bad_lines(t: Tables) -> DataFrame:
    """Two datasets, one with words among its numbers, one with lines that end early."""
    root = _write_feature_files(t)
    rows = feat(t)
    for name, (cols, _, _) in _DATASETS.items():
        if name == "moments":
            line = [F.when(F.col("vec_id") % 7 == 0, "none").otherwise(F.col(cols[0]).cast("string")), *cols[1:], "vec_id"]
            text = F.concat_ws(",", *line)
        else:
            text = F.when(F.col("vec_id") % 5 == 0, F.concat_ws(",", *cols[:3])).otherwise(F.concat_ws(",", *cols, "vec_id"))
        rows.select(text.alias("value")).write.text(f"{root}/broken/{name}.csv")
    family = delimited.load_family(t.spark, list(_DATASETS), root, features="broken/{}.csv")
    return delimited.bad_lines(family).groupBy("dataset").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bad").alias("n_bad"))


@query(
    "SELECT DISTINCT CASE p_size % 4 WHEN 0 THEN 'NUMERIC' WHEN 1 THEN 'real' WHEN 2 THEN 'string' ELSE 'STRING' END AS type "
    "FROM part"
)
def attribute_types(t: Tables) -> DataFrame:
    """The type tokens of a listing with a line per part."""
    path = scratch_path(t.spark, "listing")
    tokens = F.array(*[F.lit(token) for token in delimited.ATTRIBUTE_TYPES])
    t.part.select("p_name", F.get(tokens, F.col("p_size") % 4)).write.csv(path)
    return delimited.attribute_types(t.spark, path)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>"}
_KIND = "CASE column_type " + " ".join(f"WHEN '{sql}' THEN '{kind}'" for sql, kind in _KINDS.items()) + " END"


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, (SELECT COUNT(*) FROM {name}) AS n_rows, COUNT(*) AS n_columns, "
        f"string_agg(column_name || ' ' || {_KIND}, ', ') AS columns FROM (DESCRIBE {name}) d"
        for name in TABLE_NAMES
    )
)
def dataset_profile(t: Tables) -> DataFrame:
    return tables.profile({name: getattr(t, name) for name in TABLE_NAMES})


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def write_read_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    tables.write_table(t.customer, path)
    tables.write_table(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)  # the second replaces the first
    return tables.read_table(t.spark, path)


@query("SELECT c_mktsegment AS word, CAST(COUNT(*) AS VARCHAR) AS count FROM customer GROUP BY c_mktsegment")
def write_read_text(t: Tables) -> DataFrame:
    """Key and count pairs as tab-separated text."""
    path = scratch_path(t.spark, "text")
    counts = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    tables.write_table(counts, path, format="text")
    return parse_pairs(lines.read_lines(t.spark, path))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def union_files(t: Tables) -> DataFrame:
    """One file set per order status, written in one pass and read as one table."""
    path = scratch_path(t.spark, "union")
    part = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderstatus").alias("status"))
    tables.write_table(part, path, format="csv", partition_by=["status"])
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    return delimited.read_delimited(t.spark, path, schema, header=True).drop("status")
