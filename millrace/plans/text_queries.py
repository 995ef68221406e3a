"""Word, line and character counts over the documents; scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions.geo import haversine
from millrace.operators import mljobs, textcount
from millrace.operators.joins import edge_endpoints
from millrace.plans.registry import Tables, query
from millrace.plans.views import doc_lines, edges, nodes


@query("SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(value, ' ')) AS word FROM doc_lines) w GROUP BY word")
def word_count_space(t: Tables) -> DataFrame:
    return textcount.word_count(doc_lines(t), "space")


@query(
    """
SELECT word, COUNT(*) AS n
FROM (SELECT unnest(string_split_regex(value, '[ \\t\\n\\r\\f]+')) AS word FROM doc_lines) w
WHERE word <> '' GROUP BY word"""
)
def word_count_ws(t: Tables) -> DataFrame:
    return textcount.word_count(doc_lines(t), "whitespace")


@query(
    """
SELECT word, COUNT(*) AS n
FROM (SELECT unnest(string_split_regex(value, '[ ",()*]+')) AS word FROM doc_lines) w
WHERE word <> '' GROUP BY word"""
)
def word_count_pig(t: Tables) -> DataFrame:
    return textcount.word_count(doc_lines(t), "pig")


@query("SELECT value AS line, COUNT(*) AS n FROM doc_lines GROUP BY value")
def line_count(t: Tables) -> DataFrame:
    return textcount.line_count(doc_lines(t))


@query("SELECT COUNT(*) AS n FROM doc_lines")
def line_total(t: Tables) -> DataFrame:
    return doc_lines(t).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT character, COUNT(*) AS n
FROM (SELECT unnest(string_split(replace(value, ' ', ''), '')) AS character FROM doc_lines) c
WHERE character <> '' GROUP BY character"""
)
def char_count(t: Tables) -> DataFrame:
    return textcount.char_count(doc_lines(t))


@query(
    """
SELECT event_type AS word, CAST(SUM(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS n
FROM events WHERE value >= 20 GROUP BY event_type"""
)
def sum_counts(t: Tables) -> DataFrame:
    """Counts taken from the properties; those of small values do not read as a number."""
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    count = F.when(F.col("value") < 20, F.concat(digits, F.lit("x"))).otherwise(digits)
    line = F.concat_ws("\t", "event_type", count)
    return textcount.sum_counts(textcount.parse_pairs(t.events.select(line.alias("value"))), "word", "count")


_STOP = ", ".join(f"'{w}'" for w in mljobs.STOP_WORDS)


@query(
    f"""
SELECT word, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS n_texts
FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '\\W')) AS word FROM documents) w
WHERE word <> '' AND word NOT IN ({_STOP})
GROUP BY word HAVING COUNT(DISTINCT doc_id) >= 5 ORDER BY n DESC, word LIMIT 10000"""
)
def vocabulary(t: Tables) -> DataFrame:
    return mljobs.vocabulary(t.documents.select("text"), "text")


@query(
    """
SELECT c_custkey, substring(c_name, 1, 8) AS kind, CAST(substring(c_name, 10, 9) AS BIGINT) AS number,
       COALESCE(TRY_CAST(CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS DOUBLE), -1) AS cast_number,
       substring('''' || c_name || '''', 2, 18) AS unquoted, ROUND(c_acctbal / 10, 4) AS units,
       c_acctbal * (c_nationkey - 12) < 0 AS opposite
FROM customer"""
)
def scalar_suite(t: Tables) -> DataFrame:
    """Cutting, trimming, casting, unquoting, scaling and the sign test."""
    text = F.concat(F.lit("  "), "c_name", F.lit(" "))
    number = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_custkey").cast("string"))
    return t.customer.select(
        "c_custkey",
        C.cut(C.clean(text), 1, 8).alias("kind"),
        C.cut("c_name", 10, 9).try_cast("bigint").alias("number"),
        F.coalesce(C.clean(number).try_cast("double"), F.lit(-1.0)).alias("cast_number"),
        C.strip_quotes(F.concat(F.lit("'"), "c_name", F.lit("'"))).alias("unquoted"),
        F.round(C.tenths("c_acctbal"), 4).alias("units"),
        C.opposite_signs("c_acctbal", F.col("c_nationkey") - 12).alias("opposite"),
    )


@query(
    """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INT) AS year,
       CASE WHEN o_orderstatus = 'P' THEN '-' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders"""
)
def date_suite(t: Tables) -> DataFrame:
    """Years and dates from both spellings, and from one that is neither."""
    form = F.col("o_orderstatus")
    text = (
        F.when(form == "F", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(form == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    )
    day = F.coalesce(C.parse_date(text).cast("string"), F.lit("-"))
    return t.orders.select("o_orderkey", C.year_of(text).alias("year"), day.alias("day"))


@query("SELECT event_id, ROUND(CAST('0x' || substring(md5('f14:' || event_id), 1, 8) AS BIGINT) / 4294967296.0, 6) AS fraction FROM events")
def hash_fraction(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round(C.hash_fraction("event_id", "f14"), 6).alias("fraction"))


@query(
    """
SELECT carrier_id, COUNT(*) AS n_edges, ROUND(SUM(2 * 6373.0 * atan2(sqrt(h), sqrt(1 - h))) / COUNT(*), 6) AS mean_km
FROM (
  SELECT carrier_id,
         LEAST(1.0, power(sin(radians(d.latitude - s.latitude) / 2), 2) + cos(radians(s.latitude))
         * cos(radians(d.latitude)) * power(sin(radians(d.longitude - s.longitude) / 2), 2)) AS h
  FROM edges JOIN nodes s ON s.node_id = src_id JOIN nodes d ON d.node_id = dst_id) ends
GROUP BY carrier_id""",
    name="haversine",
)
def edge_distance(t: Tables) -> DataFrame:
    """Mean great-circle length of each carrier's edges."""
    ends = edge_endpoints(edges(t), nodes(t), "src_id", "dst_id", "node_id", ["latitude", "longitude"])
    km = haversine("src_latitude", "src_longitude", "dst_latitude", "dst_longitude")
    return ends.groupBy("carrier_id").agg(
        F.count(F.lit(1)).alias("n_edges"), F.round(F.avg(km), 6).alias("mean_km")
    )
