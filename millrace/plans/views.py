"""The given tables in the shapes the jobs work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.textcount import lines_of
from millrace.plans.registry import Tables

CORE = ["click", "view", "purchase"]
FEATURES = [f"f{i}" for i in range(64)]  # as many as an embedding has


def plays(t: Tables) -> DataFrame:
    """(user, item, weight)"""
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return lines.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("plays")
    )


def obs(t: Tables) -> DataFrame:
    """(id, day, element, value)"""
    day = F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")
    return t.events.select(
        F.col("user_id").alias("id"), day.cast("int").alias("day"), F.col("event_type").alias("element"), "value"
    )


def inventory(t: Tables) -> DataFrame:
    """(id, element, first day, last day)"""
    return (
        obs(t)
        .filter(F.col("value") > 150)
        .groupBy("id", "element")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    )


def nodes(t: Tables) -> DataFrame:
    """Nations as places."""
    return t.nation.select(
        F.col("n_nationkey").alias("node_id"),
        F.col("n_name").alias("node_name"),
        (F.col("n_nationkey") * 7 - 84).cast("double").alias("latitude"),
        (F.col("n_nationkey") * 14 - 170).cast("double").alias("longitude"),
    )


def edges(t: Tables) -> DataFrame:
    """Shipments as routes: a carrier goes from its nation to the customer's."""
    return (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            F.col("l_suppkey").alias("carrier_id"),
            F.col("s_nationkey").alias("src_id"),
            F.col("c_nationkey").alias("dst_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_shipdate").alias("shipdate"),
        )
    )


def stations(t: Tables) -> DataFrame:
    """Suppliers as points on the globe."""
    return t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"),
        ((F.col("s_suppkey") * 37) % 181 - 90).cast("double").alias("latitude"),
        ((F.col("s_suppkey") * 73) % 361 - 180).cast("double").alias("longitude"),
    )


def feat(t: Tables) -> DataFrame:
    """Embeddings with their elements as columns."""
    elements = [F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(FEATURES)]
    return t.embeddings.select("vec_id", "label", *elements)


def doc_lines(t: Tables) -> DataFrame:
    """The lines of all documents."""
    return lines_of(t.documents.select("text"), "text")
