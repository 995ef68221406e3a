"""Binding of query names to callables over a folder of tables, and to SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import read_table

TABLE_NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


class Tables:
    """The given tables as attributes, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return read_table(self.spark, f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name, with the equivalent SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(build, with_views(sql) if sql else None)
        return build

    return register


# The views that give the tables the shapes the jobs work on, as SQL. ``views`` holds
# the same ones as DataFrames.
VIEW_SQL = {
    "plays": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(SUM(l_quantity) AS BIGINT) AS plays
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey""",
    "obs": """
        SELECT user_id AS id, CAST(YEAR(ts) * 10000 + MONTH(ts) * 100 + DAY(ts) AS INT) AS day,
               event_type AS element, value
        FROM events""",
    "inventory": """
        SELECT id, element, MIN(day) AS first_day, MAX(day) AS last_day
        FROM obs WHERE value > 150 GROUP BY id, element""",
    "nodes": """
        SELECT n_nationkey AS node_id, n_name AS node_name,
               CAST(n_nationkey * 7 - 84 AS DOUBLE) AS latitude,
               CAST(n_nationkey * 14 - 170 AS DOUBLE) AS longitude
        FROM nation""",
    "edges": """
        SELECT l_suppkey AS carrier_id, s_nationkey AS src_id, c_nationkey AS dst_id,
               l_quantity AS quantity, l_shipdate AS shipdate
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey""",
    "stations": """
        SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation_id,
               CAST((s_suppkey * 37) % 181 - 90 AS DOUBLE) AS latitude,
               CAST((s_suppkey * 73) % 361 - 180 AS DOUBLE) AS longitude
        FROM supplier""",
    "doc_lines": """
        SELECT unnest(string_split(text, chr(10))) AS value FROM documents""",
}


def with_views(sql: str) -> str:
    """The statement with the views it uses put in front as common table expressions."""
    used: list[str] = []

    def need(text: str) -> None:
        for view, body in VIEW_SQL.items():
            if view not in used and re.search(rf"\b(FROM|JOIN)\s+{view}\b", text):
                need(body)
                used.append(view)

    need(sql)
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{view} AS ({VIEW_SQL[view]})" for view in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
