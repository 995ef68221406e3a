"""Lookups, reconciliation and set differences.

Nothing is broadcast by command. A side read from a file or from a written
intermediate table has a known size, and the planner broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``; anything else is a shuffled join whose
hot partitions adaptive execution splits. ``broadcast_if_small`` serves the one
case the planner cannot see, a side computed from an aggregate or a filter, and it
measures the side first.

Adaptive execution splits a hot key only where both sides of the join are freshly
shuffled, not where one is the result of an aggregation on that key. Key sets that
have to be made distinct are therefore written before they are joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 2**20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark for broadcast only when both the rows and their size as text stay within bounds.

    Measuring stops soon after ``max_rows``; a larger side is left to a shuffled join.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, bytes_ = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if rows <= max_rows and (bytes_ or 0) <= max_bytes else df


def key_table(keys: DataFrame, on: list[str]) -> DataFrame:
    """The distinct keys as a written table: of known size, and splittable when shuffled."""
    return materialise(keys.select(*on).distinct(), "keys")


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, take: dict[str, str]) -> DataFrame:
    """Add columns of ``dim`` (``take``: its column -> new name) by a key named differently there."""
    side = dim.select(F.col(dim_key).alias(key), *[F.col(c).alias(name) for c, name in take.items()])
    return df.join(side, key, "left")


def enrich(df: DataFrame, *aggs: DataFrame, on: str | list[str]) -> DataFrame:
    """Add the columns of several per-key tables; keys they lack stay null."""
    return reduce(lambda left, right: left.join(right, on, "left"), aggs, df)


def count_into(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, name: str = "n") -> DataFrame:
    """The dimension with the number of fact rows per key, zero where there are none."""
    counts = fact.groupBy(F.col(fact_key).alias(dim_key)).agg(F.count(F.lit(1)).alias(name))
    return dim.join(counts, dim_key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def join_dim(
    df: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner", broadcast: bool = False
) -> DataFrame:
    """Fact to dimension. ``broadcast`` asks for it, and is granted if the side is small."""
    return df.join(broadcast_if_small(dim) if broadcast else dim, on, how)


def lookup_few(few: DataFrame, dim: DataFrame, key: str, dim_key: str, take: dict[str, str]) -> DataFrame:
    """``lookup`` for a short list (a top-n report) against a table of any size.

    The list is worked out once and written, so that its size is known: below the
    planner's threshold it is broadcast to a single scan of the table, which keeps the
    matching rows only.
    """
    few = materialise(few, "few")
    side = dim.select(F.col(dim_key).alias(key), *[F.col(c).alias(name) for c, name in take.items()])
    found = side.join(key_table(few, [key]), key, "left_semi")
    return few.join(found, key, "left")


def drop_rejected(
    fact: DataFrame, rejected: DataFrame, accepted: DataFrame, on: list[str], accepted_on: list[str] | None = None
) -> DataFrame:
    """Fact rows without those whose key was rejected and not accepted after all.

    ``accepted_on`` names the key that takes a rejection back: by default the same
    key, or a longer one when a rejection is about a pair.
    """
    standing = rejected.join(accepted, accepted_on or on, "left_anti")
    return fact.join(key_table(standing, on), on, "left_anti")


def complement(df: DataFrame, part: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows of ``df`` that are not in ``part``, by a key that is unique in both."""
    names = [on] if isinstance(on, str) else on
    return df.join(part.select(*names), names, "left_anti")


def keep_matching(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``keys``."""
    names = [on] if isinstance(on, str) else on
    return df.join(key_table(keys, names), names, "left_semi")


def edge_endpoints(
    edges: DataFrame, nodes: DataFrame, src: str, dst: str, node_key: str, take: list[str]
) -> DataFrame:
    """Edges with the node columns of both ends, prefixed src_ and dst_; both ends must be known."""
    for end, prefix in ((src, "src_"), (dst, "dst_")):
        side = nodes.select(F.col(node_key).alias(end), *[F.col(c).alias(prefix + c) for c in take])
        edges = edges.join(side, end, "inner")
    return edges


def missing_keys(fact: DataFrame, dim: DataFrame, on: str, via: str = "join") -> DataFrame:
    """Distinct known keys of the fact table that the dimension lacks, by anti join or set difference."""
    keys = fact.select(on).filter(F.col(on).isNotNull())
    if via == "join":
        return keys.distinct().join(dim.select(on).distinct(), on, "left_anti")
    return keys.subtract(dim.select(on))


def lookup_with_fallback(
    df: DataFrame, dim: DataFrame, keys: list[tuple[str, str]], take: str, name: str
) -> DataFrame:
    """The ``take`` column of ``dim`` by the first of several (key, dim key) pairs that matches.

    Each side, a row per key, is written, so that a hot key of ``df`` can be split.
    """
    tries = []
    for i, (key, dim_key) in enumerate(keys):
        found = f"_found_{i}"
        side = dim.groupBy(F.col(dim_key).alias(key)).agg(F.min(take).alias(found))
        df = df.join(materialise(side, "side"), key, "left")
        tries.append(found)
    return df.withColumn(name, F.coalesce(*tries)).drop(*tries)


def serving(edges: DataFrame, carriers: DataFrame, node, src: str, dst: str, key: str, name: str) -> DataFrame:
    """Distinct carriers with an edge from or to the node."""
    keys = edges.filter((F.col(src) == node) | (F.col(dst) == node)).select(key).distinct()
    return carriers.join(keys, key, "left_semi").select(key, name).distinct()


def union_all(parts: list[DataFrame]) -> DataFrame:
    """One table of several with the same columns."""
    return reduce(DataFrame.unionByName, parts)
