"""Connected components of a graph of any size, by alternating large and small stars.

Each step sends the edges of a node to its smallest neighbour: first the larger
neighbours of every node, then the smaller ones, until every edge leads from a node to
the smallest node it can reach; edges that are so from the start need no step. All steps are
joins on written tables, whose hot nodes adaptive execution can split, and minima with
partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, and no ``v`` is a ``u``: all ``v`` are then the smallest of their component."""
    ends = [F.struct(F.col(end).alias("node"), F.lit(end == "u").alias("leads")) for end in ("u", "v")]
    nodes = edges.select(F.inline(F.array(*ends))).groupBy("node")
    nodes = nodes.agg(F.count_if("leads").alias("out"), F.count_if(~F.col("leads")).alias("into"))
    return nodes.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node of a link between different nodes, with the smallest node it can reach."""
    large, small = F.greatest(a, b), F.least(a, b)
    edges = links.where(F.col(a) != F.col(b)).select(large.alias("u"), small.alias("v")).distinct()
    edges = materialise(edges, "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        stars = both.join(materialise(least, "least"), "u").where("v > u")
        edges = materialise(stars.select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        stars = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stars.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialise(stars.distinct(), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
