"""Counts, spans, coverage and activity per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import year_of
from millrace.operators.joins import lookup, lookup_few


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, the null group included, most frequent first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *keys)


def active_span(df: DataFrame, id: str, first: str, last: str) -> DataFrame:
    """From the earliest start to the latest end per id."""
    return df.groupBy(id).agg(F.min(first).alias(first), F.max(last).alias(last))


def element_counts(df: DataFrame, id: str, element: str, core: list[str]) -> DataFrame:
    """Distinct elements per id: all of them, the core ones, and the others."""
    counts = (
        df.select(id, element)
        .distinct()
        .groupBy(id)
        .agg(
            F.count(element).alias("n_elements"),
            F.count(F.when(F.col(element).isin(core), 1)).alias("n_core"),
        )
    )
    return counts.withColumn("n_other", F.col("n_elements") - F.col("n_core"))


def full_core(counts: DataFrame, core: list[str]) -> DataFrame:
    """Ids that have every core element, from the result of ``element_counts``."""
    return counts.filter(F.col("n_core") == len(core))


def only_core(df: DataFrame, id: str, element: str, core: list[str], x: str) -> DataFrame:
    """Ids whose one core element is ``x``, whatever else they have."""
    in_core = F.col(element).isin(core)
    kept = df.groupBy(id).agg(
        F.bool_or(F.col(element) == x).alias("has_x"),
        F.bool_or(in_core & (F.col(element) != x)).alias("has_other_core"),
    )
    return kept.filter(F.col("has_x") & ~F.coalesce("has_other_core", F.lit(False))).select(id)


def only(df: DataFrame, id: str, element: str, x: str) -> DataFrame:
    """Ids that have ``x`` and no other element at all."""
    return df.groupBy(id).agg(F.bool_and(F.col(element) == x).alias("all_x")).filter("all_x").select(id)


def count_nonnull(df: DataFrame, keys: list[str], col: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(col).alias(name))


def mean_by(df: DataFrame, keys: list[str], value: str, name: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def mean_of_means(df: DataFrame, keys: list[str], outer: list[str], value: str, name: str = "mean") -> DataFrame:
    """The mean per ``outer`` key of the means per (``outer`` + ``keys``) group."""
    inner = df.groupBy(*outer, *keys).agg(F.avg(value).alias("_mean"))
    return inner.groupBy(*outer).agg(F.avg("_mean").alias(name))


def has_without(df: DataFrame, keys: list[str], col: str, has, lacks) -> DataFrame:
    """Groups in which one value occurs and another does not."""
    seen = df.groupBy(*keys).agg(
        F.bool_or(F.col(col) == has).alias("_has"), F.bool_or(F.col(col) == lacks).alias("_lacks")
    )
    return seen.filter(F.col("_has") & ~F.col("_lacks")).select(*keys)


def distinct_counts(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Distinct values of each column, over the table or per key."""
    return df.groupBy(*(keys or [])).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def dedupe(df: DataFrame) -> DataFrame:
    """Each full row once."""
    return df.dropDuplicates()


def activity(df: DataFrame, key: str, other: str, weight: str, count: str, total: str) -> DataFrame:
    """Per user or per item: rows with a counterpart, and the summed weight."""
    return df.groupBy(key).agg(F.count(other).alias(count), F.sum(weight).alias(total))


def year_coverage(df: DataFrame, date: str) -> DataFrame:
    """First year, last year and the number of years in between that occur."""
    years = df.select(year_of(date).alias("year"))
    return years.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_distinct("year").alias("n_years"),
    )


def values_per_group(df: DataFrame, key: str, col: str) -> DataFrame:
    """The distinct values a column takes in each group, as rows rather than one set per group."""
    return df.select(key, col).distinct()


def top_by_edges(
    edges: DataFrame,
    nodes: DataFrame,
    key: str,
    other: str,
    node_key: str,
    name: str,
    n: int | None = None,
) -> DataFrame:
    """Edges per node with the node's name, busiest first; the first ``n`` if given."""
    counts = edges.groupBy(key).agg(F.count(other).alias("n_edges"))
    return _named(counts, "n_edges", nodes, key, node_key, name, n)


def top_by_reach(
    edges: DataFrame,
    nodes: DataFrame,
    key: str,
    other: str,
    node_key: str,
    name: str,
    n: int | None = None,
) -> DataFrame:
    """Distinct opposite ends per node or carrier, the widest reach first."""
    counts = edges.groupBy(key).agg(F.count_distinct(other).alias("n_reached"))
    return _named(counts, "n_reached", nodes, key, node_key, name, n)


def _named(
    counts: DataFrame, measure: str, nodes: DataFrame, key: str, node_key: str, name: str, n: int | None
) -> DataFrame:
    order = [F.desc(measure), F.col(key)]
    if n is None:
        named = lookup(counts, nodes, key, node_key, {name: name})
    else:
        named = lookup_few(counts.orderBy(*order).limit(n), nodes, key, node_key, {name: name})
    return named.select(key, name, measure).orderBy(*order)


def crossing_counts(
    edges: DataFrame,
    nodes: DataFrame,
    src: str,
    dst: str,
    node_key: str,
    name: str,
    latitude: str,
    side: str = "src",
) -> DataFrame:
    """Edges that cross the equator, counted by the node at one end.

    The edges are counted per (source, destination) before the nodes are looked up,
    so the joins see each pair of nodes once however many edges run between them.
    """
    pairs = edges.groupBy(src, dst).agg(F.count(F.lit(1)).alias("_edges"))
    for end, lat in ((src, "_src_lat"), (dst, "_dst_lat")):
        pairs = pairs.join(nodes.select(F.col(node_key).alias(end), F.col(latitude).alias(lat)), end)
    key = src if side == "src" else dst
    counts = (
        pairs.filter(F.col("_src_lat") * F.col("_dst_lat") < 0)
        .groupBy(key)
        .agg(F.sum("_edges").alias("n_edges"))
    )
    return _named(counts, "n_edges", nodes, key, node_key, name, None)
