"""The most frequent keys without shuffling all keys.

Each task keeps a summary of at most ``counters`` keys: when there are twice as many, the count
of the first one too many is taken from all, and those at zero or below leave. A task knows by
how much its counts may be too small, its slack. Summaries add up: a key's count is at least the
sum of what the tasks report, and at most that sum plus the sum of all slacks, also if no task
reports it.

So the first ``n`` keys by reported counts bound the n-th true count from below, and only keys
whose greatest possible count reaches this bound can be among the first ``n``. These few are
counted exactly. If a key that nobody reports could reach the bound, or the candidates are too
many to be sent to the tasks, the summary proves nothing and all keys are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.operators.ranking import top_groups

COUNTERS = 1 << 14
CANDIDATES = 1 << 18  # keys that are sent to all tasks at most


def _reduced(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """Counts per key, thinned to ``counters`` of them, and by how much they were lowered."""
    table = table.group_by("key").aggregate([("n", "sum")]).select(["key", "n_sum"]).rename_columns(["key", "n"])
    if table.num_rows <= counters:
        return table, 0
    least = pc.array_sort_indices(table["n"], order="descending")[counters].as_py()
    lowered = table["n"][least].as_py()
    table = table.set_column(1, "n", pc.subtract(table["n"], lowered))
    return table.filter(pc.greater(table["n"], 0)), lowered


def _summary(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    held, size, slack = [], 0, 0
    kind = None
    for batch in batches:
        counted = batch.column(0).value_counts()
        kind = batch.column(0).type
        held.append(pa.table({"key": counted.field("values"), "n": counted.field("counts")}))
        size += len(counted)
        if size > 2 * counters:
            table, lowered = _reduced(pa.concat_tables(held), counters)
            held, size, slack = [table], table.num_rows, slack + lowered
    if not held:
        return
    table, lowered = _reduced(pa.concat_tables(held), counters)
    slack += lowered
    for part in table.combine_chunks().to_batches():
        yield pa.RecordBatch.from_arrays([pa.array([True] * part.num_rows), part.column(0), part.column(1)], ["_is_key", "key", "n"])
    yield pa.RecordBatch.from_arrays(
        [pa.array([False]), pa.nulls(1, kind), pa.array([slack], pa.int64())], ["_is_key", "key", "n"]
    )


def summary(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """The written summaries of all tasks: (_is_key, key, n), the rows that are no keys with a task's slack."""
    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key")).mapInArrow(partial(_summary, counters=counters), f"_is_key boolean, key {kind}, n long")
    return materialise(rows, "summary")


def _candidates(found: DataFrame, n: int, most: int) -> DataFrame | None:
    """The keys that may be among the first ``n``, as a written table; None if nothing is sure."""
    slack = found.where("NOT _is_key").agg(F.sum("n")).first()[0] or 0
    counts = materialise(found.where("_is_key").groupBy("key").agg(F.sum("n").alias("n")), "reported")
    first = counts.orderBy(F.desc("n")).limit(n).agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("least")).first()
    least = first["least"] or 0
    if slack and (first["keys"] < n or slack >= least):
        return None
    kept = materialise(counts.where(F.col("n") + slack >= (least if first["keys"] == n else 0)).select("key"), "candidates")
    return kept if kept.count() <= most else None


def heavy_hitters(df: DataFrame, key: str, n: int, counters: int = COUNTERS, most: int = CANDIDATES) -> DataFrame:
    """The ``n`` most frequent keys with their counts, ties to the smaller key, as ``top_groups`` gives them.

    ``df`` is read twice, or once more where the summary proves nothing.
    """
    candidates = _candidates(summary(df, key, counters), n, most)
    if candidates is None:
        return top_groups(df, key, n)
    few = F.broadcast(candidates.withColumnRenamed("key", "_key"))  # at most ``most`` keys
    return top_groups(df.select(key).join(few, F.col(key).eqNullSafe(F.col("_key"))).drop("_key"), key, n)
