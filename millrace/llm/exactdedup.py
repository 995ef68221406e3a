"""Exact dedup by a tree-merge of sorted digest runs.

Every leaf (a task's share of the fingerprints) is sorted by digest and reduced to a
run: one entry per digest with its smallest identifier and its count. Runs then meet
in rounds of a ``fan_in``-nomial tree. In round ``r`` the leaves stand in groups of
``fan_in ** (r + 1)``, and a group splits the digests into as many ranges, one per
node: each node gets its range from ``fan_in`` nodes of the round before, merges these
sorted runs and keeps the smallest identifier. So all nodes work in every round, the
last round has one node per range of digests, and none ever holds more than its
share. A digest of a third of all rows is one entry per leaf from the start.

What is merged agrees in the SHA-256 digest and, as verification at every level, in
the length and in an independent 64-bit hash of the normalised text.

Defined results: a null text counts as empty. A null ``doc_id`` is larger than any
other; a group of null ids alone has a null ``keep_id``. Of repeated rows (equal text
and id) exactly one is kept. An empty table gives an empty result; further columns are
ignored by ``exact_groups`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise

BLANKS = r"[\x20\x09-\x0D]+"
RUN_SCHEMA = "digest binary, length long, check long, keep_id long, keep_row long, n long, leaf long"
_KEY = ["digest", "length", "check"]


def _in_order(entries: DataFrame) -> DataFrame:
    """Every partition as a sorted run."""
    return entries.sortWithinPartitions(*_KEY, F.col("keep_id").asc_nulls_last(), "keep_row")


def normalised(text: Column) -> Column:
    """The text with every run of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _fingerprint(text: Column) -> list[Column]:
    return [
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("length"),
        F.xxhash64(text).alias("check"),
    ]


def _reduce_sorted(batches: Iterator[pa.RecordBatch], leaf: int | None) -> Iterator[pa.RecordBatch]:
    """One entry per key of rows sorted by key and identifier; the first has the smallest one."""
    held: pa.Table | None = None  # the last key's entry, which may go on in the next batch
    for batch in batches:
        table = pa.Table.from_arrays(batch.columns, batch.schema.names)  # without "not null"
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        table = table.combine_chunks()
        digest = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint64).reshape(-1, 4)
        rest = np.stack([table[c].to_numpy().view(np.uint64) for c in _KEY[1:]], axis=1)
        key = np.concatenate([digest, rest], axis=1)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        reduced = table.take(starts)
        n = np.add.reduceat(table["n"].to_numpy(), starts)
        reduced = reduced.set_column(reduced.column_names.index("n"), "n", pa.array(n, pa.int64()))
        if leaf is not None:
            own = pa.array(np.full(len(starts), leaf), pa.int64())
            reduced = reduced.set_column(reduced.column_names.index("leaf"), "leaf", own)
        held = reduced.slice(reduced.num_rows - 1)
        yield from reduced.slice(0, reduced.num_rows - 1).to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _first_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _reduce_sorted(batches, TaskContext.get().partitionId())


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _reduce_sorted(batches, None)


def merged_runs(fingerprints: DataFrame, fan_in: int = 8) -> DataFrame:
    """(digest, length, check, keep_id, keep_row, n): one row per distinct text.

    ``fingerprints`` is a written table of (doc_id, digest, length, check, row).
    """
    columns = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    entries = fingerprints.select(
        *_KEY, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("leaf"),
    )
    runs = materialise(_in_order(entries).mapInArrow(_first_run, RUN_SCHEMA), "runs")
    leaves = (runs.agg(F.max("leaf")).first()[0] or 0) + 1
    share = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long") / F.lit(2.0**48)
    width = 1
    while width < leaves:
        width *= fan_in
        group, part = F.floor(F.col("leaf") / width), F.floor(share * width)
        nodes = -(-leaves // width) * width
        met = runs.withColumn("node", group * width + part).repartition(nodes, "node")
        runs = _in_order(met).select(columns).mapInArrow(_merge_runs, RUN_SCHEMA)
    return runs.drop("leaf")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    keyed = keyed.select("doc_id", *_fingerprint(F.col("text")))
    fingerprints = materialise(keyed.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    groups = materialise(merged_runs(fingerprints, fan_in).where("n > 1"), "copies")
    found = fingerprints.join(groups, _KEY, "left")
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` whose text no kept row has already, with all their columns."""
    groups = exact_groups(docs, id_col, text_col, fan_in)
    key = [F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_digest")]
    chosen = materialise(groups.where("kept").select(*key), "chosen")
    repeated = materialise(groups.groupBy(*key).count().where("count > 1").drop("count"), "repeated")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_kept_id")) & (F.col("_own_digest") == F.col("_kept_digest"))
    kept = docs.withColumn("_own_digest", F.sha2(normalised(F.col(text_col)), 256))
    kept = kept.join(chosen, same).drop("_kept_id", "_kept_digest")
    if not repeated.isEmpty():  # rows with the id and the text of a kept row
        again = kept.join(repeated, same, "left_semi").dropDuplicates(["_own_digest"])
        kept = kept.join(repeated, same, "left_anti").unionByName(again)
    return kept.select(docs.columns)
