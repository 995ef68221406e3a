"""Best-fit packing of documents into fixed-length sequences, with conflicts.

A document is cut into pieces of at most ``capacity`` words. Pieces are dealt by a hash to
shards of about ``SHARD`` pieces, whatever their source; a shard is packed by itself, longest
piece first. Its bins stand in the order of their residual space. Each carries a bitmap of
the sources and one of the duplicate clusters it holds; a piece goes into the tightest bin
that has room and neither its source nor its cluster. The search starts at the smallest
residual that fits and goes on to the next larger one, without a limit, until such a bin is
found, or else opens a new one. So a source of a third of all rows is spread over as many
bins as it has pieces, and copies never share a sequence.

Defined results: a document without words is a piece of length 0 in no bin (null). A null
source is a source of its own, a null cluster conflicts with none. Repeated rows are pieces
of their own. Equal lengths are taken in the order of id and piece, equal residuals in the
order in which bins were opened. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.llm.exactdedup import normalised

CAPACITY = 2048
SHARD = 1 << 13
WORD = r"[^\x20\x09-\x0D]+"

PACKED_SCHEMA = (
    "doc_id long, piece int, first_word long, n_words long, shard long, bin int, position int, bin_words long"
)


_PACKED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("first_word", pa.int64()),
        ("n_words", pa.int64()),
        ("shard", pa.int64()),
        ("bin", pa.int32()),
        ("position", pa.int32()),
        ("bin_words", pa.int64()),
    ]
)


def word_count(text: Column) -> Column:
    """Words between blanks; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once, 0 for the others and null: they conflict with none."""
    counts = Counter(value for value in values if value is not None)
    bit = {value: 1 << i for i, value in enumerate(v for v, n in counts.items() if n > 1)}
    return [bit.get(value, 0) for value in values]


def pack(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece, taken in the given order; the others are bitmaps of one bit or none."""
    by_residual: list[tuple[int, int]] = []  # (residual, bin), in order
    held: list[list[int]] = []  # per bin its bitmaps of sources and of clusters
    chosen = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        at = bisect_left(by_residual, (length, -1))
        while at < len(by_residual):
            own = held[by_residual[at][1]]
            if not (own[0] & source or own[1] & cluster):
                break
            at += 1
        if at < len(by_residual):
            residual, number = by_residual.pop(at)
        else:
            residual, number = capacity, len(held)
            held.append([0, 0])
        held[number][0] |= source
        held[number][1] |= cluster
        if residual > length:
            insort(by_residual, (residual - length, number))
        chosen.append(number)
    return chosen


def _pack_shard(table: pa.Table, capacity: int) -> pa.Table:
    rows = table.to_pylist()
    rows.sort(key=lambda r: (-r["n_words"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["row"]))
    lengths = [r["n_words"] for r in rows]
    bins = pack(lengths, _bits([r["source"] for r in rows]), _bits([r["cluster"] for r in rows]), capacity)
    filled: dict[int, int] = {}
    for row, number in zip(rows, bins, strict=True):
        row["bin"], row["position"] = number, filled.get(number, 0)
        filled[number] = row["position"] + row["n_words"]
    for row in rows:
        row["bin_words"] = filled[row["bin"]]
    return pa.Table.from_pylist([{name: row[name] for name in _PACKED.names} for row in rows], _PACKED)


def best_fit(docs: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD) -> DataFrame:
    """Where each piece of (doc_id, source, cluster, n_words) goes: shard, bin, position in it and its filling."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n_words") / F.lit(capacity)).cast("int"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("source"),
        "cluster",
        "n_words",
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
    )
    first = F.col("piece").cast("long") * capacity
    rows = rows.withColumns({"first_word": first, "n_words": F.least(F.col("n_words") - first, F.lit(capacity).cast("long"))})
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    filled = rows.where("n_words > 0")
    shards = max(1, -(-filled.count() // shard_size))
    filled = filled.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    packed = filled.groupBy("shard").applyInArrow(lambda shard: _pack_shard(shard, capacity), PACKED_SCHEMA)
    nowhere = [F.lit(None).cast(kind).alias(name) for name, kind in (("shard", "long"), ("bin", "int"), ("position", "int"))]
    empty = rows.where("n_words = 0").select("doc_id", "piece", "first_word", "n_words", *nowhere, F.lit(0).cast("long").alias("bin_words"))
    return packed.unionByName(empty)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD) -> DataFrame:
    """Pack (doc_id, text, source); documents are of one cluster if their texts are equal but for case and blanks."""
    text = normalised(F.col("text"))
    rows = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        F.md5(F.lower(F.trim(text))).alias("cluster"), word_count(F.col("text")).alias("n_words"),
    )
    return best_fit(rows, capacity, shard_size)
