"""Exact maximum inner products: the best items of every user, without meeting all items.

Items stand in blocks by falling length of their vectors, users in batches. A round scores
the users that are still open against the next block. By the Cauchy-Schwarz inequality no
item from there on can score more than the user's length times that of the block's first
item, so a user whose k-th score exceeds this bound is done. Users that are done leave their
batch, batches without users are not read again, and the rounds end with the last of them.

Blocks are rows of a written table that double from ``FIRST`` to ``MOST`` items, so what a
round sends to all tasks is at most ``MOST`` vectors. The open users are written after each
round; a lost executor costs at most a round.

Within a block, items stand in cells of up to ``CELL`` near ones, with a centre and a radius. A
user's products in a cell are at most that with its centre and the user's length times the
radius, so a user meets a block by its cells' bounds, and only cells that may hold one of the
best ``k`` are multiplied. ``n_pairs`` counts users by items of the blocks they met, whether
a pair was multiplied or bounded.

Products are summed in the order of the elements, so scores do not depend on blocks, cells and
batches; a faster matrix product only chooses what is summed. Ties go to the smaller item. A
null vector, or one with a null, NaN or infinite element, is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise, scratch_path
from millrace.operators.ordered import number_rows

FIRST = 1024
MOST = 1 << 16
BATCH = 4096
CELL = 128
FOUND = 1 << 20  # chosen products that are held before they are summed
SLACK = 1e-9  # of the lengths' product: how far a matrix product may be off

_BLOCK_SCHEMA = "block int, top double, n int, items binary, vectors binary, cells binary"
_STATE_SCHEMA = (
    "block int, open boolean, users binary, vectors binary, items binary, scores binary, n_open long, n_pairs long"
)
_STATE_ARROW = pa.schema(
    [
        ("block", pa.int32()), ("open", pa.bool_()), ("users", pa.binary()), ("vectors", pa.binary()),
        ("items", pa.binary()), ("scores", pa.binary()), ("n_open", pa.int64()), ("n_pairs", pa.int64()),
    ]
)


def _vectors(factors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows whose vectors are finite, as doubles."""
    rows = factors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))


def near_cells(v: np.ndarray, size: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """An order of the vectors in which near ones are neighbours, and the first place of each cell of up to ``size``.

    A part that is too large is halved across the direction in which it is widest.
    """
    v = v / max(np.abs(v).max(initial=0.0), np.finfo(float).tiny)  # no square overflows
    parts, cells = [np.arange(len(v))], []
    while parts:
        part = parts.pop()
        if len(part) <= size:
            cells.append(part)
            continue
        off = v[part] - v[part].mean(0)
        along = off @ np.linalg.eigh(off.T @ off)[1][:, -1]
        halved, half = np.argsort(along, kind="stable"), len(part) // 2
        parts += [part[halved[half:]], part[halved[:half]]]
    starts = np.cumsum([0] + [len(c) for c in cells[:-1]])
    return np.concatenate(cells), starts.astype(np.int64)


def item_blocks(factors: DataFrame, key: str, vector: str, first: int = FIRST, most: int = MOST) -> DataFrame:
    """The written blocks, by falling length: number, greatest length, and the items by cells."""
    rows = _vectors(factors, key, vector)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    numbered = number_rows(rows.withColumn("length", length), [F.desc("length"), F.asc("id")], "row")
    at, doublings = F.col("row") - 1, (most // first).bit_length() - 1
    doubled = first * ((1 << doublings) - 1)  # items before the blocks of the full size
    small = F.length(F.bin(F.floor(at / first) + 1)) - 1
    block = F.when(at < doubled, small).otherwise(doublings + F.floor((at - doubled) / most))

    def pack(table: pa.Table) -> pa.Table:
        lengths, ids = table["length"].to_numpy(), table["id"].to_numpy()
        order = np.lexsort((ids, -lengths))
        v = np.array(table["v"].combine_chunks().flatten(), float).reshape(len(ids), -1)[order]
        number = table["block"][0].as_py()
        near, cells = near_cells(v, CELL if number else FIRST)  # no scores yet to leave out cells of the first
        row = {
            "block": number, "top": lengths.max(), "n": len(ids),
            "items": ids[order][near].tobytes(), "vectors": v[near].tobytes(), "cells": cells.tobytes(),
        }
        kinds = [pa.int32(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.Table.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))

    numbered = numbered.select(block.cast("int").alias("block"), "length", "id", "v")
    return materialise(numbered.groupBy("block").applyInArrow(pack, _BLOCK_SCHEMA), "blocks")


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            part = batch.slice(low, size)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            v = np.array(part.column(1).flatten(), float)
            row = {
                "block": 0, "open": True, "users": ids.tobytes(), "vectors": v.tobytes(), "items": b"", "scores": b"",
                "n_open": len(ids), "n_pairs": 0,
            }
            yield pa.RecordBatch.from_pylist([row], _STATE_ARROW)


def _merged(
    best: np.ndarray, scores: np.ndarray, user: np.ndarray, items: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The best of what each user has and of further products (user, item, value)."""
    n, k = best.shape
    at = np.concatenate([np.repeat(np.arange(n), k), user])
    ids = np.concatenate([best.ravel(), items])
    value = np.concatenate([scores.ravel(), values])
    order = np.lexsort((ids, -value, at))
    at, ids, value = at[order], ids[order], value[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    kept = rank < k
    return ids[kept].reshape(-1, k), value[kept].reshape(-1, k)


def best_of(
    v: np.ndarray, items: np.ndarray, w: np.ndarray, cells: np.ndarray, best: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """The best ``k`` of what each user has (-1 and -inf where there is none) and a block of items.

    Also the number of products that the bounds of the ``cells`` left over.
    """
    ends = np.append(cells[1:], len(items))
    centres = np.add.reduceat(w, cells) / (ends - cells)[:, None]
    away = w - np.repeat(centres, ends - cells, axis=0)
    radii = np.sqrt(np.maximum.reduceat((away * away).sum(1), cells))
    lengths = np.sqrt((v * v).sum(1))
    slack = SLACK * lengths * np.sqrt(w.shape[1]) * np.abs(w).max()
    least = scores[:, -1].copy()
    bounds = v @ centres.T + lengths[:, None] * radii + 3 * slack[:, None]
    found, n_found, n_products = [], 0, 0
    for cell, (low, high) in enumerate(zip(cells, ends, strict=True)):
        at = np.flatnonzero(~(bounds[:, cell] < least))  # a NaN bounds nothing
        if not len(at):
            continue
        near = v[at] @ w[low:high].T
        n_products += near.size
        chosen = near >= (least[at] - 2 * slack[at])[:, None]
        if high - low >= k and np.count_nonzero(chosen) > 2 * k * len(at):
            least[at] = np.maximum(least[at], np.partition(near, high - low - k, axis=1)[:, high - low - k])
            chosen = near >= (least[at] - 2 * slack[at])[:, None]
        user, item = np.nonzero(chosen)
        if not len(user):
            continue
        user, item = at[user], item + low
        exact = np.zeros(len(user))
        for f in range(v.shape[1]):
            exact += v[user, f] * w[item, f]
        found.append((user, items[item], exact))
        n_found += len(user)
        if n_found > FOUND:
            best, scores = _merged(best, scores, *map(np.concatenate, zip(*found, strict=True)))
            least = np.maximum(least, scores[:, -1])
            found, n_found = [], 0
    if found:
        best, scores = _merged(best, scores, *map(np.concatenate, zip(*found, strict=True)))
    return best, scores, n_products


def _round(batches: Iterator[pa.RecordBatch], k: int, following: float | None) -> Iterator[pa.RecordBatch]:
    """One block for each batch of users; ``following`` is the length of the first item behind it, if there is one."""
    for batch in batches:
        for row in batch.to_pylist():
            users, items = np.frombuffer(row["users"], np.int64), np.frombuffer(row["block_items"], np.int64)
            v = np.frombuffer(row["vectors"]).reshape(len(users), -1)
            w = np.frombuffer(row["block_vectors"]).reshape(len(items), -1)
            cells = np.frombuffer(row["block_cells"], np.int64)
            best = np.frombuffer(row["items"], np.int64).reshape(-1, k) if row["items"] else np.full((len(users), k), -1)
            scores = np.frombuffer(row["scores"]).reshape(-1, k) if row["scores"] else np.full((len(users), k), -np.inf)
            best, scores, _ = best_of(v, items, w, cells, best, scores, k)
            if following is None:
                left = np.zeros(len(users), bool)
            else:
                bound = np.sqrt((v * v).sum(1)) * following * (1 + SLACK)
                left = scores[:, -1] <= bound
            for is_open, chosen in ((False, ~left), (True, left)):
                if chosen.any() or not is_open:
                    out = {
                        "block": row["block"] + 1, "open": is_open, "users": users[chosen].tobytes(),
                        "vectors": v[chosen].tobytes() if is_open else b"", "items": best[chosen].tobytes(),
                        "scores": scores[chosen].tobytes(), "n_open": len(users) if not is_open else 0,
                        "n_pairs": len(users) * len(items) if not is_open else 0,
                    }
                    yield pa.RecordBatch.from_pylist([out], _STATE_ARROW)


def _unpack(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for users, items, scores in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            users = np.repeat(np.frombuffer(users, np.int64), k)
            items, scores = np.frombuffer(items, np.int64), np.frombuffer(scores)
            position = np.arange(len(users), dtype=np.int32) % k
            has = scores > -np.inf
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[has]) for c in (users, position, items, scores)], names=["user", "position", "item", "score"]
            )


def top_inner_products(
    users: DataFrame,
    items: DataFrame,
    k: int,
    key: str = "id",
    vector: str = "features",
    first: int = FIRST,
    most: int = MOST,
    batch: int = BATCH,
) -> tuple[DataFrame, DataFrame]:
    """(user, position, item, score) of the ``k`` greatest products of each user, and the work that took.

    The work is (block, n_items, n_users, n_pairs) for each block that was read.
    """
    spark = users.sparkSession
    blocks = item_blocks(items, key, vector, first, most)
    tops = {r.block: r.top for r in blocks.select("block", "top").toLocalIterator()}  # two numbers for a block
    folder = scratch_path(spark, "best")
    state = materialise(_vectors(users, key, vector).mapInArrow(partial(_batches, size=batch), _STATE_SCHEMA), "users")
    number = 0
    while number < len(tops) and not state.isEmpty():
        # One row of at most ``most`` vectors.
        block = F.broadcast(
            blocks.where(F.col("block") == number).select(
                F.col("block").alias("block_number"),
                F.col("items").alias("block_items"),
                F.col("vectors").alias("block_vectors"),
                F.col("cells").alias("block_cells"),
            )
        )
        met = state.join(block, F.col("block") == F.col("block_number")).drop("block_number")
        done = met.mapInArrow(partial(_round, k=k, following=tops.get(number + 1)), _STATE_SCHEMA)
        path = f"{folder}/{number}"
        done.write.partitionBy("open").parquet(path)
        number += 1
        state = spark.read.schema(_STATE_SCHEMA).parquet(path).where("open")
    paths = [f"{folder}/{n}/open=false" for n in range(number)]
    found = spark.read.schema(_STATE_SCHEMA).parquet(*paths) if paths else state.where("NOT open")
    best = found.select("users", "items", "scores").mapInArrow(
        partial(_unpack, k=k), "user long, position int, item long, score double"
    )
    read = found.groupBy((F.col("block") - 1).alias("block"))
    work = read.agg(F.sum("n_open").alias("n_users"), F.sum("n_pairs").alias("n_pairs"))
    sizes = blocks.select("block", F.col("n").cast("long").alias("n_items"))
    return best, work.join(sizes, "block").select("block", "n_items", "n_users", "n_pairs")
