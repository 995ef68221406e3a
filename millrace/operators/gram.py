"""Products of all pairs of many columns, as blocks of a Gram matrix.

The columns are cut into blocks of ``BLOCK``. A task reads its rows as one matrix and adds,
for each pair of blocks, dense sums over its rows: how many of them have both values, and the
sums of values, squares and products over these. What leaves a task is one row per pair of
blocks, whatever the number of rows; one shuffle of these blocks adds them up.

Sums are taken about a value of each column, the first there is among ``HEAD`` rows, so that
columns far from zero lose no digits. A task holds the blocks of the upper triangle: 44 bytes times half the square of the number of
columns (46 MB at 1,441 columns).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128
CHUNK = 2048  # rows of a matrix
HEAD = 10_000  # rows among which each column's shift is sought

BLOCK_SCHEMA = "a int, b int, sums binary"
CORR_SCHEMA = "i int, j int, corr double"
KINDS = 7  # rows with both, sums of x, y, xx, yy, xy, and rows with both of which one isn't finite


def _chunk(batch: pa.RecordBatch, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values about the shift (0 where there is none), which are there, and which of these aren't finite."""
    there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    odd = there & ~np.isfinite(x)
    return np.where(there & ~odd, x - shift, 0.0), there.astype(float), odd.astype(float)


def _sums(batches: Iterator[pa.RecordBatch], shift: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    n = len(shift)
    edges = [(low, min(low + block, n)) for low in range(0, n, block)]
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for low in range(0, batch.num_rows, CHUNK):
            x, there, odd = _chunk(batch.slice(low, CHUNK), shift)
            square, any_odd = x * x, odd.any()
            for a, (a0, a1) in enumerate(edges):
                for b in range(a, len(edges)):
                    b0, b1 = edges[b]
                    xa, xb, ma, mb = x[:, a0:a1].T, x[:, b0:b1], there[:, a0:a1].T, there[:, b0:b1]
                    add = np.zeros((KINDS, a1 - a0, b1 - b0))
                    add[0], add[1], add[2] = ma @ mb, xa @ mb, ma @ xb
                    add[3], add[4], add[5] = square[:, a0:a1].T @ mb, ma @ square[:, b0:b1], xa @ xb
                    if any_odd:
                        add[6] = odd[:, a0:a1].T @ mb + ma @ odd[:, b0:b1]
                    total[a, b] = total[a, b] + add if (a, b) in total else add
    for (a, b), sums in total.items():
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b, "sums": sums.tobytes()}], _ARROW)


_ARROW = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("sums", pa.binary())])


def gram_blocks(df: DataFrame, cols: list[str], block: int = BLOCK) -> DataFrame:
    """(a, b, sums): per pair of column blocks the dense sums over all rows, seven numbers for a pair of columns."""
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    finite = [F.when(F.abs(c) < float("inf"), F.col(c)) for c in values.columns]  # NaN is greater
    first = values.limit(HEAD).agg(*[F.first(c, ignorenulls=True) for c in finite]).first()
    shift = np.array([0.0 if v is None else v for v in first])

    def add(table: pa.Table) -> pa.Table:
        total = 0.0
        for sums in table["sums"]:
            total = total + np.frombuffer(sums.as_buffer())
        key = {c: table[c][0].as_py() for c in ("a", "b")}
        return pa.Table.from_pylist([key | {"sums": total.tobytes()}], _ARROW)

    parts = values.mapInArrow(partial(_sums, shift=shift, block=block), BLOCK_SCHEMA)
    return parts.groupBy("a", "b").applyInArrow(add, BLOCK_SCHEMA)


def _pairs(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, sums in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            s = np.frombuffer(sums)
            high = _height(len(s) // KINDS, block, a == b)
            n, x, y, xx, yy, xy, odd = s.reshape(KINDS, high, -1)
            many = np.maximum(n, 1.0)
            vx, vy, c = xx - x * x / many, yy - y * y / many, xy - x * y / many
            # What is left of a sum of squares by rounding alone is no variance.
            flat = (vx <= 1e-13 * xx) | (vy <= 1e-13 * yy) | (n < 2)
            corr = np.where(flat, np.nan, c / np.sqrt(np.where(flat, 1.0, vx * vy)))
            i, j = np.meshgrid(np.arange(high) + a * block, np.arange(n.shape[1]) + b * block, indexing="ij")
            kept = i <= j
            i, j, corr, flat, odd = i[kept], j[kept], corr[kept], flat[kept], odd[kept] > 0
            value = pa.array(corr, mask=flat & ~odd)
            if odd.any():
                value = pa.array(np.where(odd, np.nan, corr), mask=flat & ~odd)
            out = [np.concatenate([i, j[i != j]]), np.concatenate([j, i[i != j]])]
            both = pa.concat_arrays([value, value.filter(pa.array(i != j))])
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in out), both], names=["i", "j", "corr"])


def _height(cells: int, block: int, diagonal: bool) -> int:
    """Rows of a block: all blocks but those of the last columns are full, and the latter stand on the diagonal or to the right."""
    return int(np.sqrt(cells)) if diagonal else block


def correlations(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """(i, j, corr) of all pairs of columns, both ways."""
    return blocks.mapInArrow(partial(_pairs, block=block), CORR_SCHEMA)
