"""Words, shingles and hashes of whole Arrow string columns, without a loop per word.

A column is cut at bytes, not at code points: every separator used here is ASCII, so
UTF-8 sequences are never split. Work is done in pieces of about two megabytes, so
that the memory of a task does not follow its batch; a longer text is a piece alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)  # multipliers of the hashes; any odd numbers would do
_STEP = np.uint64(0xD6E8FEB86659FD93)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def gives_back(function: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that returns freed memory to the system in the end.

    Workers are used again by later stages, and what one of them once needed would stay with it.
    """

    @wraps(function)
    def run(*args, **kwargs):
        try:
            yield from function(*args, **kwargs)
        finally:
            pa.default_memory_pool().release_unused()
            if _TRIM:
                _TRIM(0)

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(32))
    h = h * _STEP
    h = h ^ (h >> np.uint64(29))
    h = h * _ODD
    return h ^ (h >> np.uint64(32))


def byte_table(is_separator) -> np.ndarray:
    """0 for separators, else 1 + the byte, with A-Z as a-z."""
    table = np.zeros(256, np.uint16)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        table[b] = 0 if is_separator(low) else low + 1
    return table


# Letters and digits of ASCII and everything beyond it: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
ALNUM = byte_table(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
# Everything but blanks: [^\x20\x09-\x0D].
NONBLANK = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
# Letters of ASCII and everything beyond it.
LETTERS = byte_table(lambda b: b < 0x61 or 0x7B <= b <= 0x7F)


def string_array(column) -> pa.Array:
    """A column of a batch as one string array in which null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, and where each text begins, with the end."""
    _, ends, data = array.buffers()
    offsets = np.frombuffer(ends, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(array: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string array of about ``size`` bytes, each with its first row."""
    if not len(array):
        return
    _, offsets = raw(array)
    low = 0
    while low < len(array):
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), len(array))
        yield low, array.slice(low, high - low)
        low = high


@dataclass
class Words:
    """The words of some texts: those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray  # first byte of each word in ``data``
    ends: np.ndarray
    data: np.ndarray


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _ODD, np.uint64))


def split_words(array: pa.Array, table: np.ndarray) -> Words:
    """Maximal runs of bytes that ``table`` maps to non-zero; equal hashes mean equal mapped words."""
    data, offsets = raw(array)
    mapped = table[data]
    inside = mapped > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a word does not run from one text into the next
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), bounds, starts, ends, data)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    products = mapped[inside].astype(np.uint64) * _powers(int(lengths.max()))[within]
    hashes = mix(np.add.reduceat(products, before) + lengths.astype(np.uint64) * _STEP)
    return Words(hashes, bounds, starts, ends, data)


def shingles(words: Words, k: int = 5) -> list[np.ndarray]:
    """For each text its set of hashed ``k``-word shingles, sorted; a shorter text is one shingle."""
    n = len(words.hashes)
    counts = np.diff(words.bounds)
    if not n:
        return [np.zeros(0, np.uint64)] * len(counts)
    left = np.repeat(words.bounds[1:], counts) - np.arange(n)  # words from here to the end of the text
    weights = _powers(k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        shifted = np.zeros(n, np.uint64)
        shifted[: n - j] = words.hashes[j:]
        total += np.where(left > j, shifted, np.uint64(0)) * weights[j]
    hashed = mix(total + np.minimum(left, k).astype(np.uint64) * weights[k])
    sets = []
    for low, high in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        own = np.sort(hashed[low : max(high - k + 1, low + 1)]) if high > low else hashed[:0]
        sets.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return sets


def encode_varints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, seven bits a byte, the last byte of each below 128."""
    values = values.astype(np.uint64)
    sizes = 1 + sum((values >= np.uint64(1 << (7 * k))).astype(np.int64) for k in range(1, 5))
    out = np.zeros(int(sizes.sum()), np.uint8)
    at = np.cumsum(sizes) - sizes
    for k in range(5):
        has = sizes > k
        if not has.any():
            break
        low = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[has] + k] = low.astype(np.uint8) | np.where(sizes[has] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def decode_varints(blob: bytes) -> np.ndarray:
    bytes_ = np.frombuffer(blob, np.uint8)
    if not len(bytes_):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(bytes_ < 128)
    starts = np.append(0, ends[:-1] + 1)
    within = np.arange(len(bytes_)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((bytes_ & 127).astype(np.int64) << (7 * within), starts)
