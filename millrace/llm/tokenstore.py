"""Token ids in Parquet list columns that can be read in part.

Rows are sorted by document over all files. Token ids are a list column in dictionary pages
(a vocabulary of 50,000 ids fits a dictionary page, 16 bits an id; ``encoding="delta"``
writes delta-packed pages instead), in row groups and pages of controlled size, whose
minima and maxima the page indexes hold. So a reader that asks for some documents skips row
groups and pages, and one that asks for metadata doesn't touch the tokens.

Files are Spark's own, so they are committed with their tasks. A document's place in the
stream of all ids, ``start``, follows from the files' order: the ids of the files before,
and those of the rows before it in its file.

Encoding runs in the tasks. Byte-level BPE never merges over the start of a word, so each
distinct word of a batch is encoded once, and remembered; the cuts are only made where the
tokenizer's own splitting into words surely cuts, too. A text with a special token is encoded
whole.

Defined results: null and empty texts have only the end id. Null ids come first in the
order, repeated ids in the order of the input. An empty table gives empty files and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.lineage import scratch_path
from millrace.llm.text import pieces, raw, string_array

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2048
REMEMBERED = 3 << 18  # distinct words that a worker keeps
JOINED = 512  # words that are encoded as one text
BATCH_BYTES = 4 << 20  # text that is encoded at once: the distinct words of more text are relatively fewer

TOKEN_SCHEMA = "doc_id long, n_tokens long, tokens array<int>"
_TOKENS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])


# Words whose tokens are the same wherever a word or a line ends before them and another begins after them.
_PLAIN = re.compile(r" ?\S(?:[^\n]*\S)?")
# Most of them are known by their bytes: visible ASCII or a Latin letter at both ends, and no line end.
_PLAIN_BYTES = re.compile(
    rb" ?(?:[\x21-\x7E]|[\xC3-\xC9][\x80-\xBF])(?:[^\n]*(?:[\x21-\x7E]|[\xC3-\xC9][\x80-\xBF]))?"
)


class WordEncoder:
    """Encodes texts word by word, with the result of the tokenizer for the whole text.

    A text is cut before a blank that is followed by a visible ASCII character or a Latin
    letter, and around a line end between two such characters: there a word of the
    tokenizer ends in any case.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # byte-level tokens have a letter for each byte
        self._forget()
        visible = np.zeros(256, bool)
        visible[0x21:0x7F] = True
        self.visible = visible.copy()
        visible[0xC3:0xCA] = True  # first bytes of Latin letters, none of them a blank
        self.begins = visible

    def _cuts(self, data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Places at which words begin; the texts' own beginnings are among them."""
        n = len(data)
        begins, line = self.begins[data], data == 0x0A
        cut = np.zeros(n + 1, bool)
        cut[: n - 1] = (data[:-1] == 0x20) & begins[1:]  # before the blank of a word
        alone = np.zeros(n, bool)
        alone[1:-1] = line[1:-1] & self.visible[data[:-2]] & begins[2:]
        cut[:n] |= alone
        cut[1:] |= alone
        for i in np.flatnonzero(whole):
            cut[offsets[i] : offsets[i + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut)

    def _learn(self, words: list[bytes], special: bool) -> np.ndarray:
        """Encode words that aren't known yet, and number them; plain ones as one text, which the ids' lengths take apart."""
        surely = _PLAIN_BYTES.fullmatch
        plain = [surely(word) is not None or _PLAIN.fullmatch(word.decode()) is not None for word in words]
        if special:
            marks = [s.encode() for s in self.special]
            plain = [ok and not any(s in word for s in marks) for ok, word in zip(plain, words, strict=True)]
        joined = [i for i, ok in enumerate(plain) if ok]
        lined = [words[i] if words[i][0] == 0x20 else b"\n" + words[i] for i in joined]
        groups = [b"".join(lined[low : low + JOINED]).decode() for low in range(0, len(lined), JOINED)]
        lengths = np.fromiter(map(len, lined), np.int64, len(lined))  # in bytes, with the line ends put before
        line = np.fromiter((word[0] == 0x0A for word in lined), bool, len(lined))
        for n, encoding in enumerate(self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)):
            own = slice(n * JOINED, (n + 1) * JOINED)
            ids = np.array(encoding.ids, np.int32)
            bounds = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lengths[own]), "left") + 1
            firsts = np.append(0, bounds[:-1])
            self._keep(np.delete(ids, firsts[line[own]]), bounds - firsts - line[own])
        others = [i for i, ok in enumerate(plain) if not ok]
        for encoding in self.tokenizer.encode_batch_fast([words[i].decode() for i in others], add_special_tokens=False):
            self._keep(np.array(encoding.ids, np.int32), np.array([len(encoding.ids)]))
        order = joined + others
        numbers = np.empty(len(words), np.int64)
        numbers[order] = np.arange(len(self.known), len(self.known) + len(words))
        self.known.update(zip(words, numbers.tolist(), strict=True))
        return numbers

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids.append(ids)
        self.sizes.append(sizes)

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # numbers in the order of ids and sizes
        self.ids: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.sizes: list[np.ndarray] = [np.zeros(0, np.int64)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the bounds of each text's."""
        data, offsets = raw(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        whole = np.zeros(len(texts), bool)  # with special tokens, which the tokenizer looks for first
        for content in self.special:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        cuts = self._cuts(data, offsets, whole)
        words = pa.Array.from_buffers(
            pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        numbers = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn([distinct[i] for i in new], bool(whole.any()))
            self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        sizes = self.sizes[0].astype(np.int32)
        firsts = np.cumsum(sizes, dtype=np.int32) - sizes
        codes = numbers[coded.indices.to_numpy()]
        lengths = sizes[codes]
        ends = np.cumsum(lengths, dtype=np.int32)
        places = np.arange(int(ends[-1]), dtype=np.int32) + np.repeat(firsts[codes] - ends + lengths, lengths)
        return self.ids[0][places], np.append(0, ends)[np.searchsorted(cuts, offsets)]


_encoders: dict[str, WordEncoder] = {}  # of this worker


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = WordEncoder(tokenizer)
    encoder = _encoders[tokenizer]
    for batch in batches:
        for low, piece in pieces(string_array(batch.column(1)), BATCH_BYTES):
            ids, bounds = encoder.encode(piece)
            out = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(out))
            rows = [batch.column(0).slice(low, len(piece)), pa.array(np.diff(bounds)), lists]
            yield pa.RecordBatch.from_arrays(rows, schema=_TOKENS)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, encoding: str = "dictionary",
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode the texts and write (doc_id, n_tokens, tokens) to ``path``, sorted by document."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"no such encoding: {encoding}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_turn", F.monotonically_increasing_id())  # parts rows of one id, too
    rows = rows.repartitionByRange("doc_id", "_turn").sortWithinPartitions("doc_id", "_turn").drop("_turn")
    encoded = rows.mapInArrow(partial(_encode, tokenizer=tokenizer, end_id=end_id), TOKEN_SCHEMA)
    (
        encoded.write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.enable.dictionary", "true" if encoding == "dictionary" else "false")
        .option("parquet.writer.version", "v2")
        .option("compression", "zstd")
        .parquet(path)
    )


def _with_starts(rows: DataFrame, path: str) -> DataFrame:
    """Add to rows of (file, place, n_tokens) how many ids stand before each."""
    spark = rows.sparkSession
    counts = spark.read.schema(TOKEN_SCHEMA).parquet(path).select("n_tokens", F.col("_metadata.file_name").alias("file"))
    files = counts.groupBy("file").agg(F.sum("n_tokens").alias("ids"))  # one row per file; names ascend with the ranges
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")).alias("before"))
    own = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(own), F.lit(0).cast("long"))
    rows = rows.withColumn("within", within).join(files, "file")
    return rows.withColumn("start", F.col("before") + F.col("within")).drop("before", "within")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, doc_id, n_tokens, start): no token is read."""
    rows = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    place = F.col("_metadata.row_index").alias("place")
    return _with_starts(rows.select(F.col("_metadata.file_name").alias("file"), place, "doc_id", "n_tokens"), path)


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(file, place, doc_id, tokens), of the documents in [low, high] alone if given: others' pages aren't read."""
    rows = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"), "doc_id", "tokens")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy().astype("<u4", copy=False)
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        found = {"n_tokens": pa.array(np.diff(offsets).astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())}
        yield pa.RecordBatch.from_pydict({c: batch.column(i) for i, c in enumerate(("file", "place", "doc_id"))} | found)


def checksums(tokens: DataFrame) -> DataFrame:
    """(file, place, doc_id, n_tokens, ids_crc32) of what ``read_tokens`` gives: the CRC-32 of the ids as little-endian 32-bit numbers."""
    return tokens.mapInArrow(_crc, "file string, place long, doc_id long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return _with_starts(checksums(read_tokens(spark, path)), path).select("doc_id", "start", "n_tokens", "ids_crc32")
