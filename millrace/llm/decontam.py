"""Benchmark decontamination over a positional inverted index.

``build_index`` stores the postings of every word of every document. The index is cut
into segments, each one row: a task's documents up to ``SEGMENT_WORDS`` words, with the
sorted terms (64-bit hashes), how often each occurs, and their positions as delta
varints. The words of a segment are numbered on, with a free place after each document,
so that no phrase reaches over its end. Nothing is shuffled, and a frequent term is as
many short lists as there are segments.

``find_phrases`` takes the test phrases in blocks of bounded size. In each segment a
phrase that lacks a term is dropped at once; of the others the lists are intersected
from the rarest term on, each shifted by the term's offset in the phrase, until no start
is left. With ``slop`` the terms may stand in any order within that many further places.

Defined results: a null or empty text has no words and no hits; repeated rows are
documents of their own, told apart by (segment, ordinal). An empty table gives an empty
result. Repeated item ids count once; an item whose id is null marks words, but isn't listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.llm.text import ALNUM, decode_varints, encode_varints, gives_back, pieces, split_words, string_array

SEGMENT_WORDS = 1 << 19
TEXT_BYTES = 1 << 19  # of text whose words are held at once
BLOCK_WORDS = 1 << 18  # words of the test phrases that one block holds, about

INDEX_SCHEMA = (
    "segment long, doc_ids array<bigint>, lengths array<int>, terms binary, counts binary, postings binary"
)
MATCH_SCHEMA = "segment long, ordinal int, doc_id long, item_id long, spans array<struct<start:int,end:int>>"
PHRASE_SCHEMA = "item_id long, window int, terms array<bigint>"


def _segment(number: int, ids: list, lengths: list[int], words: list[np.ndarray]) -> dict:
    hashes = np.concatenate(words) if words else np.zeros(0, np.uint64)
    sizes = np.array(lengths, np.int64)
    places = np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, places = hashes[order], places[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    deltas = np.diff(places, prepend=0)
    deltas[starts] = places[starts]
    return {
        "segment": number,
        "doc_ids": ids,
        "lengths": lengths,
        "terms": hashes[starts].tobytes(),
        "counts": np.diff(np.append(starts, len(hashes))).astype(np.uint32).tobytes(),
        "postings": encode_varints(deltas),
    }


_INDEX_ARROW = pa.schema(
    [
        ("segment", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("terms", pa.binary()),
        ("counts", pa.binary()),
        ("postings", pa.binary()),
    ]
)


@gives_back
def _index(batches: Iterator[pa.RecordBatch], segment_words: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids, lengths, words, held = [], [], [], 0
    for batch in batches:
        texts, doc_ids = string_array(batch.column(1)), batch.column(0).to_pylist()
        for low, piece in pieces(texts, TEXT_BYTES):
            found = split_words(piece, ALNUM)
            for i in range(len(piece)):
                own = found.hashes[found.bounds[i] : found.bounds[i + 1]]
                if held and held + len(own) > segment_words:
                    yield pa.RecordBatch.from_pylist([_segment(number, ids, lengths, words)], _INDEX_ARROW)
                    number += 1
                    ids, lengths, words, held = [], [], [], 0
                ids.append(doc_ids[low + i])
                lengths.append(len(own))
                words.append(own)
                held += len(own) + 1  # a row counts, too: empty texts must not pile up
    if ids:
        yield pa.RecordBatch.from_pylist([_segment(number, ids, lengths, words)], _INDEX_ARROW)


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS
) -> DataFrame:
    """The written index of all words of all documents, a row for each segment."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return materialise(rows.mapInArrow(partial(_index, segment_words=segment_words), INDEX_SCHEMA), "index")


@gives_back
def _phrases(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for low, piece in pieces(string_array(batch.column(1)), TEXT_BYTES):
            found = split_words(piece, ALNUM)
            rows = []
            for i in range(len(piece)):
                own = found.hashes[found.bounds[i] : found.bounds[i + 1]].view(np.int64)
                for at in range(max(len(own) - n + 1, min(len(own), 1))):
                    rows.append({"item_id": ids[low + i], "window": at, "terms": own[at : at + n].tolist()})
            if rows:
                schema = pa.schema([("item_id", pa.int64()), ("window", pa.int32()), ("terms", pa.list_(pa.int64()))])
                yield pa.RecordBatch.from_pylist(rows, schema)


def phrases_of(items: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All windows of ``n`` words of the items; one of fewer words, but not none, is one window."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(partial(_phrases, n=n), PHRASE_SCHEMA)


def _exact(lists: list[np.ndarray]) -> np.ndarray:
    """Starts at which the word ``k`` of the phrase stands ``k`` places on, from the rarest word."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[order[0]] - order[0]
    for k in order[1:]:
        at = np.searchsorted(lists[k], starts + k)
        inside = at < len(lists[k])
        starts = starts[inside][lists[k][at[inside]] == starts[inside] + k]
        if not len(starts):
            break
    return starts


def _near(lists: list[np.ndarray], terms: list[int], reach: int) -> np.ndarray:
    """Starts of stretches of ``reach`` places that begin with a word of the phrase and hold all of them."""
    need: dict[int, int] = {}
    for term in terms:
        need[term] = need.get(term, 0) + 1
    own = {term: places for term, places in zip(terms, lists, strict=True)}
    rarest = min(own, key=lambda term: len(own[term]))
    around = np.unique((own[rarest][:, None] - np.arange(reach)[None, :]).ravel())
    starts = np.intersect1d(around, np.unique(np.concatenate(list(own.values()))))
    for term, times in sorted(need.items(), key=lambda item: len(own[item[0]])):
        low, high = np.searchsorted(own[term], starts), np.searchsorted(own[term], starts + reach)
        starts = starts[high - low >= times]
    return starts


BLOCK_SCHEMA = "block int, items binary, known binary, sizes binary, wanted binary"


def _pack(table: pa.Table) -> pa.Table:
    """The phrases of a block as one row: items (0 where null), which are known, phrase lengths and terms."""
    items = table["item_id"].combine_chunks()
    terms = table["terms"].combine_chunks()
    row = {
        "block": table["block"][0].as_py(),
        "items": items.fill_null(0).to_numpy().tobytes(),
        "known": items.is_valid().to_numpy(zero_copy_only=False).tobytes(),
        "sizes": terms.value_lengths().to_numpy().astype(np.int32).tobytes(),
        "wanted": terms.flatten().to_numpy().tobytes(),
    }
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.Table.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))


def _unpack(row: dict) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Items as one-element tuples, so that a null id stays a key of its own; terms, which each phrase has, their bounds."""
    items, known = np.frombuffer(row["items"], np.int64), np.frombuffer(row["known"], bool)
    sizes, flat = np.frombuffer(row["sizes"], np.int32), np.frombuffer(row["wanted"], np.uint64)
    wanted, numbers = np.unique(flat, return_inverse=True)
    names = [(int(i) if ok else None,) for i, ok in zip(items, known, strict=True)]
    return names, wanted, numbers, np.append(0, np.cumsum(sizes))


@gives_back
def _match(batches: Iterator[pa.RecordBatch], slop: int):
    block, unpacked = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            segment = batch.slice(i, 1).to_pylist()[0]
            if segment["block"] != block:  # all rows of a pass have the same one
                block, unpacked = segment["block"], _unpack(segment)
            rows = list(_match_segment(segment, *unpacked, slop))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _MATCH_ARROW)


_MATCH_ARROW = pa.schema(
    [
        ("segment", pa.int64()),
        ("ordinal", pa.int32()),
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def _match_segment(segment: dict, items: list, wanted: np.ndarray, numbers: np.ndarray, bounds: np.ndarray, slop: int):
    terms = np.frombuffer(segment["terms"], np.uint64)
    if not len(terms):
        return
    counts = np.frombuffer(segment["counts"], np.uint32).astype(np.int64)
    ends = np.cumsum(counts)
    starts = ends - counts
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    there = terms[at] == wanted
    summed = np.cumsum(decode_varints(segment["postings"]))
    base = np.append(0, summed)[starts]

    lists: dict[int, np.ndarray] = {}

    def places(number: int) -> np.ndarray:
        if number not in lists:
            term = at[number]
            lists[number] = summed[starts[term] : ends[term]] - base[term]
        return lists[number]

    lengths = np.array(segment["lengths"], np.int64)
    firsts = np.cumsum(lengths + 1) - (lengths + 1)  # the place of each document's first word
    found: dict[tuple[int, int], set[tuple[int, int]]] = {}
    whole = np.logical_and.reduceat(there[numbers], bounds[:-1]) if len(numbers) else np.zeros(0, bool)
    for k in np.flatnonzero(whole).tolist():  # phrases all of whose terms are there
        item, window = items[k], numbers[bounds[k] : bounds[k + 1]]
        own = [places(int(number)) for number in window]
        reach = len(window) + slop
        for start in _near(own, window.tolist(), reach) if slop else _exact(own):
            ordinal = int(np.searchsorted(firsts, start, "right")) - 1
            low = int(start - firsts[ordinal])
            if slop and not _holds(own, window.tolist(), int(start), int(firsts[ordinal] + lengths[ordinal]), reach):
                continue
            high = min(low + reach, int(lengths[ordinal]))
            found.setdefault((ordinal, item), set()).add((low, high))
    for (ordinal, item), spans in found.items():
        yield {
            "segment": segment["segment"],
            "ordinal": ordinal,
            "doc_id": segment["doc_ids"][ordinal],
            "item_id": item[0],
            "spans": [{"start": a, "end": b} for a, b in _joined(spans)],
        }


def _holds(lists: list[np.ndarray], terms: list[int], start: int, end: int, reach: int) -> bool:
    """Whether the stretch still has all words when it is cut at the end of its document."""
    end = min(end, start + reach)
    need: dict[int, int] = {}
    for term in terms:
        need[term] = need.get(term, 0) + 1
    own = {term: places for term, places in zip(terms, lists, strict=True)}
    return all(np.searchsorted(own[t], end) - np.searchsorted(own[t], start) >= n for t, n in need.items())


def _joined(spans: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of intervals as disjoint ones."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def find_phrases(index: DataFrame, phrases: DataFrame, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where the phrases occur: per segment, document and item the covered word spans.

    The phrases are written in blocks of about ``block_words`` words, each a row. A pass over the
    index sends one of them to the tasks; the driver sees none.
    """
    written = materialise(phrases.where(F.size("terms") > 0), "phrases")
    words = written.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    block = F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks)).cast("int")
    packed = materialise(written.withColumn("block", block).groupBy("block").applyInArrow(_pack, BLOCK_SCHEMA), "blocks")
    found = None
    for number in range(blocks):
        own = F.broadcast(packed.where(F.col("block") == number))  # one row
        at = (F.pmod("segment", F.lit(1)) + number).alias("at")  # the number, for every segment
        met = index.select("*", at).join(own, F.col("at") == F.col("block")).drop("at")
        part = met.mapInArrow(partial(_match, slop=slop), MATCH_SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: segment, ordinal, doc_id, n_words, n_hit and the sorted ids of the items it has a window of."""
    index = build_index(docs, id_col, text_col)
    found = find_phrases(index, phrases_of(items, n, item_id_col, item_text_col))
    covered = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda seen, span: F.struct(
            F.greatest(seen["end"], span["end"]).alias("end"),
            (seen["hit"] + F.greatest(F.lit(0), span["end"] - F.greatest(seen["end"], span["start"]))).alias("hit"),
        ),
        lambda seen: seen["hit"],
    )
    hits = found.groupBy("segment", "ordinal").agg(
        covered.alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("ordinal", "doc"))
    rows = rows.select(
        "segment", "ordinal", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.lengths").cast("long").alias("n_words")
    )
    return rows.join(hits, ["segment", "ordinal"], "left").select(
        "segment",
        "ordinal",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = 10, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents without any window of the items, with all their columns."""
    row = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))  # rows of one id may have other texts
    texts = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    hit = contamination(texts, items, n, id_col="row").where("n_hit > 0").select(F.col("doc_id").alias("_hit_row"))
    return docs.join(materialise(hit.distinct(), "contaminated"), row == F.col("_hit_row"), "left_anti")
