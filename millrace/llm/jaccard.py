"""Near duplicates by an exact grouped prefix join on word shingles.

Two texts link when their sets of five-word shingles have a Jaccard similarity of 0.75
or more. Such sets share one of their first ``floor(n / 4) + 1`` shingles in any order
that all documents agree on. The order here is by hash, but shingles that are frequent
in the corpus come last, so that passages found in very many documents do not make
candidates. Frequencies are counted over all documents; each task reports its most
frequent shingles, and the ``HEAVY`` most frequent of all go to the tasks.

1. *Group.* Documents with equal shingle sets are one node; nodes with equal size and
   prefix are one group. Groups are told by their content, so a task sends a group once.
2. *Filter.* Groups that share a prefix shingle are a list; lists break where the size
   jumps by more than a third, and equal lists count once, with the least places. A pair
   is only taken from a list if enough shingles come after the shared one in both: for
   the first shingle that two similar sets share, there are.
3. *Expand and verify.* Lists are expanded to nodes. In the first round each node is compared
   with the first node of the longest list it is in; in round ``k`` after it, every open list
   has ``8 ** (k - 1)`` pivots, about, which are compared with its nodes of other components. First by bitmaps, of a
   few bits a shingle, each flipped by the shingles that hash to it: bitmaps that differ in
   more places than similar sets have different shingles rule a pair out for certain. Long lists
   are joined under the same condition on bitmaps of ``SKETCH`` words, so that pairs which it rules
   out are never made. What remains is verified on the whole texts, which only these nodes need.
   Linked nodes join components; a list is closed when all its nodes are of one component
   or every pair of different components has been verified. Lists up to ``SHORT`` nodes
   are finished in the third round. Lists of near copies of one text, however long and many,
   are thus closed after rounds that are linear in the nodes, and no link that joins two
   components is lost.

A pivot's list is a join of two written tables, which adaptive execution can split, and
a frequent shingle's postings are dealt to several tasks by document.

Defined results: a null or blank text has no shingles and is linked with nothing; its
component is its own id. Repeated rows link like any equal texts. A null ``doc_id`` is
never the smallest: a component of null ids alone has a null id. Other columns are ignored
by ``near_groups`` and kept by ``drop_near``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.llm.components import components
from millrace.llm.text import NONBLANK, gives_back, mix, pieces, shingles, split_words, string_array

WORDS = 5
TEXT_BYTES = 1 << 19  # of text whose words are held at once
HEAVY = 1 << 17  # frequent shingles that every task knows at most: 24 bytes each
REPORTED = 1 << 14  # frequent shingles that a task reports per CHUNK
CHUNK = 1 << 20  # shingles gathered before a task reports or sends
SLOT = 1 << 18  # prefix shingles per group of lists, about
SHORT = 16  # lists up to this length are verified at once, pair by pair
SPLIT = 1 << 19  # postings of a frequent shingle that may meet in one task
SKETCH = 8  # words of 64 bits of the bitmaps that the joins of long lists compare
SENT = 100_000  # nodes whose texts are asked for by a broadcast, of less than 100 bytes each; more by a shuffle

_DOC = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.string()),
        ("n", pa.int64()),
        ("node_key", pa.binary()),
        ("bitmap", pa.binary()),
        ("sketch", pa.list_(pa.int64())),
        ("token", pa.int64()),
        ("count", pa.int64()),
    ]
)
DOC_SCHEMA = "doc_id long, text_key string, n long, node_key binary, bitmap binary, sketch array<long>, token long, count long"
_BLOB = pa.schema(
    [
        ("slot", pa.int64()),
        ("tokens", pa.binary()),
        ("gids", pa.binary()),
        ("sizes", pa.binary()),
        ("counts", pa.binary()),
        ("places", pa.binary()),
        ("keys", pa.binary()),
    ]
)
BLOB_SCHEMA = "slot long, tokens binary, gids binary, sizes binary, counts binary, places binary, keys binary"
LIST_SCHEMA = "token long, part long, gid long, place long, node_key binary"
_KEY_BYTES = 16


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the shingle set of every text of a batch."""
    for low, piece in pieces(string_array(batch.column(column)), TEXT_BYTES):
        for i, own in enumerate(shingles(split_words(piece, NONBLANK), WORDS)):
            yield low + i, own


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=_KEY_BYTES).digest()


def _bitmap(own: np.ndarray) -> bytes:
    """Parities of how many shingles hash to each of 2 to 4 bits per shingle, a power of two of them."""
    bits = 1 << max(6, (2 * len(own) - 1).bit_length())
    counts = np.bincount((own >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _sketch(own: np.ndarray) -> np.ndarray:
    """The same parities in ``SKETCH`` words, for sets of any size."""
    bits = 64 * SKETCH
    counts = np.bincount((own >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").view(np.int64)


def _frequent(sets: list[np.ndarray]) -> pa.RecordBatch | None:
    """The shingles that most of these documents share."""
    tokens = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else []
    counts = np.diff(np.append(starts, len(tokens)).astype(np.int64))
    often = np.flatnonzero(counts > 1)
    often = often[np.argsort(-counts[often], kind="stable")[:REPORTED]]
    if not len(often):
        return None
    nothing = [pa.nulls(len(often), field.type) for field in _DOC][:6]
    found = [pa.array(tokens[starts[often]].view(np.int64)), pa.array(counts[often])]
    return pa.RecordBatch.from_arrays([*nothing, *found], schema=_DOC)


@gives_back
def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with its node, and rows with frequent shingles."""
    gathered, held = [], 0
    for batch in batches:
        sizes, keys, bitmaps, sketches = [], [], [], []
        for _, own in _sets(batch, 2):
            sizes.append(len(own))
            bitmaps.append(_bitmap(own))
            sketches.append(_sketch(own))
            keys.append(_digest(own.tobytes()))
            gathered.append(own)
            held += len(own)
            if held >= CHUNK:
                if (report := _frequent(gathered)) is not None:
                    yield report
                gathered, held = [], 0
        nothing = pa.nulls(len(sizes), pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bitmaps, pa.binary())]
        columns[1] = string_array(columns[1])
        columns.append(pa.array(sketches, _DOC.field("sketch").type))
        yield pa.RecordBatch.from_arrays([*columns, nothing, nothing], schema=_DOC)
    if (report := _frequent(gathered)) is not None:
        yield report


def _prefix(own: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set: by hash, the frequent ones last, the most frequent at the end."""
    length = len(own) // 4 + 1
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, own), len(heavy) - 1)
        often = heavy[at] == own
        light = own[~often]
        if len(light) < length:
            rest = own[often][np.argsort(rank[at[often]], kind="stable")]
            return np.concatenate([light, rest[: length - len(light)]])
        return light[:length]
    return own[:length]


class _Postings:
    """Prefix shingles of the groups a task has seen, until they are sent."""

    def __init__(self, slots: int, heavy: np.ndarray, spread: np.ndarray):
        self.slots, self.heavy, self.spread = slots, heavy, spread
        self.clear()

    def clear(self) -> None:
        self.groups: dict[int, int] = {}
        self.tokens: list[np.ndarray] = []
        self.members: set[tuple[int, bytes]] = set()
        self.sizes: list[int] = []
        self.held = 0

    def add(self, n: int, prefix: np.ndarray, key: bytes) -> None:
        gid = int.from_bytes(_digest(n.to_bytes(8, "little"), prefix.tobytes())[:8], "little")
        self.members.add((gid, key))
        if gid not in self.groups:
            self.groups[gid] = len(self.tokens)
            self.tokens.append(prefix)
            self.sizes.append(n)
            self.held += len(prefix)

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.groups:
            return
        gids = np.array(list(self.groups), np.uint64)
        tokens = np.concatenate(self.tokens)
        owner = np.repeat(np.arange(len(gids)), [len(t) for t in self.tokens])
        places = [(np.arange(len(t)) * 256 // n).astype(np.uint8) for t, n in zip(self.tokens, self.sizes, strict=True)]
        places = np.concatenate(places)  # in 256ths of the set, rounded down
        slot = (tokens % np.uint64(self.slots)).astype(np.int64)
        if len(self.heavy):  # the postings of very frequent shingles are dealt by group
            at = np.minimum(np.searchsorted(self.heavy, tokens), len(self.heavy) - 1)
            parts = np.where(self.heavy[at] == tokens, self.spread[at], 1)
            dealt = parts > 1
            part = gids[owner[dealt]] % parts[dealt].astype(np.uint64)
            away = (mix(tokens[dealt] + part) >> np.uint64(2)).astype(np.int64)
            slot[dealt] = 2 * self.slots + away % (1 << 60)
        order = np.argsort(slot, kind="stable")
        slot, tokens, owner, places = slot[order], tokens[order], owner[order], places[order]
        sizes = np.array(self.sizes, np.uint32)
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rows = []
        for low, high in zip(starts, np.append(starts[1:], len(slot)), strict=True):
            own, firsts = np.unique(owner[low:high], return_index=True)  # the order kept the groups together
            counts = np.diff(np.append(firsts, high - low)).astype(np.uint32)
            rows.append(
                {
                    "slot": int(slot[low]),
                    "tokens": tokens[low:high].tobytes(),
                    "gids": gids[own].tobytes(),
                    "sizes": sizes[own].tobytes(),
                    "counts": counts.tobytes(),
                    "places": places[low:high].tobytes(),
                }
            )
        by_slot: dict[int, list[tuple[int, bytes]]] = {}
        for gid, key in self.members:
            by_slot.setdefault(self.slots + gid % self.slots, []).append((gid, key))
        for number, members in by_slot.items():
            ids = np.array([gid for gid, _ in members], np.uint64)
            rows.append({"slot": number, "gids": ids.tobytes(), "keys": b"".join(key for _, key in members)})
        yield pa.RecordBatch.from_pylist(rows, _BLOB)
        self.clear()


@gives_back
def _postings(batches, slots: int, heavy: np.ndarray, rank: np.ndarray, spread: np.ndarray):
    out = _Postings(slots, heavy, spread)
    for batch in batches:
        for _, own in _sets(batch, 0):
            if len(own):
                out.add(len(own), _prefix(own, heavy, rank), _digest(own.tobytes()))
            if out.held >= CHUNK:
                yield from out.send()
    yield from out.send()


def _numbers(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), kind)


def _lists(key: tuple, table: pa.Table, slots: int) -> pa.Table:
    """The lists of a slot with more than one group; or its groups' nodes."""
    slot = key[0].as_py()
    gids = _numbers(table["gids"], np.uint64)
    if slots <= slot < 2 * slots:
        blob = b"".join(table["keys"].to_pylist())
        keys = [blob[i : i + _KEY_BYTES] for i in range(0, len(blob), _KEY_BYTES)]
        members = sorted(set(zip(gids.tolist(), keys, strict=True)))
        ids = np.array([gid for gid, _ in members], np.uint64).view(np.int64)
        counts = np.unique(ids, return_counts=True)
        several = np.isin(ids, counts[0][counts[1] > 1])  # nodes of one group are a list, too
        own = pa.array([key for _, key in members], pa.binary())
        token = np.concatenate([ids[several], np.zeros(len(ids), np.int64)])
        empty = np.append(np.zeros(several.sum(), bool), np.ones(len(ids), bool))
        return pa.table(
            {
                "token": pa.array(token, mask=empty),
                "part": pa.array(np.full(len(token), -1), pa.int64()),
                "gid": pa.array(np.concatenate([ids[several], ids])),
                "place": pa.array(np.zeros(len(token), np.int64)),
                "node_key": pa.concat_arrays([own.filter(pa.array(several)), own]),
            }
        )
    counts = _numbers(table["counts"], np.uint32)
    gids, sizes = np.repeat(gids, counts), np.repeat(_numbers(table["sizes"], np.uint32), counts).astype(np.int64)
    tokens = _numbers(table["tokens"], np.uint64)
    places = _numbers(table["places"], np.uint8) * sizes // 256
    if slot < slots:
        order = np.argsort(tokens, kind="stable")
        run = np.flatnonzero(np.append(True, tokens[order][1:] != tokens[order][:-1]))
        lengths = np.diff(np.append(run, len(tokens)))
        order = order[np.repeat(lengths > 1, lengths)]
        tokens, gids, sizes, places = tokens[order], gids[order], sizes[order], places[order]
    order = np.lexsort((gids, sizes, tokens))
    tokens, gids, sizes, places = tokens[order], gids[order], sizes[order], places[order]
    new = np.append(True, (tokens[1:] != tokens[:-1]) | (gids[1:] != gids[:-1]))[: len(tokens)]
    tokens, gids, sizes, places = tokens[new], gids[new], sizes[new], places[new]
    part = np.full(len(tokens), -2, np.int64)
    if slot < slots and len(tokens):
        cut = np.append(True, (tokens[1:] != tokens[:-1]) | (4 * sizes[:-1] < 3 * sizes[1:]))
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(tokens)))
        sums = [np.add.reduceat(mix(gids + np.uint64(salt)), starts) for salt in (1, 2)]
        content = np.stack([*sums, lengths.astype(np.uint64)], axis=1)
        _, firsts, which = np.unique(content, axis=0, return_index=True, return_inverse=True)
        same = np.repeat(starts[firsts[which.ravel()]] - starts, lengths) + np.arange(len(tokens))
        least = places.copy()
        np.minimum.at(least, same, places)
        keep = np.zeros(len(starts), bool)
        keep[firsts] = True
        keep = np.repeat(keep & (lengths > 1), lengths)
        part = np.repeat(sizes[starts], lengths)[keep]
        tokens, gids, places = tokens[keep], gids[keep], least[keep]
    return pa.table(
        {
            "token": tokens.view(np.int64),
            "part": part,
            "gid": gids.view(np.int64),
            "place": places.astype(np.int64),
            "node_key": pa.nulls(len(tokens), pa.binary()),
        }
    )


@gives_back
def _rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sizes and bitmaps of both) -> (a, b) that may be similar.

    Similar sets differ in a seventh of the sum of their sizes at most, and bitmaps in no
    more places than sets. A longer bitmap is folded to the length of the other.
    """
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
        near = []
        for m, n, left, right in rows:
            x, y = int.from_bytes(left, "little"), int.from_bytes(right, "little")
            long, short = 8 * len(left), 8 * len(right)
            if long < short:
                x, y, long, short = y, x, short, long
            while long > short:
                long //= 2
                x = (x >> long) ^ (x & ((1 << long) - 1))
            near.append(7 * (x ^ y).bit_count() <= m + n)
        yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))


@gives_back
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> (a, b) whose sets are similar enough."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        firsts = np.unique(a, return_index=True)[1]
        pivots = batch.take(pa.array(firsts))
        sets = {int(a[firsts[i]]): own for i, own in _sets(pivots, 2)}
        linked = np.zeros(len(a), bool)
        for i, own in _sets(batch, 3):
            other = sets[int(a[i])]
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            common = int((other[at] == own).sum())
            linked[i] = 100 * common >= 75 * (len(own) + len(other) - common)
        yield batch.select([0, 1]).filter(pa.array(linked))


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _may_link(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of nodes whose bitmaps don't rule them out."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bitmap").alias("bitmap_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bitmap").alias("bitmap_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")
    return both.mapInArrow(_rule_out, "a long, b long")


def _linked(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs of nodes that are similar, each verified on the whole texts in ``rows``."""
    pairs = materialise(_may_link(pairs, nodes), "near")
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node")
    need = need.select("node", F.col("first.doc_id").alias("need_id"), F.col("first.text_key").alias("need_key"))
    need = materialise(need, "need")
    if need.isEmpty():
        return pairs
    need = F.broadcast(need) if need.count() <= SENT else need
    same = rows["doc_id"].eqNullSafe(F.col("need_id")) & (rows["text_key"] == F.col("need_key"))
    texts = rows.join(need, same).groupBy("node").agg(F.first("text").alias("text"))
    texts = materialise(texts, "texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return materialise(both.mapInArrow(_verify, "a long, b long"), "links")


def _similar_size(m: str, n: str) -> Column:
    return (4 * F.col(m) >= 3 * F.col(n)) & (4 * F.col(n) >= 3 * F.col(m))


def _candidates(entries: DataFrame, others: DataFrame, more: Column) -> DataFrame:
    """Distinct pairs of a list's nodes of similar size that satisfy ``more``, and whose sketches, if given, don't rule them out."""
    known = [c for c in ("node", "n", "place", "component", "sketch") if c in others.columns]
    b = others.select("token", "part", *[F.col(c).alias(f"{c}_b") for c in known])
    left = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))  # the shared one and those after it
    enough = 7 * left >= 3 * (F.col("n") + F.col("n_b"))
    if "sketch" in known:
        words = [F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("sketch_b", F.lit(i)))) for i in range(SKETCH)]
        more = more & (7 * sum(words[1:], words[0]) <= F.col("n") + F.col("n_b"))
    pairs = entries.join(b, ["token", "part"]).where(_similar_size("n", "n_b") & enough & more)
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def _with_first(entries: DataFrame) -> DataFrame:
    """Distinct pairs of a list's nodes with its first one, of similar size and another component; each row knows that node."""
    first = entries.select(*[F.col(f"first.{c}").alias(f"{c}_b") for c in ("node", "n", "place", "component")], *entries.columns)
    left = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    enough = 7 * left >= 3 * (F.col("n") + F.col("n_b"))
    differ = (F.col("component") != F.col("component_b")) & (F.col("node") != F.col("node_b"))
    pairs = first.where(_similar_size("n", "n_b") & enough & differ)
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def _of_lists(rows: DataFrame) -> DataFrame:
    component = [F.min("component").alias("low"), F.max("component").alias("high")] if "component" in rows.columns else []
    known = [c for c in ("node", "n", "place", "component") if c in rows.columns]
    first = F.min_by(F.struct(*known), "node").alias("first")
    return rows.groupBy("token", "part").agg(F.count("*").alias("length"), first, *component)


def _joined(entries: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) by links enough to join all nodes that links can reach. ``entries``: (token, part, node, n, place)."""
    differ = (F.col("component") != F.col("component_b")) & (F.col("node") != F.col("node_b"))
    lists = materialise(_of_lists(entries), "lists")
    longest = F.max(F.struct("length", "first")).alias("l")
    pairs = entries.join(lists, ["token", "part"]).groupBy("node").agg(F.min("n").alias("n"), longest)
    pairs = pairs.where(F.col("node") != F.col("l.first.node")).where(_similar_size("n", "l.first.n"))
    pairs = pairs.select(F.least("node", "l.first.node").alias("a"), F.greatest("node", "l.first.node").alias("b"))
    checked = materialise(pairs.distinct(), "pairs")
    links = _linked(checked, nodes, docs)
    rows = entries
    for turn in count(1):
        found = materialise(components(links, "a", "b"), "components")
        rows = rows.select("token", "part", "node", "n", "place").join(found, "node", "left")
        rows = materialise(rows.withColumn("component", F.coalesce("component", "node")), "entries")
        unfinished = materialise(_of_lists(rows).where("low < high").drop("low", "high"), "lists")
        rows = materialise(rows.join(unfinished, ["token", "part"]), "entries")
        if rows.isEmpty():
            return found
        small = F.col("length") <= (SHORT if turn > 1 else 2)
        short, long = rows.where(small), rows.where(~small)
        pairs = _candidates(short, short, differ & (F.col("node") < F.col("node_b")))
        is_pivot = F.col("node") == F.col("first.node")
        if turn > 1:
            every = F.ceil(F.col("length") / F.lit(8 ** (turn - 1)))
            is_pivot = is_pivot | (F.pmod(F.xxhash64("node", F.lit(turn)), every) == 0)
            told = long.join(nodes.select("node", "sketch"), "node")
        pivots = _with_first(long) if turn == 1 else _candidates(told, told.where(is_pivot), differ)
        pairs = pairs.unionByName(pivots).distinct()
        pairs = materialise(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(_linked(pairs, nodes, docs))
        checked = checked.unionByName(pairs)
        rows = materialise(long.where(~is_pivot), "entries")
        if rows.isEmpty():
            return materialise(components(links, "a", "b"), "components")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id and ``first``, true for one text of each component."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )
    described = materialise(rows.mapInArrow(_describe, DOC_SCHEMA), "described")
    per_doc = described.where("node_key IS NOT NULL").drop("token", "count")

    frequent = described.where("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("count"))
    frequent = materialise(frequent, "frequent")
    least, held = 0, 0
    for row in frequent.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.desc("count")).collect():
        held += row["n"]
        if held > HEAVY:
            break
        least = row["count"]
    known = frequent.where((F.col("count") >= least) & F.lit(least > 0)).orderBy("count", "token").collect()
    heavy = np.array([r["token"] for r in known], np.int64).view(np.uint64)
    by_hash = np.argsort(heavy)
    counts = np.array([r["count"] for r in known], np.int64)[by_hash]
    heavy, rank, spread = heavy[by_hash], by_hash, -(-counts // SPLIT)  # the most frequent last
    total = per_doc.agg(F.sum(F.floor(F.col("n") / 4) + 1)).first()[0] or 0
    slots = max(1, -(-int(total) // SLOT))
    blobs = rows.select("text").mapInArrow(
        partial(_postings, slots=slots, heavy=heavy, rank=rank, spread=spread), BLOB_SCHEMA
    )
    lists = blobs.groupBy("slot").applyInArrow(lambda key, table: _lists(key, table, slots), LIST_SCHEMA)
    lists = materialise(lists, "lists")

    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    nodes = per_doc.where("n > 0").groupBy("node_key").agg(
        F.min("n").alias("n"), smallest.alias("first"), F.first("bitmap").alias("bitmap"), F.first("sketch").alias("sketch")
    )
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = lists.where("token IS NULL").select("gid", "node_key").join(nodes.select("node_key", "node", "n"), "node_key")
    alone = lists.where("part = -1 AND token IS NOT NULL").join(nodes.select("node_key", "node", "n"), "node_key")
    entries = lists.where("token IS NOT NULL AND part != -1").drop("node_key").join(members.drop("node_key"), "gid")
    columns = ["token", "part", "node", "n", "place"]
    entries = entries.select(columns).unionByName(alone.select(columns))
    entries = materialise(entries.distinct(), "entries")

    of_node = nodes.join(_joined(entries, nodes, rows), "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_component = materialise(of_node.groupBy("component").agg(F.min("first").alias("head")), "heads")
    of_node = materialise(of_node.join(of_component, "component").select("node_key", "head"), "of_node")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    empty = F.col("head").isNull()
    return per_doc.join(of_node, "node_key", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (empty | (F.col("head") == key)).alias("first"),
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all columns; those without words stay."""
    groups = near_groups(docs, id_col, text_col)
    first = groups.where("first").groupBy(F.col("doc_id").alias("_near_id"), F.col("text_key").alias("_near_key"))
    first = materialise(first.agg((F.min("n_shingles") > 0).alias("_near_words"), F.count("*").alias("_near_rows")), "first")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_near_id")) & (_text_key(F.col(text_col)) == F.col("_near_key"))
    kept = docs.join(first, same)
    again = F.col("_near_words") & (F.col("_near_rows") > 1)  # rows repeated with their id and text
    if not first.where(again).isEmpty():
        once = kept.where(again).dropDuplicates(["_near_id", "_near_key"])
        kept = kept.where(~again).unionByName(once)
    return kept.select(docs.columns)
