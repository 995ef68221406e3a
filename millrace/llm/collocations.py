"""Phrase collocations, counted in burstable hash containers under a word-id trie.

A word's id is a 64-bit hash of its language and its text, so that everything below is per
language by itself. A phrase's address is a byte of its first word's id, a byte of its second
word's, and 48 hashed bits of the whole phrase. ``HatTrie`` is a trie over the digits of the
addresses, which is shallow: only a leaf that outgrows ``BURST`` phrases bursts into sixteen.
Its leaves are open-addressing hash containers from phrase to count. When a task's trie holds
``TRIE_ENTRIES`` phrases, the fullest subtrees of the root leave it as sorted runs. The runs are a
written table; a histogram of them over the 65,536 prefixes of two words cuts the addresses
into ranges of about ``MERGE`` entries each, within a prefix too where it is hot, and
each range merges its parts of all runs.

Phrases are counted in three readings: words, then pairs of words that are frequent enough,
then phrases of three and four words all of whose pairs are. A phrase is no more frequent than
its parts, so nothing is missed. What the next reading may skip is told by a bitmap over the
hashes of the frequent parts, of 16 MB at most; a chance hit costs a count that is then too
small, and no more.

Scores, cuts and covered phrases are joins and minima on written tables, whose hot keys
adaptive execution can split.

Defined results: a null text is empty, a null language ``und``. Repeated rows count as often
as they occur. An empty table gives an empty result; other columns are ignored. Two words with
one id are found among all distinct words, and then all is counted anew under other ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise, scratch_path
from millrace.llm.text import Words, byte_table, decode_varints, encode_varints, mix, pieces, split_words, string_array
from millrace.operators.ranking import top_rows_per_group

LEAST = 30  # occurrences of a phrase
LONGEST = 4  # words
COVERED = 80  # per cent of a phrase's occurrences in a longer one
SCALE = 2_000_000
TOP = 2000

BURST = 1 << 15
TRIE_ENTRIES = 1 << 19
MERGE = 1 << 19
RUN_ENTRIES = 1 << 13  # phrases of a row of the table of runs
PIECE_BYTES = 1 << 19  # of text whose words are held at once
RUN_BYTES = 4 << 20  # of a row group of that table, so that its files can be read in parts
FILTER_BITS = 27

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = np.isin(np.arange(256), list(_BREAKS))
_WORD = byte_table(lambda b: b in b"\x20\x09" + _BREAKS)
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)

WORD_SCHEMA = "id long, lang string, word string, n long"
RUN_SCHEMA = "prefixes binary, entries binary, words binary, counts binary"
PART_SCHEMA = "part int, words binary, counts binary"
_IDS = [f"w{k}" for k in range(1, LONGEST + 1)]
PHRASE_SCHEMA = ", ".join(f"{w} long" for w in _IDS) + ", pair long, n long"


def _table(seed: int) -> np.ndarray:
    """The separators and lower-cased bytes, under other numbers for each seed."""
    if not seed:
        return _WORD
    numbers = np.append(0, 1 + np.random.default_rng(seed).permutation(256)).astype(np.uint16)
    return numbers[_WORD]


@dataclass
class Tokens:
    """The ids of a batch's words, and whether each is followed by another of the same stretch."""

    ids: np.ndarray
    joined: np.ndarray
    doc: np.ndarray
    words: Words

    def texts(self, at: np.ndarray) -> pa.Array:
        """The lower-cased words at some places."""
        starts = self.words.starts[at]
        lengths = self.words.ends[at] - starts
        offsets = np.append(0, np.cumsum(lengths))
        data = _LOWER[self.words.data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]]
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _tokens(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Tokens, list[str]]]:
    table, known = _table(seed), {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for low, piece in pieces(string_array(batch.column(0)), PIECE_BYTES):
            found = split_words(piece, table)
            own = langs[low : low + len(piece)]
            for lang in own:
                if lang not in known:
                    known[lang] = xxhash.xxh64_intdigest(lang, seed)
            doc = np.repeat(np.arange(len(piece)), np.diff(found.bounds))
            ids = mix(found.hashes + np.array([known[lang] for lang in own], np.uint64)[doc]) | np.uint64(1)
            breaks = np.cumsum(_BREAK[found.data])[found.starts] if len(ids) else np.zeros(0, np.int64)
            joined = np.zeros(len(ids), bool)
            joined[:-1] = (breaks[1:] == breaks[:-1]) & (doc[1:] == doc[:-1])
            yield Tokens(ids, joined, doc, found), own


def _count_words(batches: Iterator[pa.RecordBatch], seed: int, entries: int) -> Iterator[pa.RecordBatch]:
    """Distinct words of about ``entries / 2`` at a time, with their texts and counts."""
    held: list[pa.Table] = []
    size = 0
    for tokens, langs in _tokens(batches, seed):
        ids, at, n = np.unique(tokens.ids, return_index=True, return_counts=True)
        if not len(ids):
            continue
        lang = pa.array(langs, pa.string()).take(pa.array(tokens.doc[at]))
        held.append(pa.table({"id": ids.view(np.int64), "lang": lang, "word": tokens.texts(at), "n": n}))
        size += len(ids)
        if size > entries // 2:  # the rows are added up once more before they leave their task
            yield from _merged_words(held).to_batches()
            held, size = [], 0
    if held:
        yield from _merged_words(held).to_batches()
    pa.default_memory_pool().release_unused()


def _merged_words(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables).combine_chunks()
    # The text is part of the key: of two words with one id both are to be seen.
    found = table.group_by(["id", "lang", "word"]).aggregate([("n", "sum")])
    return found.select(["id", "lang", "word", "n_sum"]).rename_columns(["id", "lang", "word", "n"])


def addresses(words: list[np.ndarray]) -> np.ndarray:
    """A byte of the first id, a byte of the second, and 48 hashed bits of all of them."""
    h = np.zeros(len(words[0]), np.uint64)
    for column in words:
        h = mix(h + column)
    top = np.uint64(0xFF) << np.uint64(56)
    return (words[0] & top) | ((words[1] & top) >> np.uint64(8)) | (h >> np.uint64(16))


class Container:
    """An open-addressing hash table from phrases to counts; arrays throughout."""

    def __init__(self, width: int):
        self.size = 0
        self.slots = np.full(1 << 8, -1, np.int32)
        self.keys = np.zeros(1 << 7, np.uint64)
        self.words = [np.zeros(1 << 7, np.uint64) for _ in range(width)]
        self.counts = np.zeros(1 << 7, np.int64)

    def _reserve(self, more: int) -> None:
        room = len(self.keys)
        while room < self.size + more:
            room *= 2
        if room == len(self.keys):
            return
        grow = [np.append(a[: self.size], np.zeros(room - self.size, a.dtype)) for a in (self.keys, self.counts, *self.words)]
        self.keys, self.counts, self.words = grow[0], grow[1], grow[2:]
        self.slots = np.full(2 * room, -1, np.int32)
        slot, left = self._slot(self.keys[: self.size]), np.arange(self.size, dtype=np.int32)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def add(self, keys: np.ndarray, words: list[np.ndarray], counts: np.ndarray) -> None:
        """Count phrases, which may be repeated among themselves."""
        self._reserve(len(keys))
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = np.flatnonzero(self.slots[slot] < 0)
            if len(free):  # several phrases may want one slot; one of them gets it
                claim = np.arange(len(free), dtype=np.int32)
                self.slots[slot[free]] = claim
                won = free[self.slots[slot[free]] == claim]
                entry = np.arange(self.size, self.size + len(won), dtype=np.int32)
                self.slots[slot[won]] = entry
                self.keys[entry] = keys[left[won]]
                for own, column in zip(self.words, words, strict=True):
                    own[entry] = column[left[won]]
                self.size += len(won)
            at = self.slots[slot]
            same = self.keys[at] == keys[left]
            for own, column in zip(self.words, words, strict=True):
                same &= own[at] == column[left]
            np.add.at(self.counts, at[same], counts[left[same]])
            left, slot = left[~same], (slot[~same] + 1) & (len(self.slots) - 1)

    def entries(self) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        return self.keys[: self.size], [w[: self.size] for w in self.words], self.counts[: self.size]


class HatTrie:
    """Leaves that partition the addresses, each a container; the digits are of four bits."""

    def __init__(self, width: int, burst: int = BURST):
        self.width, self.burst = width, burst
        self.lows = [t << 60 for t in range(16)]  # of each leaf the lowest address, and how many bits it leaves open
        self.bits = [60] * 16
        self.leaves = [Container(width) for _ in range(16)]

    @property
    def size(self) -> int:
        return sum(leaf.size for leaf in self.leaves)

    def add(self, words: list[np.ndarray]) -> None:
        keys = addresses(words)
        leaf = np.searchsorted(np.array(self.lows, np.uint64), keys, "right") - 1
        order = np.argsort(leaf.astype(np.uint16 if len(self.lows) < 1 << 16 else np.int64), kind="stable")
        keys, words = keys[order], [w[order] for w in words]
        cuts = np.searchsorted(leaf[order], np.arange(len(self.lows) + 1))
        ones = np.ones(len(keys), np.int64)
        for k in reversed(range(len(self.lows))):  # a leaf that bursts moves those behind it
            for low in range(cuts[k], cuts[k + 1], self.burst):
                part = slice(low, min(low + self.burst, cuts[k + 1]))
                self.leaves[k].add(keys[part], [w[part] for w in words], ones[part])
            if self.leaves[k].size > self.burst:
                self._burst(k)

    def _burst(self, k: int) -> None:
        keys, words, counts = self.leaves[k].entries()
        low, bits = self.lows[k], self.bits[k] - 4
        if bits < 0:
            return  # one address; its phrases share a container of any size
        digit = ((keys - np.uint64(low)) >> np.uint64(bits)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        cuts = np.searchsorted(digit[order], np.arange(17))
        parts = []
        for d in range(16):
            own = order[cuts[d] : cuts[d + 1]]
            parts.append(Container(self.width))
            parts[-1].add(keys[own], [w[own] for w in words], counts[own])
        self.lows[k : k + 1] = [low + (d << bits) for d in range(16)]
        self.bits[k : k + 1] = [bits] * 16
        self.leaves[k : k + 1] = parts
        for d in reversed(range(16)):
            if parts[d].size > self.burst:
                self._burst(k + d)

    def take(self, most: int) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
        """Empty the fullest subtrees of the root until at most ``most`` phrases are left: a sorted run of each."""
        top = np.array(self.lows, np.uint64) >> np.uint64(60)
        sizes = np.bincount(top.astype(np.int64), [leaf.size for leaf in self.leaves], 16)
        left = int(sizes.sum())
        for t in np.argsort(-sizes, kind="stable").tolist():
            if left <= most or not sizes[t]:
                break
            left -= int(sizes[t])
            own = [k for k, low in enumerate(self.lows) if low >> 60 == t]
            runs = [self.leaves[k].entries() for k in own]
            before = np.cumsum([0] + [len(r[0]) for r in runs])
            order = np.concatenate([np.argsort(r[0]) + b for r, b in zip(runs, before[:-1], strict=True)])
            yield (
                np.concatenate([r[0] for r in runs])[order],
                [np.concatenate([r[1][w] for r in runs])[order] for w in range(self.width)],
                np.concatenate([r[2] for r in runs])[order],
            )
            self.lows[own[0] : own[-1] + 1] = [t << 60]
            self.bits[own[0] : own[-1] + 1] = [60]
            self.leaves[own[0] : own[-1] + 1] = [Container(self.width)]


def _run_rows(run: tuple[np.ndarray, list[np.ndarray], np.ndarray]) -> pa.RecordBatch:
    keys, words, counts = run
    rows = []
    for low in range(0, len(keys), RUN_ENTRIES):
        part = slice(low, low + RUN_ENTRIES)
        prefixes, n = np.unique(keys[part] >> np.uint64(48), return_counts=True)
        rows.append(
            {
                "prefixes": encode_varints(prefixes),
                "entries": encode_varints(n),
                "words": np.stack([w[part] for w in words]).tobytes(),
                "counts": encode_varints(counts[part]),
            }
        )
    return pa.RecordBatch.from_pylist(rows, pa.schema([(c.split()[0], pa.binary()) for c in RUN_SCHEMA.split(", ")]))


@dataclass
class Bitmap:
    """A set of hashes, some others by chance: each has two bits."""

    bits: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 64 - 1)
        found = np.ones(len(hashes), bool)
        for h in (hashes, hashes >> np.uint64(32)):
            at = h & mask
            found &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return found

    @classmethod
    def of(cls, keys: DataFrame, column: str, most: int = FILTER_BITS) -> Bitmap:
        """About 16 bits for each key, at most ``2 ** most`` altogether, set where the keys are."""
        n = keys.count()
        width = min(max(16, (16 * n).bit_length()), most)
        mask = (1 << width) - 1
        places = F.array(F.col(column), F.shiftrightunsigned(F.col(column), 32))
        place = keys.select(F.explode(places).alias("at")).select(F.col("at").bitwiseAND(mask).alias("at"))
        one = F.expr("shiftleft(1L, cast(at & 63 as int))")
        found = place.groupBy(F.expr("at div 64").alias("block")).agg(F.bit_or(one).alias("bits")).toArrow()
        bits = np.zeros(1 << (width - 6), np.uint64)
        bits[found["block"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(bits)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second)


def _shifted(a: np.ndarray, k: int) -> np.ndarray:
    """What stands ``k`` places on; nothing (0) past the end."""
    out = np.zeros_like(a)
    out[: max(len(a) - k, 0)] = a[k:]
    return out


def _count_phrases(
    batches: Iterator[pa.RecordBatch], seed: int, frequent: Bitmap, pairs: bool, entries: int, burst: int
) -> Iterator[pa.RecordBatch]:
    """Sorted runs of pairs of frequent words, or of longer phrases of frequent pairs."""
    trie = HatTrie(2 if pairs else LONGEST, burst)
    for tokens, _ in _tokens(batches, seed):
        ids, joined = tokens.ids, tokens.joined
        second = _shifted(ids, 1)
        if pairs:
            known = frequent.has(ids)
            at = np.flatnonzero(joined & known & _shifted(known, 1))
            columns = [[ids[at], second[at]]]
        else:
            linked = np.zeros(len(ids), bool)
            at = np.flatnonzero(joined)
            linked[at] = frequent.has(pair_hash(ids[at], second[at]))
            columns, running = [], linked
            for n in range(3, LONGEST + 1):
                running = running & _shifted(linked, n - 2)
                at = np.flatnonzero(running)
                ids_of = [_shifted(ids, k)[at] for k in range(n)]
                columns.append(ids_of + [np.zeros(len(at), np.uint64)] * (LONGEST - n))
        for phrases in columns:
            step = max(entries // 4, 1)
            for low in range(0, len(phrases[0]), step):
                trie.add([c[low : low + step] for c in phrases])
                if trie.size > entries:
                    yield from map(_run_rows, trie.take(entries // 2))
    yield from map(_run_rows, trie.take(0))
    pa.default_memory_pool().release_unused()


def _deal(batches: Iterator[pa.RecordBatch], bounds: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """The rows of runs cut at the bounds of the address ranges."""
    schema = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        for words, counts in zip(batch.column(0), batch.column(1), strict=True):
            columns = np.frombuffer(words.as_buffer(), np.uint64).reshape(width, -1)
            counts = decode_varints(counts.as_py())
            cuts = np.append(np.searchsorted(addresses(list(columns)), bounds), columns.shape[1])
            rows = [
                {"part": p, "words": columns[:, a:b].tobytes(), "counts": encode_varints(counts[a:b])}
                for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                if a < b
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)


def _merge(table: pa.Table, width: int, least: int) -> pa.Table:
    """The phrases of a range with their summed counts; a stable sort merges the sorted runs."""
    parts = [np.frombuffer(w.as_buffer(), np.uint64).reshape(width, -1) for w in table["words"]]
    counts = np.concatenate([decode_varints(c.as_py()) for c in table["counts"]])
    words = np.concatenate(parts, axis=1)
    keys = addresses(list(words))
    order = np.argsort(keys, kind="stable")
    keys, words, counts = keys[order], words[:, order], counts[order]
    new, other = keys[1:] != keys[:-1], (words[:, 1:] != words[:, :-1]).any(axis=0)
    if (other & ~new).any():  # two phrases of one address
        order = np.lexsort((*words, keys))
        words, counts = words[:, order], counts[order]
        other = (words[:, 1:] != words[:, :-1]).any(axis=0)
    starts = np.flatnonzero(np.append(True, other))
    n = np.add.reduceat(counts, starts)
    starts, n = starts[n >= least], n[n >= least]
    found = [*words[:, starts], *[np.zeros(len(starts), np.uint64)] * (LONGEST - width)]
    pair = pair_hash(found[0], found[1])
    columns = {w: c.view(np.int64) for w, c in zip(_IDS, found, strict=True)}
    return pa.table(columns | {"pair": pair.view(np.int64), "n": n})


def _ranges(runs: DataFrame, merge: int) -> np.ndarray:
    """The lowest addresses of ranges of about ``merge`` entries, from the entries of each prefix."""

    def histogram(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for prefixes, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[decode_varints(prefixes)] += decode_varints(n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["prefix", "n"])

    found = runs.select("prefixes", "entries").mapInArrow(histogram, "prefix long, n long")
    found = found.groupBy("prefix").agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    total = np.zeros(1 << 16)
    total[found["prefix"].to_numpy()] = found["n"].to_numpy()
    upto = np.append(0.0, np.cumsum(total))
    parts = max(1, int(-(-upto[-1] // merge)))
    at = np.interp(np.arange(parts) * upto[-1] / parts, upto, np.arange(len(upto), dtype=float)) if upto[-1] else np.zeros(1)
    bounds = np.array([min(int(a * 2**48), 2**64 - 1) for a in at], np.uint64)
    bounds[0] = 0
    return bounds


def _phrases(rows: DataFrame, seed: int, frequent: Bitmap, pairs: bool, least: int, sizes: dict[str, int]) -> DataFrame:
    """The written table of the phrases of one reading that occur ``least`` times or more."""
    count = partial(_count_phrases, seed=seed, frequent=frequent, pairs=pairs, entries=sizes["entries"], burst=sizes["burst"])
    path = scratch_path(rows.sparkSession, "runs")
    rows.mapInArrow(count, RUN_SCHEMA).write.option("parquet.block.size", RUN_BYTES).parquet(path)
    runs = rows.sparkSession.read.schema(RUN_SCHEMA).parquet(path)
    width = 2 if pairs else LONGEST
    dealt = runs.select("words", "counts").mapInArrow(
        partial(_deal, bounds=_ranges(runs, sizes["merge"]), width=width), PART_SCHEMA
    )

    def merge(table: pa.Table) -> pa.Table:
        return _merge(table, width, least)

    return materialise(dealt.groupBy("part").applyInArrow(merge, PHRASE_SCHEMA), "phrases")


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST,
    lang_col: str = "lang",
    text_col: str = "text",
    entries: int = TRIE_ENTRIES,
    burst: int = BURST,
    merge: int = MERGE,
) -> tuple[DataFrame, DataFrame]:
    """Written tables of all words (id, lang, word, n), and of the phrases of up to four words that are frequent.

    A phrase is ``w1`` to ``w4``, the ids of its words (0 behind the last), and ``n``, its occurrences.
    """
    sizes = {"entries": entries, "burst": burst, "merge": merge}
    rows = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")
    )
    seed = 0
    while True:
        counted = rows.mapInArrow(partial(_count_words, seed=seed, entries=entries), WORD_SCHEMA)
        words = materialise(counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
        seed += 1
    often = words.where(F.col("n") >= least)
    pairs = _phrases(rows, seed, Bitmap.of(often, "id"), True, least, sizes)
    longer = _phrases(rows, seed, Bitmap.of(pairs, "pair"), False, least, sizes)
    none = F.lit(0).cast("long")
    single = often.select(F.col("id").alias("w1"), *[none.alias(w) for w in _IDS[1:]], "n")
    return words, materialise(single.unionByName(pairs.drop("pair")).unionByName(longer.drop("pair")), "frequent")


def _parts(words: int, low: int, high: int, **more: Column) -> Column:
    """The words from ``low`` up to ``high`` as a phrase of its own."""
    ids = [F.col(_IDS[low + k]) if low + k < high else F.lit(0).cast("long") for k in range(LONGEST)]
    return F.struct(*[c.alias(f"p{k + 1}") for k, c in enumerate(ids)], *[c.alias(name) for name, c in more.items()])


def _by_length(of) -> Column:
    """An array that depends on the number of words of a phrase; ``of`` gives the list for each number."""
    return (
        F.when(F.col("w4") != 0, F.array(*of(4))).when(F.col("w3") != 0, F.array(*of(3))).otherwise(F.array(*of(2)))
    )


def weakest_cuts(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per candidate the cut of the lowest score, the first of equals: l, r and score."""
    parts = _by_length(
        lambda m: [
            _parts(m, *ends, k=F.lit(k), left=F.lit(side == 0))
            for k in range(1, m)
            for side, ends in enumerate(((0, k), (k, m)))
        ]
    )
    parts = candidates.select(*_IDS, F.col("n").alias("a"), F.explode(parts).alias("part"))
    counts = frequent.select(*[F.col(w).alias(f"q{k + 1}") for k, w in enumerate(_IDS)], F.col("n").alias("of"))
    same = [F.col(f"part.p{k + 1}") == F.col(f"q{k + 1}") for k in range(LONGEST)]
    met = parts.join(counts, same).groupBy(*_IDS, F.col("part.k").alias("k"))
    cuts = met.agg(
        F.max("a").alias("a"), F.max(F.when(F.col("part.left"), F.col("of"))).alias("l"),
        F.max(F.when(~F.col("part.left"), F.col("of"))).alias("r"),
    )
    wide = "cast({} as decimal(20, 0))"
    score = F.expr(f"({wide.format('a')} * {SCALE}) div ({wide.format('l')} + {wide.format('r')})")
    best = cuts.groupBy(*_IDS).agg(F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select(*_IDS, "a", "cut.l", "cut.r", "cut.score")


def covering(candidates: DataFrame) -> DataFrame:
    """Per phrase within a longer candidate the most occurrences of one that holds it."""
    inner = _by_length(
        lambda m: [_parts(m, low, low + size) for size in range(2, m) for low in range(m - size + 1)]
        or [F.lit(None).cast("struct<p1:bigint,p2:bigint,p3:bigint,p4:bigint>")]
    )
    longer = candidates.where("w3 != 0").select("n", F.explode(inner).alias("part"))
    return longer.groupBy(*[F.col(f"part.p{k + 1}").alias(w) for k, w in enumerate(_IDS)]).agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
    **sizes: int,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Candidates are phrases of two to four words within a stretch without punctuation that occur
    ``a >= least`` times. A cut into two parts that occur l and r times scores
    ``floor(2000000 a / (l + r))``; the lowest cut counts. Candidates that mostly occur within a
    longer one (80 % and more) are left out. ``n`` is the number of all words of the language.
    """
    words, frequent = frequent_phrases(docs, least, lang_col, text_col, **sizes)
    candidates = frequent.where("w2 != 0")
    wide = "cast({} as decimal(20, 0))"
    inside = F.expr(f"100 * {wide.format('most')} >= {COVERED} * {wide.format('a')}")
    scored = weakest_cuts(candidates, frequent).join(covering(candidates), _IDS, "left")
    kept = materialise(scored.where(~F.coalesce(inside, F.lit(False))).drop("most"), "scored")
    each = kept.select(*_IDS, F.posexplode(F.array(*_IDS)).alias("at", "id")).where("id != 0")
    named = each.join(words.where(F.col("n") >= least).drop("n"), "id").groupBy(*_IDS)
    ordered = F.array_sort(F.collect_list(F.struct("at", "word")))
    named = named.agg(F.first("lang").alias("lang"), F.array_join(ordered["word"], " ").alias("phrase"))
    found = kept.join(named, _IDS).select("lang", "phrase", "a", "l", "r", "score")
    ranked = top_rows_per_group(found, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
