"""The trie against a counter, collocations against a plain search, and their defined results."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n int"


def plain(rows, least, top=C.TOP):
    """The definition, with a dictionary per language."""
    counts, total = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            longer = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def sample(seed):
    r = random.Random(seed)
    words = ["The", "of", "été", "x", "y", "zz", "cat", " ", "E-mail", "1"]
    seps = [" ", " ", " ", " ", "\t", ", ", ".", "\n", " ; "]
    rows = []
    for i in range(120):
        text = "".join(r.choice(words[: r.randint(2, 10)]) + r.choice(seps) for _ in range(r.randint(0, 40)))
        text += " New York City" * r.randint(0, 2)
        rows.append((i, None if r.random() < 0.05 else text, r.choice(["en", "fr", None, "und"]), i))
    return rows


@pytest.mark.parametrize(
    "least, sizes", [(3, {}), (6, {"entries": 64, "burst": 4, "merge": 16}), (1, {"entries": 1000, "burst": 64, "merge": 300})]
)
def test_equals_plain_search(spark, least, sizes, monkeypatch):
    rows = sample(least)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = C.collocations(docs, least, **sizes).collect()
    assert sorted(map(tuple, got)) == plain(rows, least)


def test_few_of_each_language(spark):
    rows = sample(9)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), 2, top=3).collect()
    assert sorted(map(tuple, got)) == plain(rows, 2, 3) and len(got) == 9


def test_trie_counts_and_runs_are_sorted():
    r = np.random.default_rng(1)
    trie, want, got = C.HatTrie(3, burst=8), Counter(), Counter()
    for _ in range(40):
        n = int(r.integers(0, 300))
        first = np.where(r.random(n) < 0.5, 7 << 56, r.integers(0, 1 << 62, n)).astype(np.uint64)  # a hot prefix
        words = [first | np.uint64(1), r.integers(1, 4, n).astype(np.uint64), r.integers(0, 300, n).astype(np.uint64)]
        want.update(zip(*(w.tolist() for w in words), strict=True))
        trie.add(words)
        if trie.size > 2000:
            for keys, columns, counts in trie.take(1000):
                assert (keys[1:] >= keys[:-1]).all() and len(set(keys >> np.uint64(60))) == 1
                for phrase, n in zip(zip(*(c.tolist() for c in columns), strict=True), counts.tolist(), strict=True):
                    got[phrase] += n
            assert trie.size <= 1000
    for _, columns, counts in trie.take(0):
        for phrase, n in zip(zip(*(c.tolist() for c in columns), strict=True), counts.tolist(), strict=True):
            got[phrase] += n
    assert got == want and trie.size == 0


def test_phrases_of_one_address(monkeypatch):
    """A container that can't burst any further, and merging where addresses don't tell phrases apart."""
    monkeypatch.setattr(C, "addresses", lambda words: np.full(len(words[0]), 5, np.uint64))
    trie = C.HatTrie(2, burst=4)
    words = [np.arange(1, 41, dtype=np.uint64) % np.uint64(20), np.zeros(40, np.uint64)]
    trie.add(words)
    (run,) = trie.take(0)
    assert sorted(run[1][0].tolist()) == list(range(20)) and set(run[2].tolist()) == {2}
    import pyarrow as pa

    part = {"words": np.stack([run[1][0], run[1][1]]).tobytes(), "counts": C.encode_varints(run[2])}
    back = {"words": np.stack([run[1][0][::-1], run[1][1]]).tobytes(), "counts": C.encode_varints(run[2])}
    merged = C._merge(pa.Table.from_pylist([part, back]), 2, 4)
    assert sorted(merged["w1"].to_pylist()) == list(range(20)) and set(merged["n"].to_pylist()) == {4}


def test_words_of_one_id_are_told_apart(spark, monkeypatch):
    """Under the first numbering two words are the same; all is counted anew under the next."""
    table = C._WORD.copy()
    table[ord("y")] = table[ord("x")]
    monkeypatch.setattr(C, "_table", lambda seed, own=C._table: own(seed) if seed else table)
    rows = [(i, "a x b, a y b", "en", i) for i in range(5)]
    got = C.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(1), 5).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5)


def test_exact_beyond_64_bits(spark):
    """Two million times the count passes 64 bits."""
    n = 9_000_000_000_000_001
    rows = [(1, 2, 0, 0, n), (1, 0, 0, 0, n), (2, 0, 0, 0, n + 7)]
    frequent = spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, n long")
    (got,) = C.weakest_cuts(frequent.where("w2 != 0"), frequent).collect()
    assert got.score == 2_000_000 * n // (2 * n + 7) and (got.l, got.r) == (n, n + 7)


def test_edges(spark):
    long = "alpha beta " * 40_000
    rows = [(1, long, "en", 1), (2, None, None, 2), (None, "", "en", 3), (3, " .,;\n", "fr", 4)]
    got = C.collocations(spark.createDataFrame(rows + rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == plain(rows + rows, C.LEAST)
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
