"""Periodic runs against a search over all periods, and their defined results."""

import random

import numpy as np
import pytest

from millrace.llm import runs


def plain(words, least=runs.MIN_LENGTH):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def sample(r):
    n, kinds = r.choice([0, 1, 2, 30, 90]), r.choice([1, 2, 3, 40])
    words = [r.randrange(kinds) for _ in range(n)]
    if n > 4 and r.random() < 0.5:
        a, p = r.randrange(n), r.randint(1, n // 2)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [2, 12])
def test_equals_search_over_all_periods(least):
    r = random.Random(least)
    for _ in range(300):
        texts = [sample(r) for _ in range(r.randint(1, 4))]
        bounds = np.cumsum([0, *map(len, texts)])
        got = runs.runs_of(np.array(sum(texts, []), np.uint64), bounds, least).tolist()
        want = [(s + b, m, q) for w, b in zip(texts, bounds.tolist()) for s, m, q in plain(w, least)]
        assert got == [list(w) for w in want]


def test_small_blocks_and_few_hops(monkeypatch):
    """Children tested in many blocks, smaller values found by range minima."""
    monkeypatch.setattr(runs, "BLOCK", 3)
    monkeypatch.setattr(runs, "HOPS", 1)
    test_equals_search_over_all_periods(2)


def test_long_runs_at_once():
    """A word repeated a hundred thousand times, and one whose chain of ever shallower intervals is as long."""
    n = 100_000
    same = np.zeros(n, np.uint64)
    assert runs.runs_of(same, np.array([0, n])).tolist() == [[0, n, 1]]
    falling = np.append(np.append([5, 0], same), [9]).astype(np.uint64)
    assert runs.runs_of(falling, np.array([0, n + 3])).tolist() == [[1, n + 1, 1]]
    assert runs.runs_of(same, np.array([0, n // 2, n])).tolist() == [[0, n // 2, 1], [n // 2, n // 2, 1]]


def test_documents(spark):
    row = "a b C"
    rows = [
        (1, " ".join([row] * 5) + " end", 1),
        (1, " ".join([row] * 5) + " end", 1),
        (2, "\t" + "\n".join([row, "a b c"] * 4), 2),
        (3, None, 3),
        (None, " \n", 4),
        (4, "x " * 50_000, 5),
        (5, "é é " * 6, 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = runs.find_runs(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [tuple(r) for r in by_id[1].runs] == [(0, 15, 3)] and by_id[1].collapsed == "a b C end"
    assert [tuple(r) for r in by_id[2].runs] == [(0, 24, 6)] and by_id[2].collapsed == "a b C a b c"
    assert by_id[3].n_words == 0 and by_id[3].runs == [] and by_id[None].collapsed == ""
    assert [tuple(r) for r in by_id[4].runs] == [(0, 50_000, 1)] and by_id[4].collapsed == "x"
    assert by_id[5].collapsed == "é"
    moved = runs.find_runs(docs, order=lambda doc_id, n: np.zeros(n, int) if doc_id == 1 else None).collect()
    assert {r.collapsed for r in moved if r.doc_id == 1} == {"a"}
    assert runs.find_runs(docs.limit(0)).count() == 0
