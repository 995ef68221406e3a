"""The bounded search against the full table of products."""

import numpy as np
import pytest

from millrace.operators import inner_product as I


def plain(users, items, k):
    """All products, summed element by element."""
    out = {}
    for u, v in users:
        scored = []
        for i, w in items:
            total = 0.0
            for a, b in zip(v, w, strict=True):
                total += a * b
            scored.append((-total, i))
        out[u] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, features array<float>").repartition(3)


def as_floats(r, n, rank, skew):
    v = (r.normal(size=(n, rank)) * (1 + np.arange(n)[:, None] % 7 if skew else 1)).astype(np.float32)
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("seed, k, sizes", [(1, 5, {"first": 4, "most": 16, "batch": 7}), (2, 1, {"first": 8, "most": 8}), (3, 400, {})])
def test_equals_all_products(spark, seed, k, sizes):
    r = np.random.default_rng(seed)
    users, items = as_floats(r, 60, 5, False), as_floats(r, 150, 5, True)
    items += [(1000 + i, v) for i, v in items[:20]]  # ties
    users += [(500, [0.0] * 5)]
    best, work = I.top_inner_products(frame(spark, users), frame(spark, items), k, **sizes)
    got = {}
    for row in best.orderBy("user", "position").collect():
        assert row.position == len(got.setdefault(row.user, []))
        got[row.user].append((row.item, row.score))
    assert got == plain(users, items, k)
    done = work.orderBy("block").collect()
    assert [w.block for w in done] == list(range(len(done))) and done[0].n_users == 61
    assert all(w.n_pairs == w.n_users * w.n_items for w in done)


def test_blocks_double_up_to_their_full_size(spark):
    items = [(i, [1.0 / (1 + i)]) for i in range(100)]
    blocks = I.item_blocks(frame(spark, items), "id", "features", 4, 16).orderBy("block").collect()
    assert [b.n for b in blocks] == [4, 8, 16, 16, 16, 16, 16, 8]
    assert [b.top for b in blocks] == sorted((b.top for b in blocks), reverse=True)


def test_few_pairs_where_lengths_differ(spark):
    """Most users are done long before the short items; what is left of a batch goes on without them."""
    r = np.random.default_rng(5)
    users = [(i, np.abs(r.normal(size=4)).astype(np.float32).tolist()) for i in range(300)]
    items = [(i, (np.abs(r.normal(size=4)) * 0.97**i).astype(np.float32).tolist()) for i in range(600)]
    best, work = I.top_inner_products(frame(spark, users), frame(spark, items), 3, first=16, most=64, batch=50)
    assert best.count() == 900
    assert sum(w.n_pairs for w in work.collect()) < 0.3 * 300 * 600


def test_missing_and_unusable_vectors(spark):
    users = [(1, [1.0, 0.0]), (2, None), (None, [1.0, 1.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0])]
    items = [(7, [2.0, 1.0]), (8, [float("inf"), 1.0]), (9, None)]
    best, _ = I.top_inner_products(frame(spark, users), frame(spark, items), 2)
    assert [tuple(r) for r in best.collect()] == [(1, 0, 7, 2.0)]
    nobody, none = frame(spark, users[1:2]), frame(spark, items[2:])
    assert I.top_inner_products(nobody, frame(spark, items), 2)[0].count() == 0
    best, work = I.top_inner_products(frame(spark, users), none, 2)
    assert best.count() == 0 and work.count() == 0


def _directed(r, n, directions, spread):
    turned = directions[np.arange(n) % len(directions)]
    return turned * r.uniform(0.8, 1.0, (n, 1)) + spread * r.normal(size=turned.shape)


@pytest.mark.parametrize("k", [3, 200])
def test_cells_leave_out_products_but_no_item(k):
    """Items in few directions: a user multiplies the cells near its own one, and gets what all products give."""
    r = np.random.default_rng(7)
    directions = r.normal(size=(40, 8))
    v, w = _directed(r, 120, directions, 1e-3), _directed(r, 2000, directions, 1e-3)
    ids = r.permutation(2000)
    near, cells = I.near_cells(w, 25)
    assert sorted(near) == list(range(2000)) and cells[0] == 0 and 0 < np.diff([*cells, 2000]).max() <= 25
    none = np.full((120, k), -1), np.full((120, k), -np.inf)
    best, scores, n_products = I.best_of(v, ids[near], w[near], cells, *none, k)
    expected = plain(list(enumerate(v)), list(zip(ids, w, strict=True)), k)
    assert [list(zip(best[u], scores[u], strict=True)) for u in range(120)] == [expected[u] for u in range(120)]
    following = I.best_of(v, ids[near] + 2000, w[near] * 0.9, cells, best, scores, k)
    expected = plain(list(enumerate(v)), [*zip(ids, w, strict=True), *zip(ids + 2000, w * 0.9, strict=True)], k)
    assert [list(zip(*x, strict=True)) for x in zip(following[0], following[1], strict=True)] == list(expected.values())
    if k == 3:
        assert n_products < 0.7 * 120 * 2000 and following[2] < 0.3 * 120 * 2000


def test_cells_of_equal_and_huge_items():
    w = np.concatenate([np.ones((300, 2)), np.full((2, 2), 1e200), np.zeros((5, 2))])
    near, cells = I.near_cells(w, 50)
    ids = np.arange(len(w))
    none = np.full((2, 4), -1), np.full((2, 4), -np.inf)
    best, scores, _ = I.best_of(np.array([[1.0, 1.0], [0.0, 0.0]]), ids[near], w[near], cells, *none, 4)
    assert best.tolist() == [[300, 301, 0, 1], [0, 1, 2, 3]] and scores[0].tolist() == [2e200, 2e200, 2.0, 2.0]
