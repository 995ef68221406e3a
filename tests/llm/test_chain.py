"""The chain of the language model against an enumeration of all labelings, and its memory."""

import itertools
import random

import numpy as np
import pytest

from millrace.llm import langid


def enumerated(emit, moves, start):
    """Marginals of each step and the expected moves of one chain, from all labelings."""
    n, k = emit.shape
    marginal, joint, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for labels in itertools.product(range(k), repeat=n):
        weight = start[labels[0]] * emit[0, labels[0]]
        for t in range(1, n):
            weight *= moves[labels[t - 1], labels[t]] * emit[t, labels[t]]
        total += weight
        for t, label in enumerate(labels):
            marginal[t, label] += weight
        for a, b in itertools.pairwise(labels):
            joint[a, b] += weight
    return marginal / total, joint / total, total


@pytest.mark.parametrize("k", [1, 2, 3])
def test_forward_backward_equals_all_labelings(k):
    r = np.random.default_rng(k)
    lengths = [6, 5, 5, 3, 1]
    emit = np.ones((6, len(lengths), k))
    for c, n in enumerate(lengths):
        emit[:n, c] = np.exp(r.normal(size=(n, k)))
    moves, start = np.exp(r.normal(size=(k, k))), np.exp(r.normal(size=k))
    active = np.array([sum(n > t for n in lengths) for t in range(6)])
    marginal, ahead, back = langid.forward_backward(emit, moves, start, active)
    expected = np.zeros((k, k))
    for c, n in enumerate(lengths):
        want, joint, _ = enumerated(emit[:n, c], moves, start)
        assert marginal[:n, c] == pytest.approx(want)
        expected += joint
    assert moves * langid._moves_expected(emit, moves, ahead, back, active) == pytest.approx(expected)


def test_expected_counts_are_the_gradient():
    """The gradient of the log-likelihood in the moves and the start equals a finite difference."""
    r = np.random.default_rng(9)
    k, n = 3, 5
    emit, truth = np.exp(r.normal(size=(n, k))), [0, 2, 2, 1, 0]
    moves, start = r.normal(size=(k, k)), r.normal(size=k)

    def likelihood(moves, start):
        path = start[truth[0]] + sum(np.log(emit[t, y]) for t, y in enumerate(truth))
        path += sum(moves[a, b] for a, b in itertools.pairwise(truth))
        return path - np.log(enumerated(emit, np.exp(moves), np.exp(start))[2])

    active = np.ones(n, int)
    marginal, ahead, back = langid.forward_backward(emit[:, None], np.exp(moves), np.exp(start), active)
    seen = np.zeros((k, k))
    for a, b in itertools.pairwise(truth):
        seen[a, b] += 1
    gradient = seen - np.exp(moves) * langid._moves_expected(emit[:, None], np.exp(moves), ahead, back, active)
    step = 1e-6
    for a in range(k):
        shift = np.eye(k)[a] * step
        slope = (likelihood(moves, start + shift) - likelihood(moves, start - shift)) / (2 * step)
        assert (np.eye(k)[truth[0]] - marginal[0, 0])[a] == pytest.approx(slope, abs=1e-6)
        for b in range(k):
            shift = np.zeros((k, k))
            shift[a, b] = step
            slope = (likelihood(moves + shift, start) - likelihood(moves - shift, start)) / (2 * step)
            assert gradient[a, b] == pytest.approx(slope, abs=1e-6)


def test_twenty_languages(spark):
    """Each with words of its own; the fit is one task, whose memory the labels must not square."""
    r = random.Random(1)
    rows = []
    for lang in range(20):
        own = ["".join(r.choices("abcdefghijklmnopqrst", k=r.randint(2, 7))) for _ in range(60)]
        rows += [(lang * 100 + i, " ".join(r.choices(own, k=60)), f"l{lang:02}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.fit(docs)).join(docs, "doc_id").collect()
    assert np.mean([g.lang == g.lang_pred for g in got]) > 0.95


def test_memory_of_the_fit_in_twenty_languages():
    """Peak memory of learning, in a process of its own."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from millrace.llm import langid
langid.STEPS = 1
r = np.random.default_rng(0)
chains = r.integers(0, 20000, (64, 5105)); truth = r.integers(0, 20, chains.shape)
feats = r.integers(0, langid.BUCKETS, (20000, 40)).astype(np.int32)
langid.learn(chains, truth, feats, [str(i) for i in range(20)])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(found.stdout) < 1000
