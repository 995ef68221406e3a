"""FTRL-proximal against a version with dictionaries, and its ranking of texts it has not learned."""

import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(texts, labels, epochs):
    """One coordinate after the other, as published."""
    z, n = {}, {}

    def weight(i):
        if i not in z:
            return 0.0
        least = 0.0 if i == toxicity.BIAS else toxicity.L1
        if abs(z[i]) <= least:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2
        return -(z[i] - math.copysign(least, z[i])) / rate

    for _ in range(epochs):
        for own, label in zip(texts, labels, strict=True):
            w = {i: weight(i) for i in [toxicity.BIAS, *own]}
            gradient = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in w:
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + gradient**2) - math.sqrt(before)) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + gradient - sigma * w[i]
                n[i] = before + gradient**2
    return {i: weight(i) for i in z if weight(i)}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_ftrl(seed):
    r = random.Random(seed)
    labels = [r.randrange(2) for _ in range(120)]
    texts = [sorted(r.sample(range(1, 40), r.randint(0, 8)) + ([50] if y and r.random() < 0.8 else [])) for y in labels]
    got = toxicity.learn([np.array(t, np.int64) for t in texts], np.array(labels), 3)
    want = plain(texts, labels, 3)
    assert {int(i): got[i] for i in np.flatnonzero(got)} == pytest.approx(want)
    assert 0 < len(want) < 41  # sparse


def test_ranks_texts_it_has_not_learned(spark):
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES["op4_toxicity"](spark, FOLDER).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    toxic, other = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert len(toxic) > 1 and len(other) > 20
    area = (toxic[:, None] > other[None, :]).mean() + 0.5 * (toxic[:, None] == other[None, :]).mean()
    assert area > 0.9
