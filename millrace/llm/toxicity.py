"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a text are its distinct words and their stems (the first four and five
bytes), word pairs, pairs with one word between, and triples, hashed into ``BUCKETS``. The learner sees one labelled text after the other
and keeps two sums per coordinate, so that each coordinate has its own learning rate and
L1 leaves only the weights that earn their keep; those are all that is broadcast.

Learning takes a sample of about ``POSITIVES`` toxic and ``NEGATIVES`` other texts, drawn
by a hash of the id at a rate found from counts over all labels, whole texts each; it is
learned in one task, since each step needs the one before. The logarithm of the two rates' ratio
is added to the bias, so that scores mean the share among all labels, not in the sample, at any
size. Scoring reads every whole text.

Defined results: a null or empty text has the score of no features at all. A null id is
not held out and has no label. Ids that repeat in the labels are toxic if one row says so;
null labels and other values than 0 and 1 don't teach. Without texts of both kinds every
score is the share of toxic ones among those there are, or 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import ALNUM, Words, mix, pieces, split_words, string_array

BUCKETS = 1 << 20
POSITIVES, NEGATIVES = 3000, 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1.0, 0.1
BIAS = 0  # this coordinate is in every text and free of L1

WEIGHT_SCHEMA = "coordinate int, weight double"
_SALTS = [np.uint64(x) for x in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F)]
STEMS = (4, 5)


def _grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Coordinates of all n-grams of each kind, with the text of each."""
    h = words.hashes
    text = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))

    def bucket(values: np.ndarray) -> np.ndarray:
        return (mix(values) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1

    yield bucket(h), text
    stem = np.zeros(len(h), np.uint64)
    for k in range(max(STEMS)):
        there = words.starts + k < words.ends
        byte = ALNUM[words.data[np.where(there, words.starts + k, 0)]] if len(h) else stem
        stem = (stem + np.where(there, byte, 0).astype(np.uint64)) * _SALTS[2]
        if k + 1 in STEMS:
            yield bucket(stem + np.uint64(k)), text
    for k, salt in ((1, _SALTS[0]), (2, _SALTS[1])):  # neighbours, and those with one word between
        same = text[:-k] == text[k:]
        yield bucket(h[:-k] * salt + h[k:])[same], text[k:][same]
    same = text[:-2] == text[2:]
    yield bucket((h[:-2] * _SALTS[2] + h[1:-1]) * _SALTS[0] + h[2:])[same], text[2:][same]


def _features(words: Words) -> list[np.ndarray]:
    """The distinct coordinates of each text, without the bias."""
    found = list(_grams(words))
    coordinates, text = np.concatenate([c for c, _ in found]), np.concatenate([t for _, t in found])
    keys = np.unique(text * np.int64(BUCKETS) + coordinates)
    bounds = np.searchsorted(keys, np.arange(len(words.bounds)) * np.int64(BUCKETS))
    keys = keys % BUCKETS
    return [keys[low:high] for low, high in zip(bounds[:-1], bounds[1:], strict=True)]


def learn(features: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """The weights after some passes of FTRL-proximal over the texts in their order."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    l1 = np.full(BUCKETS, L1)
    l1[BIAS] = 0.0

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * l1[at] - z[at]
        return np.where(np.abs(z[at]) <= l1[at], 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    with_bias = [np.append(BIAS, own) for own in features]
    for _ in range(epochs):
        for at, label in zip(with_bias, labels, strict=True):
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(np.arange(BUCKETS))


def _fit(batches: Iterator[pa.RecordBatch], prior: float) -> Iterator[pa.RecordBatch]:
    features: list[np.ndarray] = []
    labels: list[np.ndarray] = []
    for batch in batches:
        for _, piece in pieces(string_array(batch.column(0))):
            features += _features(split_words(piece, ALNUM))
        labels.append(batch.column(1).to_numpy())
    y = np.concatenate(labels) if labels else np.zeros(0)
    if 0 < y.sum() < len(y):
        w = learn(features, y)
        w[BIAS] += prior
    else:  # nothing to tell apart
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9))
        w = np.zeros(1)
        w[BIAS] = np.log(share / (1 - share))
    kept = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(kept.astype(np.int32)), pa.array(w[kept])], schema=pa.schema([("coordinate", pa.int32()), ("weight", pa.float64())])
    )


def fit(docs: DataFrame, labels: DataFrame, teaches: Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights, learned from (doc_id, text) and (doc_id, toxic).

    ``teaches`` is a condition on doc_id.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if teaches is not None:
        known = known.where(teaches)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic_rate, other_rate = POSITIVES / max(1, counts.get(1, 0)), NEGATIVES / max(1, counts.get(0, 0))
    rate = F.when(F.col("toxic") == 1, toxic_rate).otherwise(other_rate)
    prior = float(np.log(min(1.0, other_rate) / min(1.0, toxic_rate)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Both kinds are spread over all turns, or the one of the higher rate would fill the last ones alone.
    sample = known.where(draw < rate).withColumn("turn", draw / F.least(rate, F.lit(1.0)))
    # About POSITIVES + NEGATIVES rows of 16 bytes, whatever the size of the labels.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    texts = texts.repartition(1).sortWithinPartitions("turn", "doc_id", F.xxhash64("text")).select("text", "toxic")
    rows = texts.mapInArrow(partial(_fit, prior=prior), WEIGHT_SCHEMA).collect()
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)


def _score(batches: Iterator[pa.RecordBatch], coordinates: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    weight = np.zeros(BUCKETS)
    weight[coordinates] = weights
    heavy = weight != 0
    for batch in batches:
        scores = np.full(batch.num_rows, weight[BIAS])
        for low, piece in pieces(string_array(batch.column(1))):
            hits = []
            for at, text in _grams(split_words(piece, ALNUM)):
                counted = heavy[at]
                hits.append(text[counted] * np.int64(BUCKETS) + at[counted])
            keys = np.unique(np.concatenate(hits))
            scores[low : low + len(piece)] += np.bincount(keys // BUCKETS, weight[keys % BUCKETS], len(piece))
        values = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values)], schema=pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        )


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, score) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    coordinates, weights = model
    return rows.mapInArrow(partial(_score, coordinates=coordinates, weights=weights), "doc_id long, score double")
