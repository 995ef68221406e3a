"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language. A word's features are itself, the first and last
one to three letters and its letter pairs and triples, hashed into ``BUCKETS``; learned
transitions say how readily a text goes from one language into another. Forward-backward
gives each word a probability per language, also in code-switched text; a document's
language is the one with the largest sum, its score that sum's share.

Learning takes about ``PER_LANGUAGE`` whole documents of each language, drawn by a hash of
the id at a rate found from counts over all documents. Their words are cut into runs, and
runs of other documents and languages follow one another, so that switches are learned.
It is done in one task, by gradient steps over all runs. Labelling reads every whole text.

Words are maximal runs of ASCII letters and characters beyond ASCII that hold at least one
letter. A run of more than ``LONGEST`` code points, as of text without blanks, is cut evenly into
parts of at most ``PART``, each a word of the chain, so that it counts by its length. The parts
cover the whole run: a part's features see the code points next to it, the first part has the
first letters and the last part the last ones; one without a letter is no word. Defined results: a text that is null or has no letter is ``und`` with score 0; so is
everything when no labelled document is there to learn from. A null id isn't held out and
doesn't teach. Ties go to the language first in order. Other columns are ignored by
``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import LETTERS, Words, gives_back, mix, pieces, split_words, string_array

BUCKETS = 1 << 17
PER_LANGUAGE = 200
RUN, MIXED = 64, 8  # words of a chain in learning; the shortest run of one language in it
STEPS, RATE, DECAY = 40, 0.25, 1e-6
LONGEST, PART = 24, 8  # code points of a word that stays whole, and of the parts of a longer one
TEXT_BYTES = 1 << 19  # of text whose words are held at once
FEATURED = 1 << 14  # distinct words whose features are held at once in labelling
CHAIN_SCORES = 1 << 20  # scores (words, padding included, times labels) that go through the chain together
GATHERED_SCORES = 1 << 21  # scores gathered before their words are labelled

PREDICTION_SCHEMA = "doc_id long, lang_pred string, score double"
UNKNOWN = "und"
BEFORE, AFTER = "\x02", "\x03"  # marks at the ends of a word


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    moves: np.ndarray  # labels x labels
    start: np.ndarray


# Features ------------------------------------------------------------------------------


def _parts(word: str) -> list[str]:
    """The word or, if it is longer than LONGEST, its parts, between the code points or marks beside them."""
    n = len(word)
    count = -(-n // PART) if n > LONGEST else 1
    cuts = [n * i // count for i in range(count + 1)]
    framed = BEFORE + word + AFTER
    spans = zip(cuts[:-1], cuts[1:], strict=True)
    return [framed[low : high + 2] for low, high in spans if any(c.isalpha() for c in word[low:high])]


def features(parts: list[str]) -> np.ndarray:
    """A row of hashed features for each part of a word; 0 fills the rows."""
    codes = np.array(parts, f"U{LONGEST + 2}").view(np.uint32).reshape(len(parts), LONGEST + 2)
    codes = np.pad(codes.astype(np.uint64), ((0, 0), (0, 1)))
    length = (codes > 0).sum(axis=1) - 2
    rows = np.arange(len(parts))
    begins, ends = codes[:, 0] == ord(BEFORE), codes[rows, length + 1] == ord(AFTER)
    base = np.uint64(0x100000001B3)

    def hashed(parts: list[np.ndarray], kind: int) -> np.ndarray:
        h = np.full(parts[0].shape, kind, np.uint64)
        for part in parts:
            h = (h + part) * base
        return (mix(h) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1

    columns = [hashed([codes[:, k] for k in range(codes.shape[1])], 1)[:, None]]  # the word itself
    for k in (1, 2, 3):  # affixes, where the word is as long
        there = length >= k
        first = hashed([codes[:, 1 + i] for i in range(k)], 10 + k)
        last = hashed([codes[rows, np.maximum(length - k + 1 + i, 0)] for i in range(k)], 20 + k)
        columns += [np.where(there & begins, first, 0)[:, None], np.where(there & ends, last, 0)[:, None]]
    for k in (2, 3):  # letter pairs and triples, marks included
        wide = codes.shape[1] - k + 1
        grams = hashed([codes[:, i : i + wide] for i in range(k)], 30 + k)
        columns.append(np.where(np.arange(wide)[None, :] + k <= length[:, None] + 2, grams, 0))
    out = np.concatenate(columns, axis=1)
    used = (out > 0).any(axis=0)
    return out[:, used] if len(parts) else out


def _lexicon(words: Words) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """For each part of the words its number among the distinct ones, the bounds of the texts in them, the distinct ones."""
    codes, distinct = pd.factorize(words.hashes)
    firsts = np.empty(len(distinct), np.int64)
    firsts[codes[::-1]] = np.arange(len(codes))[::-1]  # the first place is written last
    data = words.data.tobytes()
    texts = (data[words.starts[i] : words.ends[i]].decode("utf-8", "replace").lower() for i in firsts)
    known: dict[str, int] = {}
    own = [[known.setdefault(part, len(known)) for part in _parts(text)] for text in texts]
    counts = np.array([len(numbers) for numbers in own], np.int64)
    flat = np.fromiter(chain.from_iterable(own), np.int64)
    each = counts[codes] if len(codes) else counts
    ends = np.cumsum(each)
    begins = (np.cumsum(counts) - counts)[codes] if len(codes) else counts
    numbers = flat[np.arange(int(each.sum())) + np.repeat(begins - (ends - each), each)] if len(flat) else flat
    return numbers, np.append(0, ends)[words.bounds], list(known)


# The chain -----------------------------------------------------------------------------


def _exp(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def forward_backward(emit: np.ndarray, moves: np.ndarray, start: np.ndarray, active: np.ndarray):
    """Label probabilities of chains that are padded to one length.

    ``emit`` is (steps, chains, labels) in exponentials, ``active[t]`` the number of chains
    that reach step t, longest chain first. Also the forward and backward messages.
    """
    steps = len(active)
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    for t in range(steps):
        n = active[t]
        now = emit[t, :n] * (start if t == 0 else ahead[t - 1, :n] @ moves)
        ahead[t, :n] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 1, -1, -1):
        n, more = active[t], active[t + 1] if t + 1 < steps else 0
        back[t, more:n] = 1.0
        if more:
            now = (emit[t + 1, :more] * back[t + 1, :more]) @ moves.T
            back[t, :more] = now / now.sum(axis=1, keepdims=True)
    both = ahead * back
    total = both.sum(axis=2, keepdims=True)
    return both / np.where(total > 0, total, 1), ahead, back


def _moves_expected(emit: np.ndarray, moves: np.ndarray, ahead: np.ndarray, back: np.ndarray, active: np.ndarray) -> np.ndarray:
    """The expected number of each move, divided by its weight; step by step, so that nothing has labels x labels for a word."""
    total = np.zeros_like(moves)
    for t in range(len(active) - 1):
        n = active[t + 1]
        behind = emit[t + 1, :n] * back[t + 1, :n]
        here = ahead[t, :n]
        total += (here / ((here @ moves) * behind).sum(axis=1, keepdims=True)).T @ behind
    return total


def learn(chains: np.ndarray, truth: np.ndarray, feats: np.ndarray, labels: list[str]) -> Model:
    """Fit to chains of word numbers (steps x chains) and their labels, by Adagrad steps over all of them.

    ``feats`` has the features of each word number; -1 pads the end of a chain.
    """
    k = len(labels)
    weights, moves, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    sums = [np.full_like(x, 1e-8) for x in (weights, moves, start)]
    order = np.argsort(-(chains >= 0).sum(axis=0), kind="stable")
    chains, truth = chains[:, order], truth[:, order]
    there = chains >= 0
    active = there.sum(axis=1)
    words = chains[there]
    target = np.eye(k)[truth[there]]
    pairs = there[1:] & there[:-1]
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:-1][pairs], truth[1:][pairs]), 1)
    for _ in range(STEPS):
        weights[0] = 0.0  # fills the rows of features
        per_word = np.zeros((len(feats), k))
        for column in feats.T:
            per_word += weights[column]
        emit = np.ones((*chains.shape, k))
        emit[there] = _exp(per_word)[words]
        go, first = np.exp(moves), np.exp(start)
        marginal, ahead, back = forward_backward(emit, go, first, active)
        missing = target - marginal[there]
        by_word = np.stack([np.bincount(words, missing[:, j], len(feats)) for j in range(k)], axis=1)
        grad_w = np.zeros((BUCKETS, k))
        for j in range(k):
            for column in feats.T:
                grad_w[:, j] += np.bincount(column, by_word[:, j], BUCKETS)
        grad_m = seen - go * _moves_expected(emit, go, ahead, back, active)
        grad_s = (np.eye(k)[truth[0]] - marginal[0]).sum(axis=0)
        for value, grad, total in zip((weights, moves, start), (grad_w, grad_m, grad_s), sums, strict=True):
            grad = grad - DECAY * len(words) * value
            total += grad * grad
            value += RATE * grad / np.sqrt(total)
    weights[0] = 0.0
    return Model(labels, weights, moves, start)


def _training_chains(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Chains of RUN words out of runs of MIXED to RUN words, those of all documents shuffled."""
    lexicon: dict[str, int] = {}
    runs: list[tuple[np.ndarray, str]] = []
    draw = np.random.default_rng(7)
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for low, piece in pieces(string_array(batch.column(0)), TEXT_BYTES):
            words = split_words(piece, LETTERS)
            own, bounds, distinct = _lexicon(words)
            known = np.array([lexicon.setdefault(w, len(lexicon)) for w in distinct], np.int64)
            numbers = known[own]
            for i in range(len(piece)):
                text = numbers[bounds[i] : bounds[i + 1]]
                at = 0
                while at < len(text):
                    size = int(draw.integers(MIXED, RUN + 1))
                    runs.append((text[at : at + size], langs[low + i]))
                    at += size
    labels = sorted({lang for _, lang in runs})
    if not runs:
        return np.zeros((RUN, 0), np.int64), np.zeros((RUN, 0), np.int64), np.zeros((0, 1), np.int32), labels
    number = {lang: i for i, lang in enumerate(labels)}
    order = draw.permutation(len(runs))
    words = np.concatenate([runs[i][0] for i in order])
    truth = np.concatenate([np.full(len(runs[i][0]), number[runs[i][1]]) for i in order])
    n = -(-len(words) // RUN)
    chains, target = np.full(n * RUN, -1), np.zeros(n * RUN, np.int64)
    chains[: len(words)], target[: len(words)] = words, truth
    return chains.reshape(n, RUN).T, target.reshape(n, RUN).T, features(list(lexicon)), labels


@gives_back
def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chains, truth, feats, labels = _training_chains(batches)
    k = len(labels)
    if k:
        model = learn(chains, truth, feats, labels)
    else:
        model = Model([], np.zeros((1, 0)), np.zeros((0, 0)), np.zeros(0))
    kept = np.flatnonzero(model.weights.any(axis=1))
    parts = {
        "labels": json.dumps(labels).encode(),
        "kept": kept.astype(np.int32).tobytes(),
        "weights": model.weights[kept].astype(np.float32).tobytes(),
        "moves": model.moves.tobytes(),
        "start": model.start.tobytes(),
    }
    yield pa.RecordBatch.from_pydict({"part": list(parts), "value": pa.array(list(parts.values()), pa.binary())})


def fit(docs: DataFrame, teaches: Column | None = None) -> Model:
    """Learn from (doc_id, text, lang) of the documents for which ``teaches`` holds."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL")
    if teaches is not None:
        known = known.where(teaches)
    counts = known.groupBy("lang").count().collect()
    known = known.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.lit(0.0)
    for row in counts:
        rate = F.when(F.col("lang") == row["lang"], PER_LANGUAGE / row["count"]).otherwise(rate)
    sample = known.where(draw < rate).withColumn("turn", draw)
    sample = sample.repartition(1).sortWithinPartitions("turn", "doc_id", F.xxhash64("text")).select("text", "lang")
    parts = {r["part"]: bytes(r["value"]) for r in sample.mapInArrow(_fit, "part string, value binary").collect()}
    labels = json.loads(parts["labels"]) if parts else []
    k = len(labels)
    weights = np.zeros((BUCKETS, k), np.float32)
    if k:
        weights[np.frombuffer(parts["kept"], np.int32)] = np.frombuffer(parts["weights"], np.float32).reshape(-1, k)
    moves = np.frombuffer(parts["moves"]).reshape(k, k) if k else np.zeros((0, 0))
    return Model(labels, weights, moves, np.frombuffer(parts["start"]) if k else np.zeros(0))


# Labelling -----------------------------------------------------------------------------


def _shares(emit: np.ndarray, owner: np.ndarray, n_texts: int, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per text the sum of its words' label probabilities. ``emit``: words x labels, ``owner``: their texts."""
    k = len(start)
    out = np.zeros((n_texts, k))
    counts = np.bincount(owner, minlength=n_texts)
    firsts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    low = 0
    while low < len(order):  # texts of like length together, CHAIN_SCORES with padding at most
        longest = counts[order[low]]
        high = min(len(order), low + max(1, CHAIN_SCORES // (k * int(longest))))
        texts = order[low:high]
        steps = np.arange(longest)
        active = np.searchsorted(-counts[texts], -steps, "left")
        there = steps[:, None] < counts[texts][None, :]
        padded = np.ones((longest, len(texts), k), np.float32)
        padded[there] = emit[(firsts[texts][None, :] + steps[:, None])[there]]
        out[texts] = forward_backward(padded, moves, start, active)[0].sum(axis=0)
        low = high
    return out


def _emissions(piece: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The exponential scores of the words of a piece, and the text of each."""
    words = split_words(piece, LETTERS)
    numbers, bounds, distinct = _lexicon(words)
    if not distinct:
        return np.zeros((0, len(model.labels)), np.float32), np.zeros(0, np.int32)
    emit = np.zeros((len(distinct), len(model.labels)), np.float32)
    for low in range(0, len(distinct), FEATURED):
        for column in features(distinct[low : low + FEATURED]).T:
            emit[low : low + FEATURED] += model.weights[column]
    owner = np.repeat(np.arange(len(piece), dtype=np.int32), np.diff(bounds))
    return _exp(emit)[numbers], owner


def _predict(batches: Iterator[pa.RecordBatch], model: Model, at: int) -> Iterator[tuple[pa.RecordBatch, list, np.ndarray]]:
    """Each batch with the language and the score of its texts, which are in column ``at``."""
    moves, start = np.exp(model.moves).astype(np.float32), np.exp(model.start).astype(np.float32)
    names = np.array([*model.labels, UNKNOWN], object)
    for batch in batches:
        shares = np.zeros((batch.num_rows, max(1, len(model.labels))))
        emits, owners, first, held = [], [], 0, 0
        for low, piece in pieces(string_array(batch.column(at)), TEXT_BYTES) if model.labels else ():
            emit, owner = _emissions(piece, model)
            emits.append(emit)
            owners.append(owner + (low - first))
            held += len(emit)
            end = low + len(piece)
            if held * len(model.labels) >= GATHERED_SCORES or end == batch.num_rows:
                shares[first:end] = _shares(np.concatenate(emits), np.concatenate(owners), end - first, moves, start)
                emits, owners, first, held = [], [], end, 0
        total = shares.sum(axis=1)
        best = np.where(total > 0, shares.argmax(axis=1), -1)
        yield batch, names[best].tolist(), shares.max(axis=1) / np.where(total > 0, total, 1)


@gives_back
def _rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch, languages, scores in _predict(batches, model, 1):
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "lang_pred": pa.array(languages, pa.string()), "score": scores.astype(float)}
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_rows, model=model), PREDICTION_SCHEMA)


@gives_back
def _known(batches: Iterator[pa.RecordBatch], model: Model, at: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch, languages, scores in _predict(batches, model, at):
        keep = (np.array(languages, object) != UNKNOWN) & (scores >= least)
        yield batch.filter(pa.array(keep.astype(bool)))


def keep_known(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The documents in a language that the model knows, one of at least ``least`` of their words, with all columns."""
    at = docs.columns.index("text")
    return docs.mapInArrow(partial(_known, model=model, at=at, least=least), docs.schema)
