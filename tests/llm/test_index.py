"""Phrases and proximity in an index of several segments, in several blocks, against a plain search."""

import random
from collections import Counter

import pytest

from millrace.llm import decontam


def plain(texts, items, n, slop):
    """(document, item) with the words covered: exact windows, or all words of one within ``slop`` further places."""
    out = {}
    for doc, text in texts:
        words = text.split()
        for item, phrase in items:
            own = phrase.split()
            windows = [own[i : i + n] for i in range(max(len(own) - n + 1, 1 if own else 0))]
            hit = set()
            for window in windows:
                reach = len(window) + slop
                for at in range(len(words)):
                    there = words[at : at + reach]
                    if slop == 0 and there == window:
                        hit.update(range(at, at + reach))
                    elif slop and there and there[0] in window and not Counter(window) - Counter(there):
                        hit.update(range(at, min(at + reach, len(words))))
            if hit:
                out[doc, item] = hit
    return out


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_equals_plain_search(spark, slop):
    r = random.Random(slop)
    texts = [(i, " ".join(r.choices("abcde", k=r.randint(0, 30)))) for i in range(60)]
    items = [(i, " ".join(r.choices("abcde", k=r.randint(0, 7)))) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    index = decontam.build_index(docs, segment_words=40)
    assert index.count() > 20
    phrases = decontam.phrases_of(spark.createDataFrame(items, "item_id long, text string"), 4)
    for block_words in (decontam.BLOCK_WORDS, 20):
        found = {}
        for row in decontam.find_phrases(index, phrases, slop, block_words).collect():
            for span in row.spans:
                found.setdefault((row.doc_id, row.item_id), set()).update(range(span.start, span.end))
        assert found == plain(texts, items, 4, slop)


def test_no_phrase_goes_through_the_driver(spark, monkeypatch):
    """The driver reads how many words there are, and no more."""
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    index, seen = decontam.build_index(docs), []
    phrases = decontam.phrases_of(spark.createDataFrame([(1, "b c")], "item_id long, text string"), 2)
    frame = type(docs)
    for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(frame, name, lambda self, *a, name=name, own=getattr(frame, name): seen.append((name, len(self.columns))) or own(self, *a))
    found = decontam.find_phrases(index, phrases)
    monkeypatch.undo()
    assert found.count() == 1 and all(columns == 1 for _, columns in seen)
