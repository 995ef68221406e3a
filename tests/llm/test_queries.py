"""Every operator's query against its SQL, or against a plain version."""

import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from millrace.llm.queries import QUERIES
from tests import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_equals_sql(spark, name):
    assert oracle.compare(oracle.connect(FOLDER), QUERIES[name](spark, FOLDER), QUERIES[name].sql) is None


def test_language_on_held_out_documents(spark, docs):
    got = QUERIES["op2_language"](spark, FOLDER).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out & got.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_toxicity_on_learned_and_held_out_documents(spark, docs):
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES["op4_toxicity"](spark, FOLDER).toPandas()
    assert len(got) == len(docs) and (got.predicted == (got.score >= 0.5)).all()
    learned = got[~got.held_out].merge(labels, on="doc_id")
    assert (learned.predicted == learned.toxic).mean() > 0.95


def test_token_store_equals_the_tokenizer(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = QUERIES["op9_token_store"](spark, FOLDER).toPandas().set_index("doc_id")
    start = 0
    for row in docs.sort_values("doc_id").itertuples():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2]
        own = got.loc[row.doc_id]
        assert (own.start, own.n_tokens, own.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_packing_equals_a_plain_search(spark, docs):
    """One shard: each piece, longest first, goes into the tightest bin that it doesn't conflict with."""
    got = QUERIES["op6_packing"](spark, FOLDER).toPandas()
    source = docs.set_index("doc_id").source
    text = docs.set_index("doc_id").text.fillna("").str.lower().str.split().str.join(" ")
    placed = got[got.n_words > 0].sort_values(["n_words", "doc_id", "piece"], ascending=[False, True, True])
    bins: list[list] = []
    for row in placed.itertuples():
        fits = [
            b for b in bins
            if b[0] >= row.n_words and source[row.doc_id] not in b[2] and text[row.doc_id] not in b[3]
        ]
        if fits:
            best = min(fits, key=lambda b: (b[0], b[1]))
        else:
            best = [2048, len(bins), set(), set()]
            bins.append(best)
        assert row.bin == best[1] and row.position == 2048 - best[0]
        best[0] -= row.n_words
        best[2].add(source[row.doc_id])
        best[3].add(text[row.doc_id])
    words = docs.text.fillna("").str.split().str.len()
    assert got.groupby("doc_id").n_words.sum().sort_index().tolist() == words[docs.doc_id.argsort()].tolist()


def test_pipeline_equals_the_operators(spark, docs):
    """The stages' decisions, one after the other, from the queries' plain rules."""
    frame, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, FOLDER).toPandas(), frame.schema)
        kept.append({r.doc_id for r in frame.select("doc_id").collect()})
    language, exact, near, clean = kept
    has_letter = docs.text.fillna("").map(lambda t: any(c.isalpha() for c in t))
    assert language == set(docs.doc_id[has_letter])
    own = docs[docs.doc_id.isin(language)].copy()
    own["norm"] = own.text.str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
    assert exact == set(own.groupby("norm").doc_id.min())
    sets = {}
    for row in own[own.doc_id.isin(exact)].itertuples():
        w = row.text.translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})).split()
        sets[row.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert near == {i for i in ids if find(i) == i}
    hit = QUERIES["op1_decontamination"](spark, FOLDER).toPandas()
    assert clean == near - set(hit[hit.contaminated].doc_id)
    assert set(queries()) >= set(QUERIES) | {"pipeline"}
