import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from cairnlake.llm import queries, sentence_piece
from cairnlake.llm.text_arrays import read_texts

PATH = queries.piece_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = sentence_piece.vocabulary(PATH)


def encode(texts):
    out = []
    for _, piece in read_texts(pa.array(texts, pa.string())):
        ids, counts = sentence_piece.encode_texts(piece, VOCABULARY)
        ends = np.cumsum(counts)
        decoded = sentence_piece.decode_ids(ids, counts, VOCABULARY)
        out += [(ids[e - n : e].tolist(), d.decode()) for e, n, d in zip(ends, counts, decoded)]
    return out


@given(st.lists(st.text(max_size=40) | st.text(st.sampled_from("ab \n▁é😀exiotnsh\x00"), max_size=60), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_encodes_and_decodes_as_the_library(texts):
    assert encode(texts) == [(LIBRARY.encode(t), LIBRARY.decode(LIBRARY.encode(t))) for t in texts]


@pytest.mark.parametrize("text", [" " * n for n in (1, 2, 13, 14, 15, 16, 17, 31, 32, 33, 47, 48, 500)] + ["a" * 999, "ab" * 999, "\n" * 50])
def test_runs(text):
    for t in (text, text + "x", "x" + text):
        assert encode([t])[0][0] == LIBRARY.encode(t)


def test_broken_bytes_decode_as_in_the_library():
    byte = lambda *values: [LIBRARY.piece_to_id(f"<0x{v:02X}>") for v in values]
    for ids in (byte(0xE2, 0x96), byte(0xFF, 0x41), byte(0xC3) + [300] + byte(0xA9), byte(0xF0, 0x9F, 0x98, 0x80)):
        assert sentence_piece.decode_ids(np.array(ids), np.array([len(ids)]), VOCABULARY)[0].decode() == LIBRARY.decode(ids)


def test_every_kind_of_row(edge_documents, no_documents):
    got = {r.doc_id: r for r in sentence_piece.token_digests(edge_documents.where("doc_id is not null"), PATH).collect()}
    for row in edge_documents.where("doc_id is not null").collect():
        ids, r = LIBRARY.encode(row.text or ""), got[row.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert sentence_piece.token_digests(edge_documents, PATH).count() == edge_documents.count()
    assert sentence_piece.token_digests(no_documents, PATH).count() == 0
    listed = sentence_piece.encode_documents(edge_documents, PATH, ["lang"])
    assert listed.columns == ["lang", "ids"] and listed.count() == edge_documents.count()


def test_pipeline_stages(spark):
    """Every stage against what it promises of its own input; the last against the library."""
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder)
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]
    bad = {r.doc_id for r in queries.labels(spark, folder).where("quality = 0").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        rows = docs.collect()
        if name == "quality":
            lost = set(before) - {r.doc_id for r in rows}
            assert len(bad - lost) <= 1 and len(lost) < len(before) / 3
        if name == "exact_dedup":
            plain = ["".join((r.text or "").split()) for r in rows]
            assert set(plain) == {"".join((r.text or "").split()) for r in kept} and len(plain) == len(set(plain))
        if name == "near_dedup":
            assert {r.doc_id for r in rows} <= {r.doc_id for r in kept} and len(rows) > 100
        if name == "mix":
            assert sum(len(r.text.split()) for r in rows) == pytest.approx(sum(len(r.text.split()) for r in kept), rel=0.01)
        kept = rows
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect())
    want = []
    for r in kept:
        ids = LIBRARY.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert got == sorted(want)


def test_a_large_batch_takes_little_memory(edge_documents, monkeypatch):
    """Eight MB of texts in one batch: arrays of some ten times its size would not fit beside another task."""
    monkeypatch.setattr(sentence_piece, "map_batches", lambda table, run, schema: run)
    texts = [" ".join(f"w{i}x{j}" for j in range(1500)) for i in range(800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    assert batch.nbytes > 8 << 20
    run = sentence_piece.token_digests(edge_documents, PATH)
    tracemalloc.start()
    rows = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 250 << 20
