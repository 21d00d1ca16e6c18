import zlib

import numpy as np
import pyarrow as pa
import pytest

from tally.llm import sentencepieces as sp

TEXTS = ["", "  ", "a\tb c\r\nd", " a", "\nx", "x\n", "x ", "a  b   c", "<s> hi </s> <unk> <0x41>", "日本語 emoji 😀 ▁x",
         "a\n\nb \n c", "12345 a1b2", None, "x" * 3000, "été naïve Ünïcode", "a b" * 2000]


@pytest.fixture(scope="module")
def model():
    return sp.PieceModel(sp.default_model())


def test_parity_and_decoding(model, spark, small):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    encoder = sp.Encoder(model)
    ids, lengths = encoder(pa.array(texts))
    cuts = np.split(ids, np.cumsum(lengths)[:-1])
    for text, own in zip(texts, cuts):
        assert own.tolist() == model.peer.encode(text or "")
        assert model.decode(own) == model.peer.decode(own.tolist())
    assert model.mismatches == 0  # the rebuilt backend needed no correction


def test_backend_alone(model):
    for text in TEXTS:
        ids = model.backend.encode(text or "", add_special_tokens=False).ids
        if text:
            assert ids == model.peer.encode(text)
            assert model.backend.decode(ids, skip_special_tokens=True) == model.peer.decode(ids)


def test_invalid_bytes(model):
    ids = np.array([model.pieces.index("<0xE6>"), model.pieces.index("<0x97>")])
    assert isinstance(model.decode(ids), str)


def test_frames(spark, odd_docs, no_docs, model):
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=str)
    out = sp.round_trip(odd_docs).collect()
    crc = lambda t: zlib.crc32(np.array(model.peer.encode(t or ""), "<u4").tobytes())
    assert sorted(((r.doc_id, r.ids_crc32) for r in out), key=str) == sorted(((i, crc(t)) for i, t in rows), key=str)
    assert all(r.round_trip for r in out)
    back = sp.decode(sp.encode(odd_docs)).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert sp.round_trip(no_docs).count() == 0
