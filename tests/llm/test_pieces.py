from __future__ import annotations

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from veritable.llm import pieces
from veritable.llm.queries import QUERIES, piece_model

SMALL = "/root/testdata/sf0.001"
PROTO = piece_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=PROTO)


def whole(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def test_query_matches_the_library(spark):
    got = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = whole(text)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


CASES = ["", " ", "  ", "a ", " a", "  a b  c ", "▁a▁", "a▁ ▁b", "\n", "a\tb\n c",
         "\0x", "é \U0001d11e", "<s> </s><unk>", "　x", "x" * 5000, "ab" * 40 + " " * 30,
         " ".join(f"word{i}" for i in range(3000))]


def test_chunks_equal_the_library():
    encoder = pieces.Encoder(PROTO)
    assert encoder.by_chunk
    for text, packed in zip(CASES, encoder.encode(CASES)):
        assert np.frombuffer(packed, "<u4").tolist() == whole(text)
        assert encoder.decode(packed) == LIBRARY.decode(whole(text))


ENCODER = pieces.Encoder(PROTO)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" ▁abé\n中<s>1."), max_size=40))
def test_random_texts(text):
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == whole(text)


def test_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 3)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 4)
    encoder = pieces.Encoder(PROTO)
    for text in CASES * 2:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole(text)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "long " * 50_000)]
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows],
                               "doc_id long, text string, id int, packed string")
    got = pieces.encode(df, PROTO, ids=True).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(((r["id"], r.ids) for r in got), key=key) == sorted(
        ((d, whole(t)) for d, t in rows), key=key)
    assert pieces.encode(df.limit(0), PROTO).collect() == []


def test_whole_texts_when_pieces_cross(monkeypatch):
    monkeypatch.setattr(pieces, "pieces_stay_in_chunks", lambda *a: False)
    encoder = pieces.Encoder(PROTO)
    assert not encoder.by_chunk
    assert [np.frombuffer(p, "<u4").tolist() for p in encoder.encode(CASES)] == [
        whole(t) for t in CASES]




@pytest.mark.parametrize("frequent", [0, 3, 300_000])
def test_one_table_of_chunks_for_all_texts(spark, frequent):
    """Each distinct chunk stands in the table once, whatever the partitions; ids are the library's."""
    proto = PROTO
    texts = [None, "", " ", "  two  spaces ", "the cat sat on the mat the cat", "the rare zyzzyva the zyzzyva",
             "x" * 500 + " cat " + "x" * 500, "中文" * 60, "café ▁ mark", "a\tb\nc"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    table = pieces.chunk_table(df, proto)
    assert table.count() == table.select("key").distinct().count()
    counted = {r.key: r.n for r in table.collect()}
    assert counted["the"] == 15 and counted["zyzzyva"] == 6
    got = {r.id: list(r.ids) for r in pieces.encode_by_table(df, proto, frequent=frequent).collect()}
    assert got == {i: whole(t) for i, t in enumerate(texts)}
    assert pieces.encode_by_table(df.limit(0), proto).collect() == []
