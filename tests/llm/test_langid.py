from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from veritable.llm import langid
from veritable.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    got = QUERIES["op2_language_id"](spark, MEDIUM).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)


def test_undetermined_and_edges(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(docs)
    rows = [(1, None), (2, ""), (3, "123 %%% \n"), (4, "The and of that with this"),
            (5, "the and " * 200_000), (5, "the"), (None, "die und der")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, lang string")
    got = df.select("doc_id", langid.predict(model, F.col("text")).alias("p")).collect()
    named = [(r.doc_id, r.p.lang) for r in got]
    assert named == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (5, "en"),
                     (None, "de")]
    assert df.where(langid.determined(model, F.col("text"))).count() == 4


def test_no_labels_and_one_label(spark):
    schema = "doc_id long, text string, lang string"
    nothing = langid.fit(spark.createDataFrame([], schema))
    assert nothing.predict(["hello", None]) == [("und", 0.0, True)] * 2
    nulls = langid.fit(spark.createDataFrame([(1, "a", None), (2, None, "en")], schema))
    assert nulls.predict(["hello"])[0][0] == "und"
    one = langid.fit(spark.createDataFrame([(1, "hello", "en")], schema))
    assert one.predict(["bonjour"]) == [("en", 1.0, False)]


def test_features_of_parts_add_up(monkeypatch):
    text = "Le été à la plage, 12 fois. " * 40
    whole = langid.features(text)
    monkeypatch.setattr(langid, "CHARS_AT_ONCE", 7)
    assert np.allclose(whole, langid.features(text))


def test_codewords_are_distinct():
    for n in (2, 3, 4, 6, 7, 40):
        codes = langid.codewords(n)
        assert len({tuple(c) for c in codes.tolist()}) == n
        gap = min((codes[i] != codes[j]).sum() for i in range(n) for j in range(i))
        assert gap >= (1 if n < 3 else 2)
