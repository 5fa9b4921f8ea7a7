from __future__ import annotations

import hashlib
import re

import pytest

from veritable.llm import decontam
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (found := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[found]
        out.append((doc, len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return out


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = QUERIES["op3_decontamination"](spark, SMALL)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, n, h, i in brute(docs, items)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert any(w[2] for w in want)


LINE = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, LINE), (2, LINE), (10, "Rare word"), (11, "solo"), (12, None), (13, " .,"), (None, "x y z q r s"),
         (14, "a a a a a a a a a a a a"), (15, "seven small words stand here all alone"), (16, "")]
DOCS = [(1, None), (2, ""), (3, LINE.upper() + "!"), (3, LINE.upper() + "!"), (4, "two " + LINE[8:]),
        (5, "a rare-word and solo, SOLO"), (6, "x y z q r s t"), (None, LINE), (None, "solo"),
        (7, "a " * 40), (8, "seven small words stand here all"), (9, "seven small words stand here all alone"),
        (10, " ".join(LINE.split()[:9])), (11, " ".join([LINE, "filler"] * 4000)),
        (12, "one two three four five zap six seven eight nine ten")]


@pytest.mark.parametrize("limit", [0, 200_000])
def test_edge_cases(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_SHINGLES", limit)
    docs = spark.createDataFrame([(d, t, 0, "k") for d, t in DOCS],
                                 "doc_id long, text string, n_words int, digest string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(docs, items)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r["id"], r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=key) == sorted(
        brute(DOCS, ITEMS), key=key)
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        d for d, _, h, _ in brute(DOCS, ITEMS) if not h)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contamination(docs.limit(0), items).collect() == []
    none = decontam.contamination(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.contaminated for r in none)


def test_windows_need_two_shingles(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    with pytest.raises(ValueError):
        decontam.contamination(docs, items, window=11)
