from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from veritable.llm import periodic
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every period, every maximal stretch, without those that a smaller period explains."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def got(words):
    return periodic.periodic_runs(periodic.word_names([w.encode() for w in words]))


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_words(letters):
    rng = random.Random(letters)
    for _ in range(400):
        words = [rng.choice("abcde"[:letters]) for _ in range(rng.randint(0, 70))]
        if len(words) > 10 and rng.random() < 0.7:
            at, p = rng.randrange(len(words)), rng.randint(1, 15)
            words[at:] = [words[at + (i - at) % p] for i in range(at, len(words))
                          if at + (i - at) % p < len(words)]
        assert got(words) == brute_runs(words), words


def test_periods_around_powers_of_two():
    rng = random.Random(1)
    for p in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 127):
        for times in (4, 4.5, 6):
            period = [rng.choice("ab") for _ in range(p)]
            words = ["x", "y"] + [period[i % p] for i in range(int(p * times))] + ["z", "y"]
            assert got(words) == brute_runs(words)


def test_nested_runs():
    words = (["a"] * 7 + ["b"]) * 5
    assert got(words) == brute_runs(words)
    assert (0, 40, 8) in got(words) and len(got(words)) == 6


def test_a_very_long_text():
    words = [f"w{i}" for i in range(100_000)] + ["a", "b", "c"] * 100_000
    assert got(words) == [(100_000, 300_000, 3)]
    assert got(["a"] * 500_000) == [(0, 500_000, 1)]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = QUERIES["op12_periodic_runs"](spark, SMALL)
    assert out.columns == COLUMNS
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected(*r) for r in rows)


def test_edge_cases(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "a"), (5, "a " * 6), (5, "a " * 6),
            (None, "b " * 9), (6, "é É " * 5), (7, "a b " * 6)] + [
                (i, "one two three four five six seven") for i in range(100, 160)]
    df = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows],
                               "doc_id long, text string, runs string, id string, kept int")
    out = {(r.id, r.n_words, len(r.runs), r.collapsed) for r in periodic.find_runs(df).collect()}
    assert {(1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (4, 1, 0, "a"), (5, 6, 1, "a"),
            (None, 9, 1, "b"), (6, 10, 1, "é É"), (7, 6, 1, "a b")} <= out
    assert periodic.find_runs(df).count() == len(rows)
    assert periodic.find_runs(df.limit(0)).collect() == []
    (tmp_path / "sf").mkdir()
    df.write.parquet(str(tmp_path / "sf/documents.parquet"))
    found = QUERIES["op12_periodic_runs"](spark, str(tmp_path / "sf")).collect()
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(
        (expected(*r) for r in rows), key=key)
