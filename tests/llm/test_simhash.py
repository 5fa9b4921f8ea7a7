from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from veritable.llm import simhash
from veritable.llm.components import connected_components
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """Brute force: every pair, by union-find."""
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)
                  if d is not None)


def found(df):
    out = df.select("id", simhash.hexadecimal("fp"), "component").collect()
    return sorted(tuple(r) for r in out if r.id is not None)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op1_simhash_near_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in got.collect()) == components(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "one"), (5, "ONE"), (5, "ONE"),
            (6, "Été İx"), (7, long), (8, long + " tail"), (9, "a b c"),
            (None, "one"), (None, "nobody else"), (10, "x y z")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows],
                               "doc_id long, text string, fp int, component int")
    out = simhash.near_duplicates(df)
    assert out.count() == len(rows)
    assert found(out) == components(rows)
    lone = {r.fp: r.component for r in out.where("id is null").collect()}
    assert set(lone.values()) == {4, None}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.representatives(empty).collect() == []


def test_covering_masks_leave_no_pair_out():
    rng = random.Random(5)
    masks = simhash.covering_masks((1 << 64) - 1)
    assert len(masks) == 31
    for _ in range(3000):
        bits = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & bits == 0 for m in masks)


@pytest.mark.parametrize("limit", [24, 4096])
def test_large_buckets_are_covered_again(spark, limit):
    """Groups far above the limit: same components as all pairs."""
    rng, fps = np.random.default_rng(3), set()
    for centre in rng.integers(-2**62, 2**62, 6).tolist():
        for _ in range(60):
            flips = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False))
            fps.add(centre ^ flips)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    tied = connected_components(simhash.links(df, limit=limit)).collect()
    got = {r.node: r.component for r in tied}
    want = {f: f for f in fps}
    for a in fps:
        for b in fps:
            if 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 4 and want[a] != want[b]:
                keep, gone = sorted((want[a], want[b]))
                want = {f: keep if w == gone else w for f, w in want.items()}
    assert {f: got.get(f, f) for f in fps} == want


def test_the_highest_bit_is_a_bit_like_any_other(spark):
    """Pairs that differ in it, and in up to three more, are linked; with four more they are not."""
    rng = random.Random(7)
    pairs = []
    for more in (0, 1, 2, 3, 3, 3, 4, 4):
        fp = rng.getrandbits(64)
        flips = sum(1 << b for b in rng.sample(range(63), more)) | 1 << 63
        pairs.append((simhash._signed(fp), simhash._signed(fp ^ flips), more < 4))
    df = spark.createDataFrame([(f,) for a, b, _ in pairs for f in (a, b)], "fp long")
    tied = {r.node: r.component for r in connected_components(simhash.links(df)).collect()}
    assert [tied.get(a, a) == tied.get(b, b) for a, b, _ in pairs] == [linked for *_, linked in pairs]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    tied = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in tied} == {
        **{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}}


def test_representatives(spark):
    rows = [(3, "a b c d e f g"), (1, "A b c d e f g"), (1, "A b c d e f g"),
            (2, "something else here entirely"), (None, "a b c d e f g"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or -1) for r in simhash.representatives(df).collect())
    assert kept == [-1, 1, 2, 4]
