from __future__ import annotations

import math

import numpy as np
import pytest

from veritable.llm import mtree
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def quantize(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(x)) for x in v]  # Python integers have no bound


def brute(rows, is_query):
    rows = [(i, q) for i, v in rows if i is not None and (q := quantize(v)) is not None]
    out = []
    for own, q in {(i, tuple(v)) for i, v in rows if is_query(i)}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != own)
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    return sorted(out)


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op6_top_k"](spark, SMALL)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (5, 2)])
def test_edge_cases(spark, blocks):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [-3.0]), (9, [0.1, 0.2, 0.3]),
            (None, [9.0, 9.0]), (10, [0.0, 0.0]), (11, [1e4, -1e4]), (12, [0.003, -0.003])]
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = mtree.search(df, df, block_rows=blocks[0], block_queries=blocks[1], cell_rows=blocks[0])
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, lambda i: True)


def test_empty_and_single(spark):
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert mtree.search(one, one).collect() == []
    assert mtree.search(one.limit(0), one).collect() == []
    assert mtree.search(one, one.limit(0)).collect() == []


def test_trees_with_many_ties_and_clusters():
    rng = np.random.default_rng(2)
    for n, spread in ((1000, 3), (3000, 40)):
        centres = rng.integers(-200, 200, (12, 8))
        vectors = centres[rng.integers(0, 12, n)] + rng.integers(-spread, spread, (n, 8))
        ids = rng.permutation(n)
        tree = mtree.Tree(ids, vectors, page=16)
        for at in range(0, n, 97):
            scores = vectors @ vectors[at]
            want = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[at])[:5]
            found, visited = tree.search(vectors[at], int(ids[at]), 5)
            assert found == [(-s, i) for s, i in want] and visited <= n


def test_large_components_give_exact_scores_or_an_error(spark):
    """Products of 2 ** 53 to 2 ** 63 are exact; a best score beyond a long is an error, others are not."""
    schema = "vec_id long, embedding array<double>"
    rows = [(i, [3e6 + i, 1.0, -2e6 + 7 * i]) for i in range(6)] + [(9, [-3e6, 0.5, 2e6])]
    df = spark.createDataFrame(rows, schema)
    got = mtree.search(df, df, cell_rows=2)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, lambda i: True)
    for large in (4e7, 1e30):
        both = spark.createDataFrame([(1, [large, 1.0]), (2, [-large, 2.0]), (3, [large, 0.0])], schema)
        with pytest.raises(Exception, match="does not fit a long"):
            mtree.search(both, both).collect()
        apart = [(0, [0.0, 1.0]), (1, [large, 1.0]), (2, [-large, 2.0])]
        df = spark.createDataFrame(apart, schema)
        got = mtree.search(df, df.where("vec_id = 0")).collect()
        assert sorted(tuple(r)[:4] for r in got) == brute(apart, lambda i: i == 0)
    with pytest.raises(OverflowError):
        mtree.search(*[spark.createDataFrame([(1, [1e200])], schema)] * 2)


def test_queries_visit_few_rows(spark):
    """Clustered vectors: most cells are out of reach, most pages are never opened."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 4
    points = centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 16)) * 0.2
    df = spark.createDataFrame(list(enumerate(points.tolist())), "vec_id long, embedding array<double>")
    got = mtree.search(df, df.where("vec_id % 200 = 0"), cell_rows=200).collect()
    whole = np.floor(256 * points)
    for r in got:
        if r["rank"] == 1:
            scores = whole @ whole[r.query_id]
            scores[r.query_id] = -np.inf
            assert r.score == scores.max() and 5 <= r.visited < len(points)
    assert np.mean([r.visited for r in got]) < len(points) / 4


def test_queries_together_equal_brute_force(monkeypatch):
    """Many queries share one walk: pages are multiplied by fewer calls than there are queries."""
    rng = np.random.default_rng(9)
    calls, plain = [], mtree.products
    monkeypatch.setattr(mtree, "products", lambda *a: calls.append(1) or plain(*a))
    for scale in (1, 10 ** 8):  # beyond 2 ** 53 as well
        vectors = rng.integers(-50, 50, (600, 6)) * float(scale)
        vectors[::7] = vectors[0]
        ids = rng.permutation(600)
        tree = mtree.Tree(ids, vectors, page=16)
        asked = vectors[:200]
        scores = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in vectors] for q in asked]
        want = [sorted((-s, int(i)) for s, i in zip(each, ids) if i != own)[:5]
                for each, own in zip(scores, ids)]
        calls.clear()
        found = tree.search_all(asked, ids[:200].tolist(), 5, np.full(200, -math.inf))
        assert [each for each, _ in found] == [[(-s, i) for s, i in w] for w in want]
        assert len(calls) < len(asked) and all(5 <= seen <= 600 for _, seen in found)
        kth = np.array([float(-w[-1][0]) for w in want])
        again = tree.search_all(asked, ids[:200].tolist(), 5, kth)
        assert [each for each, _ in again] == [each for each, _ in found]
