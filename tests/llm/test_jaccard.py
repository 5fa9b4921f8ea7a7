from __future__ import annotations

import random
import re

import numpy as np
import pytest

from veritable.llm import jaccard
from veritable.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def expected(rows, percent=80):
    """Every pair of sets that shares an element, by union-find."""
    sets = [shingles(t) for _, t in rows]
    root, holders = list(range(len(rows))), {}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in {j for x in one for j in holders.get(x, ())}:
            if find(i) != find(j) and 100 * len(one & sets[j]) >= percent * len(one | sets[j]):
                root[find(i)] = find(j)
        for x in one:
            holders.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    out = QUERIES["op13_jaccard_join"](spark, FOLDER)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert got(out) == expected(rows)


def family(rng, size, edits, tag):
    words = [f"{tag}{rng.randrange(60)}" for _ in range(size)]
    def edited():
        out = words[:]
        for _ in range(rng.randint(0, edits)):
            i = rng.randrange(len(out))
            rng.choice([lambda: out.pop(i), lambda: out.insert(i, f"x{rng.random()}"),
                        lambda: out.__setitem__(i, f"y{rng.random()}")])()
        return " ".join(out)
    return edited


@pytest.mark.parametrize("tile_bytes, tile_sets", [(64 << 20, 2048), (20_000, 3)])
def test_families_around_the_threshold(spark, tile_bytes, tile_sets):
    """Families whose members lie on both sides of the threshold, a passage all share, any tiles."""
    rng, rows = random.Random(4), []
    passage = " ".join(f"p{i}" for i in range(60))
    for f, (size, edits) in enumerate([(9, 1), (30, 2), (60, 4), (60, 4), (200, 9), (200, 14), (400, 30)]):
        make = family(rng, size, edits, f"f{f // 2}w")
        rows += [make() for _ in range(40)]
        rows += [make() + " " + passage for _ in range(10)]
    rows += [passage + " " + " ".join(f"q{rng.random()}" for _ in range(rng.randint(5, 90)))
             for _ in range(80)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = expected(rows)
    parts = {c for _, _, c in wanted}
    assert 50 < len(parts) < len(rows) - 50
    assert got(jaccard.near_duplicates(df, tile_bytes=tile_bytes, tile_sets=tile_sets)) == wanted


def test_exactly_at_the_threshold(spark):
    """Sets of 9 of which 8 are shared: 100 * 8 = 80 * 10 is a link; 7 shared of 8 and 8 is not."""
    at = ["a b c d e f g h i j k l X", "a b c d e f g h i j k l Y"]
    below = ["m n o p q r s t u v w X", "m n o p q r s t u v w Y"]
    rows = list(enumerate(at + below))
    out = got(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == expected(rows) == [(0, 9, 0), (1, 9, 0), (2, 8, 2), (3, 8, 3)]


def test_bits_bound_the_overlap_from_above():
    rng = np.random.default_rng(2)
    for size in (1, 5, 40, 900):
        pool = np.unique(rng.integers(0, 2 ** 63, 2 * size, np.uint64))
        one, two = (np.sort(rng.choice(pool, max(1, min(size + k, len(pool))), replace=False))
                    for k in (0, size // 5))
        bits = jaccard._folded([jaccard.signature(one), jaccard.signature(two)])
        differ = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        overlap = len(np.intersect1d(one, two))
        assert (len(one) + len(two) - differ) // 2 >= overlap
        assert jaccard._overlaps(one, [two, one]).tolist() == [overlap, len(one)]


def test_edge_cases(spark):
    long = " ".join(f"w{i % 1777}{i % 31}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "Été é"),
            (7, long), (8, long + " tail"), (9, "a b c d e"), (9, "something else"), (10, "A b C d e"),
            (None, "one"), (None, "nobody else"), (None, None), (11, "b c d e a"),
            (12, long.replace("w5 ", "w6 "))]
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows],
                               "doc_id long, text string, n int, node string, id int")
    assert got(jaccard.near_duplicates(df)) == expected(rows)
    assert jaccard.near_duplicates(df.limit(0)).collect() == []
    copies = [(i, "the same text stands here many times over") for i in range(300)]
    assert got(jaccard.near_duplicates(
        spark.createDataFrame(copies, "doc_id long, text string").repartition(8))) == expected(copies)
