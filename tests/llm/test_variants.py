from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from veritable.llm import variants
from veritable.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def neighbours(words):
    """By deletions: words that share one, checked by a plain edit distance of one."""
    by_rest = defaultdict(set)
    for w in words:
        by_rest[w].add(w)
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in by_rest.values():
        for a in group:
            near[a].update(b for b in group if b != a and distance_is_one(a, b))
    return near


def distance_is_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words):
    near, form = neighbours(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w)))
                  for w, n in words.items())


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    wanted = expected(words_of(rows))
    assert sum(r[1] is not None for r in wanted) > 5
    assert got(QUERIES["op11_spelling_variants"](spark, FOLDER)) == wanted


@pytest.mark.parametrize("classes, block", [(2, 7), (9, 3), (None, 2048)])
def test_any_blocks_give_the_same_pairs(spark, classes, block):
    """Anagrams, repeated letters, letters that share a bin, words of any length, full blocks."""
    rng, words = random.Random(3), {"e" * 300, "e" * 299, "e" * 300 + "x", "ф" * 8, "ф" * 7 + "\U0001d51e"}
    for _ in range(60):
        base = [rng.choice("abcé") for _ in range(rng.randint(6, 9))]
        for _ in range(8):
            w, i = base[:], rng.randrange(len(base))
            rng.choice([lambda: w.insert(i, rng.choice("abzÿ")), lambda: w.pop(i),
                        lambda: w.__setitem__(i, rng.choice("abcdü")),
                        lambda: rng.shuffle(w)])()
            words.add("".join(w))
    words |= {chr(0x100 + i) + "mmmmm" for i in range(300)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    pairs = [(r.word, r.near) for r in variants.near_words(df, classes, block).collect()]
    near = neighbours(words)
    assert sorted(pairs) == sorted((a, b) for a in near for b in near[a])


def test_forms_and_roots(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 700, "aabbbb": 3500, "abbbbb": 20000,
              "bbbbbb": 20000 * 5, "cccccc": 10, "cccccd": 49, "ccccce": 50, "ccccca": 50, "dddddd": 6}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, near string")
    out = {r.word: r for r in variants.group_variants(df).collect()}
    assert got(variants.group_variants(df)) == expected(counts)
    assert out["aaaaaa"].root == "bbbbbb" and out["cccccc"].form == "ccccca"


def test_edge_cases(spark, tmp_path):
    long = "Straße " * 3 + "x" * 50_000 + " "
    rows = [(1, None), (2, ""), (3, "12 .,; 中文中文中文"), (None, "orchard " * 5), (5, "ORCHARD orchard "),
            (5, "ORCHARD orchard "), (6, "orchards " * 30 + "Gärten×÷ÿ " * 6)] + [(i, long) for i in range(10, 16)]
    df = spark.createDataFrame([(d, t, "w", 3) for d, t in rows],
                               "doc_id long, text string, word string, n int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    wanted = expected(words_of(rows))
    assert {"orchard", "orchards", "straße", "gärten×÷ÿ", "x" * 50_000} <= {r[0] for r in wanted}
    assert got(QUERIES["op11_spelling_variants"](spark, str(tmp_path))) == wanted
    assert variants.group_variants(variants.vocabulary(df.limit(0))).collect() == []
