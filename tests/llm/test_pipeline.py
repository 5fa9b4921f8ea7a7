"""The corpus pipeline against a plain version of each of its stages."""

from __future__ import annotations

import random
import re

import pytest
import sentencepiece
import xxhash

import corpus_pipeline
from test_simhash import fingerprint
from veritable.llm import langid, simhash
from veritable.llm.queries import piece_model

ENGLISH = "the of and to in is that it for on was be with as by at from this have are".split()
FRENCH = "le la les des une est dans pour que qui sur avec par pas plus ce cette sont mais nous".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "e", "r", "s", "nt"]) for _ in range(n))


def fixture_rows():
    """doc_id, text, lang, source; ids and languages may be missing."""
    rng = random.Random(11)
    rows = [(i, prose(rng, ENGLISH, 60), "en", "a") for i in range(12)]
    rows += [(20 + i, prose(rng, FRENCH, 60), "fr", "b") for i in range(12)]
    long = prose(rng, ENGLISH, 400)
    passage = "quick zebras vow to jump over twelve lazy foxes near old mills"
    near = long.replace(" ", "  ", 1) + " end"
    rows += [
        (40, long, None, "a"), (41, near, None, "a"), (41, near, None, "a"), (None, long, "en", "a"),
        (50, long, "en", "c"), (50, prose(rng, FRENCH, 80), "fr", "c"),  # one id, two texts
        (60, "Well, " + passage.upper() + " " + prose(rng, ENGLISH, 30), "en", "a"),
        (61, passage + ", once more", "en", None), (62, passage[:40], "en", None),
        (70, "mail jane.doe@example.org or call " + prose(rng, ENGLISH, 40), "en", "a"),
        (80, None, "en", "a"), (81, "", None, None), (82, "123 456 !!", "en", "a"),
        (83, "7 " * 300 + "x", None, "a"), (84, "ok", None, "a"),
    ]
    return rows, [(1, passage), (2, None), (3, "short item")]


@pytest.fixture
def folder(spark, tmp_path):
    rows, items = fixture_rows()
    docs = spark.createDataFrame(
        [(d, t, lang, source, len(t or ""), "x") for d, t, lang, source in rows],
        "doc_id long, text string, lang string, source string, n_chars long, key string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def one_of_each_group(rows):
    """Of texts whose fingerprints reach each other: the least (id, digest); rows without id all stay."""
    rows = sorted(set(rows), key=repr) + [r for r in rows if r[0] is None][1:]
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    kept = [r for r in rows if r[0] is None]
    for g in set(group):
        mine = [r for r, k in zip(rows, group) if k == g and r[0] is not None]
        if mine:
            digest = lambda r: xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
            signed = lambda x: x - (1 << 64) if x >> 63 else x
            kept.append(min(mine, key=lambda r: (r[0], signed(digest(r)))))
    return sorted(kept, key=repr)


def test_each_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [words_of(t) for _, t in fixture_rows()[1]]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "benchmark_decontamination",
                            "personal_data", "sentencepiece"]

    named = stages["language_id"](spark, docs, folder)
    assert named.columns == docs.columns
    model = langid.fit(docs)
    told = {t: model.predict([t])[0] for _, t in of(docs)}

    def stays(text):
        letters = sum(c.isalpha() for c in text or "")
        mostly = letters >= 0.2 * len(re.sub(r"\s", "", text or ""))
        return letters > 0 and told[text][0] != "und" and (not told[text][2] or mostly)

    wanted = [(d, t) for d, t in of(docs) if stays(t)]
    assert of(named) == wanted
    assert {None, 84, 62} <= {d for d, _ in wanted} and not {80, 81, 82} & {d for d, _ in wanted}

    once = stages["simhash_near_dedup"](spark, named, folder)
    assert once.columns == docs.columns and of(once) == one_of_each_group(wanted)
    kept = [d for d, _ in of(once)]
    assert kept.count(50) == 1 and 40 in kept and 41 not in kept, "50 keeps its other text"

    def holds(text):
        words = words_of(text)
        return any(words[i:i + len(w)] == w
                   for item in items if item
                   for w in (item[k:k + 10] for k in range(max(1, len(item) - 9)))
                   for i in range(len(words)))

    clean = stages["benchmark_decontamination"](spark, once, folder)
    assert clean.columns == docs.columns
    assert of(clean) == [(d, t) for d, t in of(once) if not holds(t)]
    assert not {60, 61} & {d for d, _ in of(clean)} and 62 in {d for d, _ in of(clean)}

    safe = stages["personal_data"](spark, clean, folder)
    assert safe.columns == docs.columns
    before, after = dict(of(clean)), dict(of(safe))
    assert set(before) == set(after) and "jane.doe" not in after[70] and "[email]" in after[70]
    assert all(before[d] == after[d] for d in before if d != 70)
    assert all(r.n_chars == len(r.text) for r in safe.collect())

    coded = stages["sentencepiece"](spark, safe, folder)
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    assert {r.doc_id: list(r.ids) for r in coded.collect()} == {
        d: library.encode(t, add_bos=True, add_eos=True) for d, t in after.items()}


def test_the_whole_run(spark, folder):
    """The registered query is the stages one after the other; extra columns do no harm."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, folder)
    key = lambda r: repr(r)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=key) == sorted(
        map(tuple, step.collect()), key=key)


def test_without_a_known_language_nothing_with_letters_goes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    kept = {d for d, _ in of(corpus_pipeline.language_id(spark, docs, folder))}
    assert {0, 20, 84} <= kept and not {80, 81, 82} & kept
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.collect() == []


def test_one_id_with_two_texts(spark):
    a, b = prose(random.Random(1), ENGLISH, 50), prose(random.Random(2), FRENCH, 50)
    for rows, wanted in (
        ([(5, a), (5, b), (3, a)], [(3, a), (5, b)]),
        ([(5, a), (5, b)], [(5, a), (5, b)]),
        ([(5, a), (5, b), (5, b), (6, b), (4, a)], [(4, a), (5, b)]),
    ):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert of(simhash.representatives(df)) == sorted(wanted, key=repr)
    near = [(5, a + " end"), (5, a)]
    assert (fingerprint(near[0][1]) ^ fingerprint(a)).bit_count() <= 4
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert len(of(simhash.representatives(df))) == 1, "near copies of one id: one of them stays"
