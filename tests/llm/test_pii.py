from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from veritable.llm import pii
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in PATTERNS.items()
            for m in re.finditer(p, text or "") if valid(kind, m[0])]


def check(rows, got):
    assert len(rows) == len(got)
    for (doc, text), r in zip(rows, got):
        base = brute(text)
        assert r.doc_id == doc
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (text or "")[:200]
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(b.startswith(kind + ":") for b in base)
        assert set(base) <= set(r.spans.split(","))


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").collect()]
    got = QUERIES["op4_pii"](spark, SMALL).orderBy("doc_id").collect()
    check(rows, got)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 0


TEXTS = [
    None, "", "a@b.c_foo@d.e x%y+z@a-b.co.uk, @x.y a@b", "1.2.3.4.5 256.1.1.1 01.002.3.255 999.1.2.3.4",
    "4041894974608795 4041 8949 7460 8795 4041-8949-7460-8796 40418949746087954041894974608795",
    "+1 (588) 555-2485 + 1 22 +12345678 +123456789012345678 +1-2-3-4-5-6-7-8-9) +49.30.1234567",
    "é\U0001d11eé a@b.co \U0001f600 +1 (588) 555-2485.", "x" * 2000, "1" * 2000, "1 " * 2000,
    "a.b@c" + ".d" * 1000, "a@b.co " * 800, "+1 222 333 4444 " * 400 + "tail",
    "4041894974608795  4041894974608795 12 3", "1.1.1.1@x.y +1.2.3.4567890",
]


def test_edge_texts(spark, tmp_path):
    path = str(tmp_path / "t")
    with_extra = [(i, t, "e", 3) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], None, None)]
    spark.createDataFrame(with_extra, "doc_id long, text string, spans string, base int") \
        .write.parquet(path + "/documents.parquet")
    got = QUERIES["op4_pii"](spark, path).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(TEXTS) + 1
    check(list(enumerate(TEXTS)), [by_id[i] for i in range(len(TEXTS))])


def test_very_long_texts(spark):
    """Runs that a plain pattern would try once per character."""
    texts = [("x" * 500_000, 0), ("1" * 300_000, 0), ("1 " * 200_000, 0), ("a.b@c" + ".d" * 30_000, 1),
             ("a@b.co " * 5000, 5000)]
    df = spark.createDataFrame(texts, "text string, n int")
    model = pii.fit(df.limit(0))
    for r in df.select("n", pii.spans(model, F.col("text")).alias("s")).collect():
        assert len(r.s) == r.n
        if r.n == 5000:
            assert [s.start for s in r.s] == list(range(0, 35_000, 7))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = pii.fit(empty)
    one = spark.createDataFrame([("call 212-555-0100 or a@b.co",)], "text string")
    assert [s.kind for s in one.select(pii.spans(model, F.col("text")).alias("s")).first().s] == ["email"]


def test_classifier_adds_and_rejects(spark):
    good = [(f"please call our phone 212-555-{i:04d} today",) for i in range(60)]
    mail = [(f"write mail to person{i} [at] example [dot] com now",) for i in range(40)]
    bad = [(f"order 212-555-{i:04d}9 and card 1234 5678 9012 345{i % 10}, item 000-00-{i:04d}",)
           for i in range(60)]
    docs = spark.createDataFrame(good + mail + bad, "text string")
    model = pii.fit(docs)
    assert all(yes >= no for yes, no in model.reliability.values())
    tests = [(good[0][0], ["phone_national"]), (mail[0][0], ["email_spelled"]),
             ("item 000-00-0000", []), ("a@b.co (212) 555-0100", ["email", "phone_national"])]
    df = spark.createDataFrame(tests, "text string, want array<string>")
    for r in df.select("text", "want", pii.spans(model, F.col("text")).alias("s")).collect():
        assert [s.kind for s in r.s] == r.want, r.text


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "mail é a@b.co, or +1 (588) 555-2485!", 9, "x"), (2, None, None, "y"), (3, "clean", 5, "z")],
        "doc_id long, text string, n_chars long, t string")
    out = pii.redact(docs, pii.fit(docs), count_col="n_chars")
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [
        (1, "mail é [email], or [phone]!", 27, "x"), (2, None, None, "y"), (3, "clean", 5, "z")]
