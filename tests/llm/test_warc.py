from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from veritable.llm import warc
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    last = {}
    for page, html in rows:
        key = html or ""
        last[key] = max((p for p in (last.get(key), page) if p is not None), default=None)
    out = []
    for page, html in rows:
        size, first = len((html or "").encode()), last[html or ""]
        revisit = size >= least and page != first
        out.append((page, size, digest(html), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    got = QUERIES["op10_warc"](spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
ROWS = [(1, None), (2, ""), (3, FAKE), (4, "x" + FAKE * 3 + "WARC/1.0\r\n"), (5, "\r\n\r\n"), (6, "é\U0001d11e"),
        (7, "same"), (8, "same"), (9, "same"), (9, "same"), (None, "same"), (None, "alone"), (10, "y" * 300_000),
        (-4, "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99999999999\r\n\r\n"), (11, FAKE)]


def test_round_trip_of_payloads_and_magic(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 4)
    pages = spark.createDataFrame([(p, f"http://x/{p}\n", h, "k") for p, h in ROWS],
                                  "page_id long, url string, html string, type string")
    for least in (0, 5):
        path = str(tmp_path / f"w{least}")
        warc.write(pages.repartition(2), path, least=least)
        records = warc.read(spark, path)
        got = warc.resolved(records).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS, least)
        held = {(r.page, bytes(r.payload).decode()) for r in records.where("type = 'response'").collect()}
        assert held <= {(p, h or "") for p, h in ROWS}
        assert {h for _, h in held} == {h or "" for _, h in ROWS}


def test_only_the_chain_from_the_start_counts(spark):
    links = [("a", 0, 10), ("a", 10, 25), ("a", 12, 25), ("a", 25, 40), ("a", 30, 40), ("b", 5, 9), ("b", 9, 12)]
    links += [("c", i, i + 1) for i in range(77)]
    df = spark.createDataFrame(links, "file string, at long, next long")
    got = {(r.file, r["at"]) for r in warc.reachable(df).collect()}
    assert got == {("a", 0), ("a", 10), ("a", 25)} | {("c", i) for i in range(77)}
    assert warc.reachable(df.limit(0)).collect() == []


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "none"))
    assert warc.resolved(warc.read(spark, str(tmp_path / "none"))).where(F.lit(True)).collect() == []


def test_long_urls_in_the_middle_of_a_file(spark, tmp_path):
    urls = ["http://a", "http://x/" + "u" * 100_000, "http://y/WARC/1.0", "http://z/" + "WARC/1.0\r\n" * 9_000, "http://b"]
    pages = spark.createDataFrame([(i, u, f"p{i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    warc.write(pages.coalesce(1), str(tmp_path / "long"))
    for payloads in (True, False):
        got = warc.resolved(warc.read(spark, str(tmp_path / "long"), payloads)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute([(i, f"p{i}") for i in range(len(urls))])


@pytest.mark.parametrize("content", [FAKE + FAKE[:-5], FAKE + "x", "x" + FAKE])
def test_a_file_that_is_not_reached_whole_is_an_error(spark, tmp_path, content):
    (tmp_path / "part-0").write_bytes(content.encode())
    with pytest.raises(ValueError, match="part-0"):
        warc.read(spark, str(tmp_path))


def test_places_that_share_a_header_end(spark, tmp_path):
    """Only lines after a place count as its header, however many places share a blank line."""
    head = "Content-Length: 2\r\n" + "a: WARC/1.0\r\n" * 20_000
    content = f"WARC/1.0\r\nWARC-Type: response\r\n{head}\r\nab\r\n\r\n"
    (tmp_path / "part-0").write_bytes(content.encode())
    assert [(r.length, bytes(r.payload)) for r in warc.read(spark, str(tmp_path)).collect()] == [(2, b"ab")]


def test_files_are_bounded_in_bytes(spark, tmp_path):
    """Payloads of 100 bytes to 200 KB: no file is over the bytes of 500 records of the least level."""
    payloads = [(i, "u", "x" * (100 if i % 10 else 1000 * (1 + i % 200)) + str(i)) for i in range(1500)]
    pages = spark.createDataFrame(payloads, "page_id long, url string, html string").coalesce(1)
    path = tmp_path / "bounded"
    warc.write(pages, str(path), record_bytes=2000)
    sizes = [f.stat().st_size for f in path.glob("part-*")]
    assert max(sizes) <= 500 * 2000 and len(sizes) > 5
    got = warc.resolved(warc.read(spark, str(path), payloads=False)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([(i, h) for i, _, h in payloads])
