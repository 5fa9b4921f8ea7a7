"""WARC archives: written by tasks, and read back by boundary-chain verification.

The bytes that begin a record may also stand inside a payload. So a reader lists, for every
place that looks like a record, the place where that record would end. What is a record follows
from the start of the file alone: pointer jumping along these links keeps the places that the file's
start reaches and rejects the others, in a number of rounds that grows with the logarithm of
the records of a file.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.sources.scratch import written

MAGIC = b"WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
#: Records of one file, which bounds the rounds.
RECORDS_PER_FILE = 500
#: Bytes of a record up to which a file holds that many; records of up to twice the size lie in files of
#: half as many, and so on. So a file, which a task reads whole, has some 130 MB at most, unless one
#: record alone has more.
RECORD_BYTES = 1 << 18
HEADER_BYTES = 1 << 10
#: So many sizes of records: the last ones lie in a file each.
LEVELS = 10


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page, url, html, refers`` → the text of a record; ``refers`` is null for a response."""
    for batch in batches:
        out, held = [], 0
        for page, url, html, revisit, refers in zip(*(c.to_pylist() for c in batch.columns)):
            payload = html or ""
            digest = _digest(payload.encode("utf-8", "surrogatepass"))
            body = "" if revisit else payload
            head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
                    f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
                    "WARC-Target-URI: " + re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url or ""),
                    f"WARC-Payload-Digest: sha1:{digest}"]
            if revisit:
                head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                         f"WARC-Refers-To: <urn:page:{'' if refers is None else refers}>"]
            size = len(body.encode("utf-8", "surrogatepass"))
            out.append("\r\n".join([*head, f"Content-Length: {size}", "", body]))
            held += len(body)
            if held > 1 << 22:
                yield pa.record_batch([pa.array(out, pa.string())], ["value"])
                out, held = [], 0
        yield pa.record_batch([pa.array(out, pa.string())], ["value"])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", least: int = 0, record_bytes: int = RECORD_BYTES) -> None:
    """Write a record per row into WARC files under ``path``, which are bounded in records and bytes.

    Of rows with equal payloads of at least ``least`` bytes, those with the largest id hold the
    payload, the others revisit it. Null payloads are empty. A missing id is smaller than any
    other; rows that share the largest id hold the payload each.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    whole = F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    level = F.ceil(F.log2(whole / record_bytes)).cast("int")
    level = F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS - 1))
    sized = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("sha"),
                        F.octet_length("html").alias("bytes"), level.alias("level"))
    keys = written(sized.select("sha", "bytes", "page", "level"), "sizes")
    copies = written(
        keys.where(F.col("bytes") >= least).groupBy("sha")
        .agg(F.max("page").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("sha", "last"), "copies")
    told = sized.join(copies, "sha", "left").select(
        "level", "page", "url", "html",
        (F.col("last").isNotNull() & (F.col("bytes") >= least)
         & ~F.col("page").eqNullSafe(F.col("last"))).alias("revisit"),
        F.col("last").alias("refers"))
    levels = sorted(r.level for r in keys.select("level").distinct().collect()) or [0]
    for k in levels:
        some = told if len(levels) == 1 else told.where(F.col("level") == k)
        some.drop("level").mapInArrow(_records, "value string").write.mode(
            "error" if k == levels[0] else "append").option("lineSep", RECORD_END).option(
            "maxRecordsPerFile", max(1, RECORDS_PER_FILE >> k)).text(path)


def _header(content: bytes, begin: int, end: int) -> dict[str, tuple[int, str]]:
    """Name → place and value of the last field of each name among the header lines given."""
    fields, at = {}, begin
    for line in content[begin:end].split(b"\r\n"):
        name, colon, value = line.partition(b": ")
        if colon:
            fields[name.decode("utf-8", "replace")] = at, value.decode("utf-8", "replace")
        at += len(line) + 2
    return fields


_FIELDS = ("file string, at long, next long, page long, type string, digest string, refers long, "
           "length long, payload binary")
_NAMES = ("WARC-Type", "WARC-Record-ID", "WARC-Payload-Digest", "WARC-Refers-To", "Content-Length")
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
          pa.int64(), pa.binary())


def _number(text: str | None) -> int | None:
    found = re.fullmatch("<urn:page:(-?[0-9]+)>", text or "")
    return int(found[1]) if found else None


def _candidates(keep_payload: bool):
    """``file, content`` → every place that looks like a record, its end and what stands there.

    A response's digest is that of the bytes read; a revisit has none, so its header tells it.
    """
    def looks(path: str, data: bytes) -> Iterator[tuple]:
        at, end, fields = data.find(MAGIC), -1, {}
        while at >= 0:
            first = at + len(MAGIC)
            if end < at:  # places before one header end share its lines, which are read once
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    return
                fields, digests = _header(data, first, end), {}
            own = {k: fields[k][1] for k in _NAMES if k in fields and fields[k][0] >= first}
            if "WARC-Type" in own and re.fullmatch("[0-9]{1,18}", own.get("Content-Length", "")):
                begin = end + 4
                stop = begin + int(own["Content-Length"])
                if data[stop:stop + len(RECORD_END)] == RECORD_END.encode():
                    kind, told = own["WARC-Type"], own.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    if kind != "revisit" and stop not in digests:
                        digests[stop] = _digest(data[begin:stop])
                    yield (path, at, stop + len(RECORD_END), _number(own.get("WARC-Record-ID")),
                           kind, told if kind == "revisit" else digests[stop],
                           _number(own.get("WARC-Refers-To")), stop - begin,
                           data[begin:stop] if keep_payload else None)
            at = data.find(MAGIC, at + 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FIELDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = looks(path, content.as_py())
                while part := list(islice(rows, 200)):
                    yield pa.record_batch(
                        [pa.array([r[i] for r in part], k) for i, k in enumerate(_KINDS)], names)

    return task


def reachable(links: DataFrame) -> DataFrame:
    """``file, at`` of the candidates that a file's start reaches, by pointer jumping.

    Each round doubles the length of the jumps; the rows never exceed the candidates.
    """
    jumps = written(links.select("file", "at", "next"), "jumps")
    found = written(jumps.where("at = 0").select("file", "at"), "reached")
    while True:
        step = found.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        grown = written(found.unionByName(step.join(links, ["file", "at"], "left_semi"))
                        .distinct(), "reached")
        ahead = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        longer = written(jumps.join(ahead, ["file", "next"]).select(
            "file", "at", F.col("after").alias("next")), "jumps")
        found, jumps = grown, longer
        if not longer.head(1):
            return found


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``page, type, digest, refers, length, payload`` of every record of the files under ``path``.

    A file is read by one task, so files should stay small enough for a task's memory; ``write``
    bounds their records and bytes. A file whose records do not reach its last byte raises an error.
    Without ``payloads`` the files are read once and the payloads stay null.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.col("path").alias("file"), "length", "content")
    files = listed.select("file", "content")
    found = written(files.mapInArrow(_candidates(False), _FIELDS), "candidates")
    true = reachable(found.select("file", "at", "next"))
    ends = found.select("file", "at", "next").join(true, ["file", "at"], "left_semi").groupBy(
        "file").agg(F.max("next").alias("reached"))
    short = listed.select("file", "length").join(ends, "file", "left").where(
        F.col("length") != F.coalesce("reached", F.lit(0)))
    if broken := short.head(1):
        raise ValueError("records reach byte {reached} of {length} of {file}".format(
            **broken[0].asDict()))
    if payloads:
        found = files.mapInArrow(_candidates(True), _FIELDS)
    return found.join(true, ["file", "at"], "left_semi").drop("file", "at", "next")


def resolved(records: DataFrame) -> DataFrame:
    """``page, payload_bytes, payload_digest, type, refers`` per record.

    The digest of a response is that of the payload read; a revisit has its size from the
    response that it refers to.
    """
    own = records.select(
        "page", "type", "refers",
        F.when(F.col("type") == "response", F.col("length")).alias("length"), "digest")
    sizes = own.where("length is not null").groupBy("digest").agg(F.max("length").alias("full"))
    repeats = own.where("type <> 'response'").join(sizes, "digest", "left")
    columns = ["page", F.coalesce("length", "full").alias("payload_bytes"),
               F.col("digest").alias("payload_digest"), "type", "refers"]
    return own.where("type = 'response'").withColumn("full", F.col("length")).select(
        *columns).unionByName(repeats.select(*columns))
