"""SentencePiece encoding through a table of distinct chunks.

A chunk is a run of whitespace markers and the characters up to the next marker. If no piece of the
vocabulary holds a marker behind another character, no merge can cross the start of a chunk, so a
text's ids are its chunks' ids in order. ``encode_by_table`` gathers the distinct chunks of the
corpus, segments each of them once, in the library, and joins the ids back by position: the most
frequent chunks go to every task, the others meet their ids in a join. In ``encode`` the table is each
task's own: a chunk is segmented once by every task that meets it, and nothing moves.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.sources.scratch import written

MARK = "▁"
#: Chunks that a task's table holds before it starts anew, and the longest one that it holds.
TABLE_CHUNKS = 300_000
CHUNK_CHARS = 64
#: Distinct chunks that a task holds before it gives their counts away, and that every task is sent.
HELD_CHUNKS, FREQUENT_CHUNKS = 1_000_000, 300_000
#: Characters of text that are encoded and returned together (a longer text goes alone).
CHARS_AT_ONCE = 1 << 20


def pieces_stay_in_chunks(model: sentencepiece.SentencePieceProcessor, proto: bytes) -> bool:
    """Whether chunks can be segmented apart: piece shapes, and a normalizer that changes nothing."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(proto)
    norm = spec.normalizer_spec
    plain = (norm.add_dummy_prefix and norm.escape_whitespaces
             and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
             and not spec.trainer_spec.treat_whitespace_as_suffix)
    return plain and not any(
        MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size()))


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker (the library puts that one back)."""
    parts = text.replace(" ", MARK).split(MARK)
    if "" not in parts:
        return parts
    out, extra = [], 0
    for part in parts[:-1]:
        if part:
            out.append(" " * extra + part)
            extra = 0
        else:
            extra += 1
    return [*out, " " * extra + parts[-1]]


class Encoder:
    """Encodes texts as the library does, by chunk where the vocabulary allows it."""

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.by_chunk = pieces_stay_in_chunks(self.model, proto)
        self.mark = self._packed([self.model.piece_to_id(MARK)])
        self.begin = self._packed([self.model.bos_id()])
        self.end = self._packed([self.model.eos_id()])
        self.table: dict[str, bytes] = {}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _segment(self, new: list[str]) -> list[bytes]:
        coded = self.model.encode(new, num_threads=1)
        return [self._packed(ids) if chunk else self.mark for chunk, ids in zip(new, coded)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids with begin and end as little-endian unsigned 32-bit integers."""
        if not self.by_chunk:
            return [self.begin + self._packed(ids) + self.end
                    for ids in self.model.encode(texts, num_threads=1)]
        if len(self.table) > TABLE_CHUNKS:
            self.table.clear()
        split = [chunks(t) if t else [] for t in texts]
        new = list({c for each in split for c in each if c not in self.table})
        here = dict(zip(new, self._segment(new)))
        table = self.table
        table.update((c, ids) for c, ids in here.items() if len(c) <= CHUNK_CHARS)
        long = {c: ids for c, ids in here.items() if len(c) > CHUNK_CHARS}
        if long:
            join = lambda each: b"".join(table[c] if c in table else long[c] for c in each)
        else:
            join = lambda each: b"".join(map(table.__getitem__, each))
        return [self.begin + join(each) + self.end for each in split]

    def decode(self, packed: bytes) -> str:
        return self.model.decode(np.frombuffer(packed, "<u4").tolist())


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, held, chars = 0, [], 0
    for at in range(len(texts)):
        text = texts[at].as_py() or ""
        if held and chars + len(text) > CHARS_AT_ONCE:
            yield start, held
            start, held, chars = at, [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield start, held


def encode(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text",
           decode: bool = True, ids: bool = False) -> DataFrame:
    """``id, packed, decoded, ids`` per row: ids with begin and end, packed as little-endian
    unsigned 32-bit integers, what they decode to, and the ids as an array (each if asked for).

    ``proto`` is the model file's content; it travels with the tasks, so executors need no path.
    Null counts as empty text and yields begin and end alone. A text without a marker is one
    chunk. Rows, repeated ones too, stay as they are.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(proto)
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                packed = encoder.encode(texts)
                back = [encoder.decode(p) for p in packed] if decode else [None] * len(packed)
                each = [np.frombuffer(p, "<i4") if ids else None for p in packed]
                yield pa.record_batch(
                    [batch.column(0).slice(start, len(texts)), pa.array(packed, pa.binary()),
                     pa.array(back, pa.string()), pa.array(each, pa.list_(pa.int32()))],
                    ["id", "packed", "decoded", "ids"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(task, "id long, packed binary, decoded string, ids array<int>")


# --- one table for all texts ----------------------------------------------------------


def _key(chunk: str) -> str:
    """A chunk, or in place of a long one a digest, which is longer than any chunk that stands itself."""
    if len(chunk) <= CHUNK_CHARS:
        return chunk
    return "#" + hashlib.sha256(chunk.encode("utf-8", "surrogatepass")).hexdigest()


def _narrow(encoder: Encoder) -> str:
    """The narrowest type that holds every id; what moves is as wide as that."""
    return "<u2" if encoder.model.get_piece_size() <= 1 << 16 else "<u4"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    held = 0

    def emit() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(counts), pa.string()),
                               pa.array(list(counts.values()), pa.int64())], ["chunk", "n"])
        counts.clear()
        return out

    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            if text:
                counts.update(chunks(text))
                held += len(text)
                if len(counts) > HELD_CHUNKS or held > 64 * HELD_CHUNKS:
                    yield emit()
                    held = 0
    yield emit()


def chunk_table(docs: DataFrame, proto: bytes, text_col: str = "text") -> DataFrame:
    """``key, n, ids``: each distinct chunk of all texts with its count and its ids, segmented once."""
    narrow = _narrow(Encoder(proto))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(proto)
        for batch in batches:
            for start, some in _slices(batch.column(0)):
                yield pa.record_batch(
                    [pa.array([_key(c) for c in some], pa.string()), batch.column(1).slice(start, len(some)),
                     pa.array([np.frombuffer(p, "<u4").astype(narrow).tobytes()
                               for p in encoder._segment(some)], pa.binary())], ["key", "n", "ids"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted, "chunk string, n long")
    distinct = counts.groupBy("chunk").agg(F.sum("n").alias("n"))
    return written(distinct.mapInArrow(task, "key string, n long, ids binary"), "chunks")


def _frequent_from(table: DataFrame, most: int) -> int:
    """The least count, a power of two, that at most ``most`` short chunks have."""
    powers = table.where(F.length("key") <= CHUNK_CHARS).groupBy(
        F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("v")).collect()
    held, least = 0, 62
    for r in sorted(powers, key=lambda r: -r.p):
        held += r.v
        if held > most:
            break
        least = r.p
    return 1 << least


_PARTS = "id long, known binary, places binary, rare array<struct<i: int, key: string>>"


def _looked_up(frequent, width: int):
    """``id, text`` → ids of the frequent chunks, the distinct others, and where these belong: pairs of
    the number of known ids since the place before and of the chunk that stands there."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequent.value
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                known, places, rare = [], [], []
                for text in texts:
                    split = chunks(text) if text else []
                    found = [table.get(c) for c in split]
                    new: dict[str, int] = {}
                    gaps, at = [], 0
                    for chunk, ids in zip(split, found):
                        if ids is None:
                            gaps += (at, new.setdefault(_key(chunk), len(new)))
                            at = 0
                        else:
                            at += len(ids) // width
                    known.append(b"".join([ids for ids in found if ids is not None]))
                    places.append(np.array(gaps, "<i4").tobytes())
                    rare.append([{"i": i, "key": key} for key, i in new.items()])
                yield pa.record_batch(
                    [batch.column(0).slice(start, len(texts)), pa.array(known, pa.binary()),
                     pa.array(places, pa.binary()),
                     pa.array(rare, pa.list_(pa.struct([("i", pa.int32()), ("key", pa.string())])))],
                    ["id", "known", "places", "rare"])

    return task


def _assembled(begin: bytes, end: bytes, narrow: str):
    """``id, known, places, found`` → ``id, ids``."""
    width = np.dtype(narrow).itemsize
    begin, end = (np.frombuffer(p, "<u4").astype(narrow).tobytes() for p in (begin, end))

    def whole(known: bytes, places: bytes, found: list | None) -> np.ndarray:
        ids = {r["i"]: r["ids"] for r in found or ()}
        out, done = [begin], 0
        for gap, i in np.frombuffer(places, "<i4").reshape(-1, 2).tolist():
            out += (known[done:done + width * gap], ids[i])
            done += width * gap
        return np.frombuffer(b"".join([*out, known[done:], end]), narrow).astype("<i4")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                yield pa.record_batch(
                    [some.column(0), pa.array([whole(*(c[k].as_py() for c in some.columns[1:]))
                                               for k in range(some.num_rows)], pa.list_(pa.int32()))],
                    ["id", "ids"])

    return task


def encode_by_table(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text",
                    frequent: int = FREQUENT_CHUNKS) -> DataFrame:
    """``id, ids`` per row, as ``encode`` gives them, through one table of the distinct chunks of all texts.

    At most ``frequent`` short chunks are sent to every task; the others of a text meet their ids in a
    join, once per text. A vocabulary whose pieces cross markers has no chunks, and texts are encoded whole.
    """
    encoder = Encoder(proto)
    if not encoder.by_chunk:
        return encode(docs, proto, id_col, text_col, decode=False, ids=True).select("id", "ids")
    table = chunk_table(docs, proto, text_col)
    least = _frequent_from(table, frequent)
    sent = (F.col("n") >= least) & (F.length("key") <= CHUNK_CHARS)
    common = docs.sparkSession.sparkContext.broadcast(
        {r.key: bytes(r.ids) for r in table.where(sent).toLocalIterator()})
    narrow = _narrow(encoder)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    each = written(plain.mapInArrow(_looked_up(common, np.dtype(narrow).itemsize), _PARTS).withColumn(
        "row", F.monotonically_increasing_id()), "pieces")
    found = (
        each.select("row", F.explode("rare").alias("r")).select("row", "r.i", "r.key")
        .join(table.where(~sent).select("key", "ids"), "key")
        .groupBy("row").agg(F.collect_list(F.struct("i", "ids")).alias("found")))
    return each.drop("rare").join(found, "row", "left").select("id", "known", "places", "found").mapInArrow(
        _assembled(encoder.begin, encoder.end, narrow), "id long, ids array<int>")
