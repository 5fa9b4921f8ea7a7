"""SimHash near-duplicates: fingerprints linked by covering locality-sensitive hashing.

A random family of bit masks finds a pair with some probability; a covering family finds every
pair within the radius. Each bit gets a nonzero vector of radius + 1 bits, and each nonzero vector
v gives one mask: the bits whose vectors are not orthogonal to v. The vectors of at most `radius`
differing bits leave some v orthogonal to all of them, so that mask holds no differing bit and
both fingerprints fall into one bucket of its table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.components import connected_components
from veritable.sources.scratch import written

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
HASH_SEED = 42
#: Distinct fingerprints of a bucket that one task compares; a larger bucket is covered again.
BUCKET_LIMIT = 4096
#: Shingle hashes whose bits are held unpacked at a time.
HASHES_AT_ONCE = 1 << 15


def shingle_hashes(text: str, width: int = SHINGLE_WORDS) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[width - 1:])]


def _fold(hashes: list[int]) -> int:
    """Bit i is 1 if it is set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    values = np.array(hashes, ">u8")
    for at in range(0, len(values), HASHES_AT_ONCE):
        part = values[at:at + HASHES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """``id, key, fp`` (signed 64 bits) per row; ``key`` is a digest of the text.

    Text without words, or null, has fingerprint 0.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_fold(h) if (h := shingle_hashes(t.as_py() or "", width)) else 0
                   for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                  ["id", "key", "fp"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                        F.col(text_col).alias("text"))
    return plain.mapInArrow(task, "id long, key long, fp long")


def covering_masks(bits: int, radius: int = RADIUS) -> list[int]:
    """Masks within ``bits`` such that any `radius` bits are all outside one of them."""
    places = [i for i in range(BITS) if bits >> i & 1]
    vectors = (1 << radius + 1) - 1
    of = {place: 1 + k * 7 % vectors for k, place in enumerate(places)}
    masks = (sum(1 << place for place, m in of.items() if (m & v).bit_count() % 2)
             for v in range(1, vectors + 1))
    return list(dict.fromkeys(masks))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the radius: at most one link per fingerprint."""
    links, left = [], np.ones(len(fps), bool)
    bits = fps.view(np.uint64)  # the bits of a signed number are counted in its absolute value
    for start in range(len(fps)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= radius]
            left[near] = False
            queue += near.tolist()
            links += [(int(fps[at]), int(fps[j])) for j in near]
    return links


_BUCKET = "mask long, key long, fp long, other long"


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """``mask``, fingerprints and wholeness of each bucket of two rows or more, from sorted rows.

    A bucket of over ``limit`` rows comes in several parts that are not whole.
    """
    held, parted = np.empty((0, 3), np.int64), None
    for batch in chain(batches, [None]):
        rows = held
        if batch is not None:
            fresh = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            rows = np.concatenate([held, fresh])
        if not len(rows):
            continue
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        bounds = np.concatenate([[0], cuts, [len(rows)]])
        ended = len(cuts) + (batch is None)
        sizes = np.diff(bounds)[:ended]
        continues = ended > 0 and tuple(rows[0, :2]) == parted
        for k in np.flatnonzero((sizes > 1) | (continues & (np.arange(ended) == 0))):
            part = continues and k == 0 or sizes[k] > limit
            yield int(rows[bounds[k], 0]), rows[bounds[k]:bounds[k + 1], 2], not part
        held = rows[bounds[ended]:]
        if len(held) > limit:
            parted = tuple(held[0, :2])
            yield int(held[0, 0]), held[:, 2], False
            held = held[:0]


def _cover_again(mask: int, fps: np.ndarray, radius: int) -> list[tuple]:
    """Rows of the next tables: the bits outside the bucket's mask are covered in their turn."""
    mask %= 1 << BITS
    inner = covering_masks((1 << BITS) - 1 - mask, radius)
    tables = [_signed(m | mask) for m in inner]
    return [(m, int(fp) & m, int(fp), None) for m in tables for fp in fps]


def _compare(radius: int, limit: int):
    """Sorted bucket rows → links (``fp, other``), and rows with a ``mask`` to be dealt out anew."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
            out.clear()
            return pa.record_batch(columns, ["mask", "key", "fp", "other"])

        for mask, fps, whole in _runs(batches, limit):
            if whole:
                out += [(None, None, a, b) for a, b in _linked(fps, radius)]
            else:
                out += _cover_again(mask, fps, radius)
            if len(out) > 10_000:
                yield emit()
        yield emit()

    return task


def links(fps: DataFrame, radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Distinct fingerprints ``fp`` → ``a, b``: links that join what is within the radius.

    Pairs within the radius end up in one connected component; of a bucket only a spanning
    forest is given out. A bucket of over ``limit`` fingerprints goes to tables that look at more
    bits: the bits that a bucket leaves free halve each time, so the third table at the latest
    holds no more than the limit, and nothing is capped.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks((1 << BITS) - 1, radius)])
    rows = fps.select("fp", F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    found = []
    while rows is not None:
        dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
        out = written(dealt.mapInArrow(_compare(radius, limit), _BUCKET), "buckets")
        found.append(out.where("mask is null").select(
            F.col("fp").alias("a"), F.col("other").alias("b")))
        larger = out.where("mask is not null").select("mask", "key", "fp").distinct()
        rows = larger if larger.head(1) else None
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, radius: int = RADIUS,
                    limit: int = BUCKET_LIMIT) -> DataFrame:
    """``id, key, fp, linked, component`` per row: the smallest id among the documents that links reach.

    ``linked`` tells groups apart even if one id stands in several; ``key`` is a digest of the text.

    Equal fingerprints collapse before the search, so exact copies cost one row. Null or wordless
    text has fingerprint 0 and is linked like any other; rows without an id take part, and their
    component is null if no document that they reach has an id. Repeated rows stay repeated.
    """
    each = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = each.groupBy("fp").agg(F.min("id").alias("least"))
    tied = connected_components(links(distinct.select("fp"), radius, limit))
    known = distinct.join(tied, distinct["fp"] == tied["node"], "left")
    least = known.where("component is not null").groupBy("component").agg(
        F.min("least").alias("component_least"))
    labels = known.join(least, "component", "left").select(
        "fp", F.coalesce("component", "fp").alias("linked"),
        F.coalesce("component_least", "least").alias("component"))
    return each.join(labels, "fp").select("id", "key", "fp", "linked", "component")


def hexadecimal(fp):
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


#: Keys of documents to be left out that are broadcast at most, so that kept texts stay in place.
BROADCAST_KEYS = 1_000_000


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` without near copies: the document with the smallest id of each group stays.

    A document is an id with a text. Repeated rows of a document stay once; several texts under one id
    are judged apart, and of those that are near copies and have the smallest id, the one with the least
    digest stays. A row without an id cannot be told from its copies and stays. An empty table gives
    an empty result; columns are left as they are, whatever their names.
    """
    seen = written(near_duplicates(docs, id_col, text_col, width, radius), "components")
    first = seen.where("id = component")
    several = written(
        first.groupBy("linked").agg(F.min("key").alias("kept"), F.max("key").alias("last"))
        .where("kept < last").select("linked", "kept"), "several")
    copies = seen.where("id <> component").select("id", "key")
    if several.head(1):
        copies = copies.unionByName(
            first.join(several, "linked").where("key <> kept").select("id", "key"))
    copies = written(copies.distinct(), "copies")
    repeated = written(
        seen.where("id is not null").groupBy("id", "key").count().where("count > 1")
        .select("id", "key"), "repeated")
    mine, key = f"_id_{'_'.join(docs.columns)}", f"_key_{'_'.join(docs.columns)}"
    marked = docs.withColumns(
        {mine: F.col(id_col).cast("long"), key: F.xxhash64(text_col)})

    def rows_of(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        some = keys.select(F.col("id").alias(mine), F.col("key").alias(key))
        if keys.count() <= BROADCAST_KEYS:
            some = F.broadcast(some)
        return rows.join(some, [mine, key], how)

    kept = rows_of(copies, "left_anti", marked)
    if not repeated.head(1):
        return kept.select(docs.columns)
    once = rows_of(repeated, "left_semi", kept).dropDuplicates([mine, key])
    return rows_of(repeated, "left_anti", kept).unionByName(once).select(docs.columns)
