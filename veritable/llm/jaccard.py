"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact array intersection.

Two sets within the threshold share an element of their prefixes: the few rarest elements of each,
in one order for all sets. So the documents of a shared prefix element are a group, and only groups
are searched. A group is cut into bands of size, each a threshold wide, so that a set meets its own
band and the next; a band is dealt in tiles. In a tile, the XOR of two hashed bitmaps has at most one
bit per element that only one set holds. Its bit count bounds the overlap from above, and what is left
is intersected exactly, as sorted arrays of hashes.

Near copies would make every pair of a group pass. So groups are first searched from set to set,
leaving out what was reached already (a spanning forest, by exact checks); after that only pairs of
different components are looked at, in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.components import connected_components
from veritable.sources.scratch import written

WIDTH = 5
#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters that rank shingles by how many sets hold them; a counter may serve several shingles,
#: which changes the order of the prefixes and so the work, but no result.
COUNTERS = 1 << 20
#: Bytes of hashes that one tile of the first search holds, and sets on the held side of the second.
TILE_BYTES = 64 << 20
TILE_SETS = 2048
#: Sets that make a component worth joining with others before all pairs are looked at.
LARGE_COMPONENT = 16
#: One more element in the longer prefix for so many of the set.
MORE_SHARED = 10
#: Bits of a signature for each element, rounded up to a power of two.
BITS_PER_ELEMENT = 2
#: Rows of a few numbers that are broadcast at most; beyond that, Spark chooses how to join them.
BROADCAST_ROWS = 1_000_000
#: Words whose hashes a task remembers, and entries that are compared at once.
HELD_WORDS = 300_000
COMPARED = 1 << 21

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_FACTORS = np.random.default_rng(5).integers(0, 2 ** 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes | None, width: int, known: _WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a short text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array([known[w] for w in words], np.uint64)
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += (hashes[k:len(hashes) - width + 1 + k] ^ _MIX[0]) * _FACTORS[k % len(_FACTORS)]
        total ^= total >> np.uint64(29)
    for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
        total = (total ^ (total >> np.uint64(shift))) * factor
    return np.unique(total ^ (total >> np.uint64(31)))


def node_of(hashes: np.ndarray) -> int:
    """A set's number: even, since an odd one marks a base element (``_tokens``)."""
    return np.uint64(xxhash.xxh64_intdigest(hashes.tobytes()) & ~1).astype(np.int64).item()


# --- prefixes -------------------------------------------------------------------------


_SETS = "id long, key long, n long, node long, part int, counts binary"


def _counted(width: int, parts: int):
    """``id, key, text`` → a row per document, and how many sets of the task fall on each counter."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _WordHashes(), np.zeros(COUNTERS, np.int64)
        shift = np.uint64(64 - (COUNTERS - 1).bit_length())
        names = ["id", "key", "n", "node", "part", "counts"]
        for batch in batches:
            sets = [shingle_set(t.as_py(), width, known) for t in batch.column(2)]
            if sets:
                total += np.bincount((np.concatenate(sets) >> shift).astype(np.int64),
                                     minlength=COUNTERS)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        if total.any():
            pieces = [p.tobytes() for p in total.reshape(parts, -1)]
            none = pa.nulls(parts, pa.int64())
            yield pa.record_batch([none] * 4 + [pa.array(range(parts), pa.int32()),
                                                pa.array(pieces, pa.binary())], names)

    return task


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part → one row per part."""
    part, total = None, None
    for batch in batches:
        for p, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            more = np.frombuffer(counts.as_py(), np.int64)
            if p == part:
                total = total + more
                continue
            if part is not None:
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([total.tobytes()])],
                                      ["part", "counts"])
            part, total = p, more
    if part is not None:
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([total.tobytes()])],
                              ["part", "counts"])


def rarity(counts: DataFrame, parts: int) -> np.ndarray:
    """The logarithm of each counter over all documents: a fixed number of bytes at any input."""
    each = counts.select("part", "counts", (F.spark_partition_id() % 32).alias("salt"))
    schema = "part int, counts binary"
    first = each.repartition("part", "salt").sortWithinPartitions("part").select(
        "part", "counts").mapInArrow(_summed, schema)
    last = first.repartition("part").sortWithinPartitions("part").mapInArrow(_summed, schema)
    levels = np.zeros((parts, COUNTERS // parts), np.uint8)
    for row in last.collect():  # as many rows as parts
        levels[row.part] = np.log2(np.frombuffer(row.counts, np.int64) + 1).astype(np.uint8)
    return levels.reshape(-1)


def in_order(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The elements from rare to frequent, in one order for all sets."""
    level = levels[(hashes >> np.uint64(64 - (len(levels) - 1).bit_length())).astype(np.int64)]
    return hashes[np.argsort(level, kind="stable")]


def base_size(n, percent: int):
    """Two sets within the threshold share one of so many of their rarest elements."""
    return n - -(-percent * n // 100) + 1


def more_shared(n):
    """With so many elements more in each prefix, they share so many more of them."""
    return n // MORE_SHARED


def _tokens(width: int, percent: int, levels):
    """``text`` → ``token, node`` for the longer prefix of each set; an odd node marks the base."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _WordHashes(), set()
        for batch in batches:
            tokens, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for text in batch.column(0):
                hashes = shingle_set(text.as_py(), width, known)
                node = node_of(hashes) if len(hashes) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                base = base_size(len(hashes), percent)
                rare = in_order(hashes, levels.value)[:base + more_shared(len(hashes))]
                tokens.append(rare.view(np.int64))
                nodes.append(node | (np.arange(len(rare)) < base))
            if len(seen) > HELD_WORDS:
                seen.clear()
            yield pa.record_batch([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(nodes))],
                                  ["token", "node"])

    return task


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token and node → those of tokens that several sets have, each once."""
    held = np.empty((0, 2), np.int64)
    given = None  # the token whose rows were given away last, and the last of them
    for batch in chain(batches, [None]):
        rows = held
        if batch is not None:
            rows = np.concatenate([held, np.column_stack([c.to_numpy() for c in batch.columns])])
        if not len(rows):
            continue
        rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])]
        same = rows[1:, 0] == rows[:-1, 0]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        if given is not None:
            shared[rows[:, 0] == given[0]] = True
            shared[0] &= tuple(rows[0]) != given
        done = len(rows) if batch is None else len(rows) - 1
        # the last row waits for the next batch, unless it is known to be shared
        if done < len(rows) and shared[-1]:
            done = len(rows)
        out = rows[:done][shared[:done]]
        held = rows[done:]
        if done:
            given = tuple(rows[done - 1].tolist()) if shared[done - 1] or given == tuple(
                rows[done - 1].tolist()) else None
        yield pa.record_batch([pa.array(out[:, 0]), pa.array(out[:, 1] & ~1),
                               pa.array((out[:, 1] & 1).astype(bool))], ["token", "node", "base"])


def _arrays(width: int):
    """``text`` → ``node, n, hashes, bits``; equal sets of a task once."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _WordHashes(), set()
        for batch in batches:
            sets = {}
            for text in batch.column(0):
                hashes = shingle_set(text.as_py(), width, known)
                node = node_of(hashes)
                if node not in seen:
                    seen.add(node)
                    sets[node] = hashes
            if len(seen) > HELD_WORDS:
                seen.clear()
            yield pa.record_batch(
                [pa.array(list(sets), pa.int64()),
                 pa.array([s.tobytes() for s in sets.values()], pa.binary()),
                 pa.array([signature(s).tobytes() for s in sets.values()], pa.binary())],
                ["node", "hashes", "bits"])

    return task


# --- signatures and exact checks ------------------------------------------------------


def signature(hashes: np.ndarray) -> np.ndarray:
    """A bitmap in which each element flips one bit; its width follows the size of the set."""
    width = max(64, 1 << (BITS_PER_ELEMENT * len(hashes) - 1).bit_length())
    at = (hashes & np.uint64(width - 1)).astype(np.int64)
    flips = np.bincount(at, minlength=width) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(bits: list[np.ndarray]) -> np.ndarray:
    """Signatures of one width: the upper half of a wider one is laid over the lower."""
    width = min(map(len, bits))
    out = np.empty((len(bits), width), np.uint64)
    for k, b in enumerate(bits):
        while len(b) > width:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        out[k] = b
    return out


def needed(total, percent: int):
    """The least overlap of two sets of ``total`` elements together that links them."""
    return -(-percent * total // (100 + percent))


def _may_link(left, left_n, right, right_n, percent: int):
    """Pairs whose overlap, as bounded by the bits in which they differ, may be enough."""
    step = max(1, COMPARED // max(1, left.shape[0] * left.shape[1]))
    for at in range(0, len(right), step):
        part, total = right[at:at + step], left_n[:, None] + right_n[at:at + step]
        differ = np.bitwise_count(left[:, None, :] ^ part[None]).sum(axis=2, dtype=np.int64)
        i, j = np.nonzero((total - differ) // 2 >= needed(total, percent))
        yield i, j + at


def _overlaps(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of exact intersections of a sorted array with others."""
    every = np.concatenate(others)
    place = np.searchsorted(one, every)
    hit = one[np.minimum(place, len(one) - 1)] == every
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat(hit.astype(np.int64), starts)


def _by_width(sets: list[np.ndarray]) -> dict[int, tuple[int, np.ndarray]]:
    """Per signature width of sets sorted by size: where its sets start, and their signatures.

    The sets of twice the width follow, folded to it: partners differ by that much at most.
    """
    bits = [signature(s) for s in sets]
    widths = np.array([len(b) for b in bits])
    out = {}
    for width in np.unique(widths).tolist():
        low, high = np.searchsorted(widths, [width, 2 * width + 1])
        out[width] = low, _folded(bits[low:high])
    return out


def forest(sets: list[np.ndarray], nodes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join what links join among these sets: at most one per set."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, nodes = [sets[k] for k in order], nodes[order]
    sizes = np.array([len(s) for s in sets])
    by_width = _by_width(sets)
    widths = sorted(by_width)
    left = np.ones(len(sets), bool)
    for start in range(len(sets)):
        if not left[start]:
            continue
        left[start], queue = False, [start]
        while queue:
            at = queue.pop()
            low, high = np.searchsorted(
                sizes, [-(-percent * sizes[at] // 100), 100 * sizes[at] // percent + 1])
            rest = low + np.flatnonzero(left[low:high])
            if not len(rest):
                continue
            least = min(at, int(rest[0]))
            first, bits = next(by_width[w] for w in reversed(widths) if by_width[w][0] <= least)
            near = np.concatenate([j for _, j in _may_link(
                bits[at - first][None], sizes[at:at + 1], bits[rest - first], sizes[rest], percent)])
            rest = rest[near]
            if not len(rest):
                continue
            same = _overlaps(sets[at], [sets[k] for k in rest])
            linked = rest[same >= needed(sizes[at] + sizes[rest], percent)]
            left[linked] = False
            queue += linked.tolist()
            yield from ((int(nodes[at]), int(nodes[k])) for k in linked)


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _search(percent: int):
    """``group, tile, node, hashes`` sorted by group and tile → a spanning forest of each tile."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []

        def found() -> pa.RecordBatch:
            return _links(list(forest(sets, np.array(nodes, np.int64), percent)) if len(sets) > 1 else [])

        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3))
            for group, tile, node, hashes in rows:
                if (group, tile) != key:
                    yield found()
                    key, nodes, sets = (group, tile), [], []
                if nodes and nodes[-1] == node:
                    continue  # rows are sorted by node, too
                nodes.append(node)
                sets.append(np.frombuffer(hashes.as_py(), np.uint64))
        yield found()

    return task


def _cross(percent: int):
    """``token, band, tile, follows, node, component, n, bits``, sorted → pairs that may be links."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            found: list[tuple[int, int]] = []
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][:4] == rows[at][:4]:
                    end += 1
                if rows[at][:3] != key:
                    key, held = rows[at][:3], []
                fresh, follows = rows[at:end], rows[at][3]
                if not follows:
                    found += _pairs(fresh, fresh, percent)
                if held:
                    found += _pairs(held, fresh, percent)
                if not follows:
                    held = held + fresh
                at = end
            yield _links(found)

    return task


def _pairs(left: list[tuple], right: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    same = left is right
    bits = _folded([np.frombuffer(r[7], np.uint64) for r in (left if same else left + right)])
    nodes, parts, sizes = (np.array([r[k] for r in left], np.int64) for k in (4, 5, 6))
    more, other, larger = (np.array([r[k] for r in right], np.int64) for k in (4, 5, 6))
    for i, j in _may_link(bits[:len(left)], sizes, bits[-len(right):], larger, percent):
        keep = parts[i] != other[j]
        if same:
            keep &= i < j
        yield from zip(np.minimum(nodes[i], more[j])[keep].tolist(),
                       np.maximum(nodes[i], more[j])[keep].tolist())


def _exact(percent: int):
    """``a, b`` with both arrays → the pairs within the threshold."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(x.as_py(), np.uint64) for x in (left, right))
                if _overlaps(one, [two])[0] >= needed(len(one) + len(two), percent):
                    found.append((a, b))
            yield _links(found)

    return task


# --- the join -------------------------------------------------------------------------


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of numbers if it is small, so that arrays and texts stay in place."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _distinct_groups(members: DataFrame) -> DataFrame:
    """``token, size`` of one token for each set of members: near copies share most of their tokens."""
    alike = F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("alike")
    groups = members.groupBy("token").agg(F.count(F.lit(1)).alias("size"), alike).where("size > 1")
    return groups.groupBy("size", "alike").agg(F.min("token").alias("token")).select("token", "size")


def _tied(members: DataFrame, tied: DataFrame | None) -> DataFrame:
    """Members with their component; a set without a link is its own."""
    if tied is None:
        return members.withColumn("component", F.col("node"))
    return members.join(tied, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _components(tied: DataFrame | None, links: DataFrame) -> DataFrame:
    if tied is not None:
        links = links.unionByName(tied.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return written(connected_components(links), "tied")


def _seeded(rows: DataFrame, arrays: DataFrame, percent: int, tile_bytes: int) -> DataFrame:
    """Links within ``token, node, n`` rows: a spanning forest for each token's tiles."""
    tiles = written(
        rows.groupBy("token").agg(F.ceil(F.sum("n") * 8 / tile_bytes).alias("tiles"),
                                  F.count(F.lit(1)).alias("size")).where("size > 1"), "tiles")
    placed = written(rows.join(tiles, "token").select(
        "token", F.pmod(F.xxhash64("node", "token"), "tiles").alias("tile"), "node"), "placed")
    dealt = arrays.select("node", "hashes").join(_small(placed), "node").select(
        "token", "tile", "node", "hashes")
    return dealt.repartition("token", "tile").sortWithinPartitions("token", "tile", "node").mapInArrow(
        _search(percent), "a long, b long")


def _between(members: DataFrame, arrays: DataFrame, percent: int, tile_sets: int) -> DataFrame:
    """All links between different components that share a token."""
    parts = members.groupBy("token", "component").agg(F.count(F.lit(1)).alias("sets"))
    several = written(
        parts.groupBy("token").agg(
            F.max(F.struct("sets", "component"))["component"].alias("largest"),
            F.sum("sets").alias("sets"), F.count(F.lit(1)).alias("parts")).where("parts > 1"),
        "several")
    band = F.floor(F.log(F.col("n")) / math.log(100 / percent) + 1e-9)
    rows = members.join(several.select("token", "largest"), "token").select(
        "token", "node", "component", "n", (F.col("component") != F.col("largest")).alias("held"),
        band.alias("own"))
    counts = written(
        rows.where("held").groupBy("token", "own").agg(
            F.ceil(F.count(F.lit(1)) / tile_sets).cast("long").alias("tiles"))
        .withColumnRenamed("own", "band"), "bands")
    # A held set meets the sets of its own band and, as the smaller band, of the next. The largest
    # component is never held, so its sets go to the bands on both sides.
    bands = F.when(F.col("held"), F.array("own", F.col("own") - 1)).otherwise(
        F.array(F.col("own") - 1, "own", F.col("own") + 1))
    dealt = rows.withColumn("band", F.explode(bands)).join(counts, ["token", "band"])
    home = F.col("held") & (F.col("band") == F.col("own"))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    dealt = dealt.withColumn("home", F.when(home, tile).otherwise(F.lit(-1)))
    last = F.when(home, F.col("home")).otherwise(F.col("tiles") - 1)
    placed = dealt.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    full = placed.join(arrays.select("node", "bits"), "node").select(
        "token", "band", "tile", (F.col("tile") != F.col("home")).alias("follows"), "node",
        "component", "n", "bits")
    order = ("token", "band", "tile")
    pairs = full.repartition(*order).sortWithinPartitions(*order, "follows").mapInArrow(
        _cross(percent), "a long, b long").distinct()
    left, right = (arrays.select(F.col("node").alias(x), F.col("hashes").alias(f"{x}s")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "as", "bs").mapInArrow(
        _exact(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, percent: int = PERCENT, tile_bytes: int = TILE_BYTES,
                    tile_sets: int = TILE_SETS) -> DataFrame:
    """``id, n, component`` per row: the size of its set, and the smallest id that links reach.

    A set holds the distinct shingles of ``width`` words (A-Z in lower case, parted by ASCII white
    space); fewer words make one shingle. Null, empty and wordless texts have the empty set and are
    linked with nothing, not even with each other. Equal sets collapse before the search. Repeated rows
    stay repeated; rows without an id take part, and their component is null if no row that they reach
    has an id. Other columns are ignored; an empty table gives an empty result. Shingles and sets are
    told apart by 64-bit hashes.
    """
    parts = 64
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                        F.col(text_col).cast("binary").alias("text"))
    sets = written(plain.mapInArrow(_counted(width, parts), _SETS), "sets")
    each = sets.where("part is null").select("id", "key", "n", "node")
    levels = docs.sparkSession.sparkContext.broadcast(
        rarity(sets.where("part is not null"), parts))
    tokens = plain.select("text").mapInArrow(
        _tokens(width, percent, levels), "token long, node long")
    shared = written(tokens.repartition("token").sortWithinPartitions("token", "node").mapInArrow(
        _shared, "token long, node long, base boolean"), "shared")

    # A set shares so many elements of its longer prefix with any set that it is linked to, whose size
    # is ``percent`` of its own at least. Only sets that share as many are looked at.
    sizes = each.where("node is not null").groupBy("node").agg(
        F.min("n").alias("n"), F.min(F.struct("id", "key")).alias("row"))
    enough = F.col("shared") >= 1 + F.floor(F.ceil(percent * F.col("n") / 100) / MORE_SHARED)
    kept = written(
        shared.groupBy("node").agg(F.count(F.lit(1)).alias("shared")).join(sizes, "node").where(enough)
        .select("node", "n", "row.id", "row.key"), "kept")
    members = written(shared.where("base").join(kept.select("node", "n"), "node").select(
        "token", "node", "n"), "members")
    texts = plain.alias("p").join(
        _small(kept).alias("k"),
        (F.col("p.key") == F.col("k.key")) & F.col("p.id").eqNullSafe(F.col("k.id")),
        "left_semi").select("text")
    arrays = written(texts.mapInArrow(_arrays(width), "node long, hashes binary, bits binary"), "arrays")

    members = written(members.join(written(_distinct_groups(members), "groups"), "token"), "members")
    chosen = written(members.groupBy("node").agg(
        F.max(F.struct("size", "token"))["token"].alias("token"), F.min("n").alias("n")), "chosen")
    members = members.select("token", "node", "n")
    tied = _components(None, written(_seeded(chosen, arrays, percent, tile_bytes), "links"))
    parts = _tied(members, tied).groupBy("token", "component").agg(
        F.count(F.lit(1)).alias("sets"),
        F.min(F.struct(F.xxhash64("node", "token"), "node", "n")).alias("one"))
    some = parts.where(F.col("sets") >= LARGE_COMPONENT).select("token", "one.node", "one.n")
    tied = _components(tied, written(_seeded(written(some, "some"), arrays, percent, tile_bytes), "links"))
    tied = _components(tied, written(
        _between(_tied(members, tied).select("token", "node", "component", "n"), arrays, percent,
                 tile_sets), "links"))

    known = each.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    known = _tied(known, tied)
    least = known.groupBy("component").agg(F.min("least").alias("least"))
    labels = known.drop("least").join(least, "component").select("node", "least")
    return each.join(labels, "node", "left").select(
        "id", "n", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least")).alias("component"))
