"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter moves the vector of letter counts by a squared distance of
at most two. Squared distances of two blocks of words come from one matrix product, and only pairs
within two are compared letter by letter. A block holds the words of one length and of equal counts
in each of a few classes of letters; the same argument holds for these counts, so a block meets
itself and the blocks that one letter more, or one letter of another class, leads to. Blocks get
finer as the vocabulary grows, and one with many words is dealt over several tasks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.sources.scratch import written

MIN_LETTERS = 6
MIN_COUNT = 5
#: A word's form is at least this many times as frequent.
FORM_RATIO = 5
#: Words on the held side of a product; a block of more is dealt over several tasks.
BLOCK_WORDS = 2048
#: Distinct words that a task holds before it gives its counts away.
HELD_WORDS = 500_000
#: Entries of one product.
PRODUCT = 1 << 22
#: Bins of letter counts. ASCII and Latin-1 letters get a bin each; others may share one, which
#: can only make distances smaller.
BINS = 160
#: Longer words are compared one by one, so that a few of them do not widen a whole block.
WIDTH = 64
#: Words for one more class of letters.
WORDS_PER_CLASS = 8


# --- the vocabulary -------------------------------------------------------------------


def _spoilt(run: str, key: int, every: int) -> str:
    h = zlib.crc32(run.encode(), key)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(min_letters: int, every: int | None):
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def emit() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(counts), pa.string()),
                                   pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = runs.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))
                if every is None:
                    counts.update(found)
                    continue
                key = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(found).items():
                    word = _spoilt(run, key, every)
                    if len(word) >= min_letters:
                        counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield emit()
            if len(counts) > HELD_WORDS:
                yield emit()
        yield emit()

    return task


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
               spoil_every: int | None = None) -> DataFrame:
    """``word, n``: runs of ASCII and Latin-1 letters, A-Z in lower case, that are frequent enough.

    With ``spoil_every``, a run loses a letter in one of so many (document, run) pairs, picked by the
    CRC-32 of ``id:run``. A null text has no words; a null id counts as empty text. Repeated rows
    count as often as they stand there.
    """
    plain = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.col(text_col).cast("binary").alias("text"))
    partial = plain.mapInArrow(_count(min_letters, spoil_every), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- blocks ---------------------------------------------------------------------------


def _classes_for(words: int) -> int:
    return max(2, math.ceil(math.log(max(words, 2)) / math.log(WORDS_PER_CLASS)))


def _class_keys(classes: int) -> np.ndarray:
    """One odd number per class; a block's key is the sum over its letters, modulo 2 ** 64."""
    return np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, classes) | 1


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, the word of each, and the words' lengths."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return points, np.repeat(np.arange(len(words)), lengths), lengths


def _deal(classes: int):
    """``word, n`` → a row per block that the word is compared in: its own, and those it follows."""
    keys = _class_keys(classes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, of, _ = _letters(batch.column(0).to_pylist())
            cell = of * classes + points % classes
            counts = np.bincount(cell, minlength=batch.num_rows * classes).reshape(-1, classes)
            own = (counts * keys).sum(axis=1)
            rows, blocks = [np.arange(batch.num_rows)], [own]
            for j in range(classes):
                has = np.flatnonzero(counts[:, j])
                for step in [keys[j], *(keys[j] - keys[i] for i in range(j))]:
                    rows.append(has)
                    blocks.append(own[has] - step)
            at = np.concatenate(rows)
            follows = np.arange(len(at)) >= batch.num_rows
            yield pa.record_batch(
                [pa.array(np.concatenate(blocks)), pa.array(follows), batch.column(0).take(pa.array(at)),
                 batch.column(1).take(pa.array(at))], ["block", "follows", "word", "n"])

    return task


class _Words:
    """Some words with their letter counts, squared lengths and padded letters."""

    def __init__(self, words, n, counts, norms, padded, lengths):
        self.words, self.n, self.counts = words, n, counts
        self.norms, self.padded, self.lengths = norms, padded, lengths

    @classmethod
    def of(cls, words: list[str], n: np.ndarray) -> _Words:
        points, row, lengths = _letters(words)
        counts = np.bincount(row * BINS + points % BINS, minlength=len(words) * BINS)
        exact = np.float32 if lengths.max(initial=0) < 4096 else np.float64
        counts = counts.reshape(-1, BINS).astype(exact)
        column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        padded = np.zeros((len(words), WIDTH + 2), np.uint32)
        near = column < WIDTH + 2
        padded[row[near], column[near]] = points[near]
        return cls(np.array(words, object), n, counts, (counts ** 2).sum(axis=1), padded, lengths)

    def __getitem__(self, part) -> _Words:
        return _Words(*(getattr(self, name)[part] for name in self.NAMES))

    def __len__(self) -> int:
        return len(self.words)

    def with_more(self, other: _Words) -> _Words:
        return _Words(*(np.concatenate([getattr(self, name), getattr(other, name)])
                        for name in self.NAMES))

    NAMES = ("words", "n", "counts", "norms", "padded", "lengths")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` of ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def _verified(left: _Words, i: np.ndarray, right: _Words, j: np.ndarray) -> np.ndarray:
    """Which pairs are exactly one edit apart."""
    gap = right.lengths[j] - left.lengths[i]
    good = np.zeros(len(i), bool)
    long = np.maximum(right.lengths[j], left.lengths[i]) > WIDTH
    for p in np.flatnonzero(long):
        good[p] = one_edit(left.words[i[p]], right.words[j[p]])
    equal = np.flatnonzero((gap == 0) & ~long)
    good[equal] = (left.padded[i[equal]] != right.padded[j[equal]]).sum(axis=1) == 1
    for sign, one, other, at, to in ((1, left, right, i, j), (-1, right, left, j, i)):
        p = np.flatnonzero((gap == sign) & ~long)
        short, more = one.padded[at[p]][:, :-1], other.padded[to[p]]
        first = (short != more[:, :-1]).argmax(axis=1)
        later = np.arange(short.shape[1]) >= first[:, None]
        good[p] = ~((short != more[:, 1:]) & later).any(axis=1)
    return good


def _near(left: _Words, right: _Words | None = None) -> Iterator[tuple]:
    """Pairs one edit apart: between two blocks, or (without ``right``) within one."""
    other = left if right is None else right
    step = max(1, PRODUCT // max(1, len(left)))
    for at in range(0, len(other), step):
        part = other[at:at + step]
        square = left.norms[:, None] + part.norms - 2 * (left.counts @ part.counts.T)
        i, j = np.nonzero(square <= 2)
        if right is None:
            later = i < j + at
            i, j = i[later], j[later]
        if not len(i):
            continue
        good = _verified(left, i, part, j)
        i, j = i[good], j[good]
        yield left.words[i], left.n[i], part.words[j], part.n[j]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its own words first → links in both directions."""
    held_key, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        follows = batch.column(2).to_numpy(zero_copy_only=False)
        words = _Words.of(batch.column(3).to_pylist(), batch.column(4).to_numpy())
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        found: list[tuple] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
            key = tuple(keys[a].tolist())
            if key != held_key:
                held_key, held = key, None
            middle = a + int((~follows[a:b]).sum())
            if middle > a:
                fresh = words[a:middle]
                if len(fresh) > 1:
                    found += _near(fresh)
                if held is not None:
                    found += _near(held, fresh)
                held = fresh if held is None else held.with_more(fresh)
            if held is not None and b > middle:
                found += _near(held, words[middle:b])
        if found:
            left, left_n, right, right_n = (np.concatenate(c) for c in zip(*found))
            both = [np.concatenate(c) for c in ((left, right), (right, left), (right_n, left_n))]
            yield pa.record_batch([pa.array(both[0], pa.string()), pa.array(both[1], pa.string()),
                                   pa.array(both[2])], ["word", "near", "near_n"])


def near_words(words: DataFrame, classes: int | None = None,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n`` (distinct words) → ``word, near, near_n``: all pairs one edit apart, both ways.

    ``classes`` of letters cut the blocks; by default there are more for more words, which changes
    the work and not the result. The words of a block are held ``block_words`` at a time, the words
    of the blocks that follow it pass by.
    """
    if classes is None:
        classes = _classes_for(words.count())
    dealt = words.select("word", "n").mapInArrow(
        _deal(classes), "block long, follows boolean, word string, n long")
    tile = F.pmod(F.xxhash64("word"), F.col("tiles")).alias("tile")
    sizes = written(
        dealt.where("not follows").groupBy("block").agg(
            F.ceil(F.count(F.lit(1)) / block_words).cast("long").alias("tiles")), "blocks")
    met = dealt.join(sizes, "block").withColumn("own", tile)
    # A following word meets every tile; a word of the block its own, and the lower ones as a follower.
    last = F.when(F.col("follows"), F.col("tiles") - 1).otherwise(F.col("own"))
    rows = met.select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("tile"), "follows", "own",
        "word", "n").select(
        "block", "tile", (F.col("follows") | (F.col("tile") < F.col("own"))).alias("follows"),
        "word", "n")
    sorted_rows = rows.repartition("block", "tile").sortWithinPartitions("block", "tile", "follows")
    return sorted_rows.mapInArrow(_compare, "word string, near string, near_n long")


# --- forms ----------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word, form`` → ``word, root``: follow forms to the end, twice as far in each round.

    A form is several times as frequent as its word, so chains are short and never close.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(at.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "roots")
        if not at.where("moved").head(1):
            return at.select("word", "root")
        at = at.select("word", "root")


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, n`` → ``word, form, root, n, n_near, form_n``, one row per word.

    ``form`` is the most frequent word one edit away (ties: the first in code-point order) if it is at
    least ``ratio`` times as frequent, else null; ``root`` is where forms lead to, the word itself if
    it has none. An empty table gives an empty result.
    """
    words = written(words.select("word", "n"), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
