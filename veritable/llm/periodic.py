"""Periodic runs of words, found with a dictionary of basic factors.

For each power of two ``size``, equal stretches of ``size`` words get equal names; the names of one
length follow from those of half of it. A run of smallest period q, size < q <= 2 * size, holds a
stretch of ``size`` words that stands once in each period: a primitive period of q words has more
than q / 2 different stretches of that length, so not all of them can stand twice. Its occurrences
are an arithmetic progression of difference q, whose terms are successors at most 2 * size apart.
Three such terms propose a period, which is extended word by word; what a longer stretch of the
same period already covers is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has this many words and this many periods at least.
MIN_WORDS = 6
MIN_PERIODS = 4
#: Words that are compared at once when a run is extended; twice as many each time.
STEP = 64

Run = tuple[int, int, int]


def word_names(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def _reach(names: np.ndarray, at: int, period: int, forward: bool) -> int:
    """How many words from ``at`` on (or before it) equal the one a period later."""
    step, done = STEP, 0
    room = len(names) - period - at if forward else at
    while done < room:
        n = min(step, room - done)
        low = at + done if forward else at - done - n
        differ = names[low:low + n] != names[low + period:low + period + n]
        if differ.any():
            return done + int((differ if forward else differ[::-1]).argmax())
        done, step = done + n, step * 2
    return room


def _proposals(names: np.ndarray, order: np.ndarray, fresh: np.ndarray, size: int) -> np.ndarray:
    """``period, place``, sorted: three occurrences at equal distances, which go on for ``size`` words."""
    gap = np.diff(order)
    same = ~fresh[1:]
    three = same[:-1] & same[1:] & (gap[:-1] == gap[1:]) & (gap[:-1] <= 2 * size)
    if size > 1:
        three &= gap[:-1] > size  # shorter periods were proposed by shorter stretches
    t = np.flatnonzero(three)
    place, period = order[t], gap[t]
    inside = place + period + size < len(names)
    place, period = place[inside], period[inside]
    goes_on = names[place + size] == names[place + period + size]
    place, period = place[goes_on], period[goes_on]
    sort = np.lexsort((place, period))
    return np.column_stack([period[sort], place[sort]])


def periodic_runs(words: np.ndarray, min_words: int = MIN_WORDS,
                  min_periods: int = MIN_PERIODS) -> list[Run]:
    """All runs ``start, length, period`` of numbered words, by start, then period.

    ``min_periods`` must be 4 or more: three occurrences at one distance are then sure to exist.
    """
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods are not proposed")
    found: set[Run] = set()
    names, size = words, 1
    while min_periods * size <= len(words) and len(names) > 2:  # a period is longer than size, or 1
        order = np.argsort(names, kind="stable")
        ranked = names[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if fresh.all():
            break  # nothing stands twice, nor does anything longer
        known = (0, 0, 0)
        named = np.empty(len(names), np.int64)
        named[order] = np.cumsum(fresh) - 1
        for period, place in _proposals(named, order, fresh, size).tolist():
            if known[0] == period and place + period < known[2]:
                continue
            start = place - _reach(words, place, period, False)
            end = place + period + _reach(words, place, period, True)
            known = (period, start, end)
            if end - start >= max(min_words, min_periods * period):
                found.add((start, end - start, period))
        names = named[:-size] * len(named) + named[size:]
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats: of each run, its first period stays."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, every, kept = [], [], []
        for text in batch.column(1):
            words = (text.as_py() or b"").split()
            runs = periodic_runs(word_names(words))
            counts.append(len(words))
            every.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            kept.append(collapse(words, runs))
        yield pa.record_batch(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(every, pa.list_(_RUN)),
             pa.array(kept, pa.binary())], ["id", "n_words", "runs", "kept"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, runs, collapsed`` per row: its runs, and its text without the repetitions.

    Words are what ASCII white space parts. ``runs`` holds ``start`` (word number), ``length`` and
    ``period`` by start, then period; ``collapsed`` joins the kept words by single spaces. Null,
    empty and wordless texts have no runs and an empty collapsed text. Rows are judged one by one, so
    repeated rows stay repeated, a null id stays null, other columns are ignored, and an empty table
    gives an empty result. A text takes time in proportion to n log n for n words.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    out = plain.mapInArrow(
        _task, f"id {kind}, n_words long, "
               "runs array<struct<start: long, length: long, period: long>>, kept binary")
    return out.select("id", "n_words", "runs", F.col("kept").cast("string").alias("collapsed"))


def most_repeated(runs):
    """The run of greatest exact length / period; ties go to the first. Null if there is none."""
    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, better)
