"""Benchmark decontamination as a prefix-filtered set join.

A window of an item occurs in a document only if all its shingles do, so it is enough to look for
one of them: the rarest, which is the prefix that a containment of one asks for. Rarity is counted
over all documents. A shingle found at a place fixes where the window would begin, which must lie
within the document; the window is there if its first and its last shingle stand at their places,
since these two cover it. Shingles are compared as text, so a containment found is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.llm.words import word_array
from veritable.sources.scratch import written

WINDOW = 10
SHINGLE = 5
#: Distinct benchmark shingles (some 60 bytes each) up to which they are sent to every executor.
BROADCAST_SHINGLES = 200_000
#: Keys of contaminated rows up to which they are.
BROADCAST_KEYS = 1_000_000


def _shingles(words: Column, width: int) -> Column:
    """Shingle texts by place; none if there are fewer words."""
    last = F.size(words) - width
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                       lambda i: F.array_join(F.slice(words, i + 1, width), " "))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<string>"))


def _windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``item, words``: runs of ``window`` words, or the whole item if it has fewer."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"), word_array(F.col(text_col)).alias("all_words")
    ).where(F.size("all_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all_words") - window + 1, F.lit(1)))
    return items.select("item", "all_words", F.explode(starts).alias("at")).select(
        "item", F.slice("all_words", F.col("at"), window).alias("words"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with one key for equal id and text, which have equal results; a null id is a key too."""
    doc = F.col(id_col)
    return docs.select(
        F.coalesce(doc, F.lit(-1)).alias("doc"), F.xxhash64(doc.isNull(), text_col).alias("digest"),
        F.col(id_col).alias("id"), word_array(F.col(text_col)).alias("words"))


_KEY = ["doc", "digest"]


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str,
                item_text_col: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``doc, digest, start, width, window`` of every occurrence, and ``window, item``."""
    if window > 2 * shingle:
        raise ValueError("two shingles must cover a window")
    runs = written(_windows(benchmark, item_col, item_text_col, window), "windows")
    text = F.array_join("words", " ").alias("window")
    width = F.least(F.size("words"), F.lit(shingle))
    windows = runs.select(text, "words", F.size("words").alias("width"), width.alias("k")).distinct()
    grams = written(
        windows.select(
            "window", "width", "k",
            F.posexplode(F.transform(
                F.sequence(F.lit(0), F.col("width") - F.col("k")),
                lambda i: F.array_join(F.slice("words", i + 1, F.col("k")), " "))
            ).alias("offset", "gram")), "grams")
    wanted = grams.select("gram", "k").distinct()
    widths = sorted(r.k for r in wanted.select("k").distinct().collect())
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)

    rows = _keyed(docs, id_col, text_col)
    found = [
        rows.select(*_KEY, F.size("words").alias("n"),
                    F.posexplode(_shingles(F.col("words"), k)).alias("pos", "gram"))
        .join(wanted.where(F.col("k") == k).select("gram"), "gram", "left_semi")
        for k in widths]
    if not found:
        found = [rows.select(*_KEY, F.lit(0).alias("n"), F.lit(0).alias("pos"),
                             F.lit("").alias("gram")).limit(0)]
    places = written(reduce(DataFrame.unionByName, found).distinct(), "places")

    rarity = places.groupBy("gram").agg(F.count(F.lit(1)).alias("places"))
    ends = grams.groupBy("window", "width").agg(
        F.min_by("gram", "offset").alias("first"), F.max_by("gram", "offset").alias("last"),
        F.max("offset").alias("last_offset"))
    prefix = (
        grams.join(rarity, "gram", "left")
        .withColumn("places", F.coalesce("places", F.lit(0)))
        .groupBy("window").agg(F.min(F.struct("places", "gram", "offset")).alias("rarest"))
        .where("rarest.places > 0")
        .select("window", F.col("rarest.gram").alias("gram"), "rarest.offset")
        .join(ends, "window"))
    begun = (
        places.join(written(prefix, "prefix"), "gram")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0 and start + width <= n")
        .select(*_KEY, "start", "width", "window", "first", "last",
                (F.col("start") + F.col("last_offset")).alias("last_start")))

    def at(place: str, gram: str) -> DataFrame:
        return places.select(*_KEY, F.col("pos").alias(place), F.col("gram").alias(gram))

    whole = begun.join(at("start", "first"), [*_KEY, "start", "first"], "left_semi").join(
        at("last_start", "last"), [*_KEY, "last_start", "last"], "left_semi")
    hits = written(whole.select(*_KEY, "start", "width", "window").distinct(), "hits")
    return hits, runs.select(text, "item").distinct()


def _covered(spans: Column) -> Column:
    """Words inside at least one of the sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(so_far: Column, span: Column) -> Column:
        end = span["start"] + span["width"]
        fresh = end - F.greatest(so_far["reach"], span["start"])
        return F.struct((so_far["n"] + F.greatest(fresh, F.lit(0))).alias("n"),
                        F.greatest(so_far["reach"], end).alias("reach"))

    return F.aggregate(spans, start, add, lambda x: x["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``id, n_words, n_hit, items, contaminated`` per row of ``docs``.

    ``items`` holds the sorted ids (text) of the items with an occurring window. Null text has no
    words; an item without words has no window; windows of an item without an id count as hits
    but name no item. Repeated rows get equal results. What is gathered per document is bounded by
    the document's own words.
    """
    hits, names = occurrences(
        docs, benchmark, id_col, text_col, item_col, item_text_col, window, shingle)
    spans = hits.groupBy(_KEY).agg(
        _covered(F.array_sort(F.collect_set(F.struct("start", "width")))).alias("n_hit"))
    items = (
        hits.select(*_KEY, "window").distinct().join(names, "window")
        .groupBy(_KEY).agg(F.array_sort(F.collect_set("item")).alias("items")))
    found = written(spans.join(items, _KEY, "left"), "contamination")
    none = F.array().cast("array<string>")
    return _keyed(docs, id_col, text_col).select(
        "id", *_KEY, F.size("words").cast("long").alias("n_words")
    ).join(found, _KEY, "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
          shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark.

    Repeated rows go or stay together; an empty table, or an empty benchmark, gives ``docs`` as they
    are. The keys of the rows that go are broadcast behind a check of their number, so that the texts
    that stay are not shuffled.
    """
    hits, _ = occurrences(docs, benchmark, id_col, text_col, item_col, item_text_col, window, shingle)
    names = [f"_{c}_{'_'.join(docs.columns)}" for c in _KEY]
    doc = F.col(id_col)
    marked = docs.select(
        "*", F.coalesce(doc, F.lit(-1)).alias(names[0]),
        F.xxhash64(doc.isNull(), text_col).alias(names[1]))
    bad = written(hits.select(*(F.col(c).alias(n) for c, n in zip(_KEY, names))).distinct(), "bad")
    if bad.count() <= BROADCAST_KEYS:
        bad = F.broadcast(bad)
    return marked.join(bad, names, "left_anti").select(docs.columns)
