"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.llm import (
    decontam,
    jaccard,
    langid,
    licenses,
    maxent,
    mtree,
    oracles,
    periodic,
    pieces,
    pii,
    simhash,
    urlfilter,
    variants,
    warc,
)
from veritable.sources.scratch import new_path

PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hexadecimal("fp").alias("fingerprint"),
        F.col("component").alias("component_id"))


def id_crc(id_col: str = "doc_id"):
    """CRC-32 of an id as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (id_crc() % 4 == 2).alias("held_out"))
    model = langid.fit(docs.where("not held_out"))
    return docs.select("doc_id", "held_out", langid.predict(model, F.col("text")).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.ambiguous")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.spans(pii.fit(docs), F.col("text")).alias("s"))

    def of_base(kind: str | None = None):
        wanted = lambda s: s["base"] if kind is None else s["base"] & (s["kind"] == kind)
        return F.filter("s", wanted)

    return found.select(
        "doc_id", *[F.size(of_base(k)).cast("long").alias(f"n_{k}")
                    for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.written_spans(of_base()).cast("binary"), 256).alias("base_sha256"),
        pii.written_spans(F.col("s")).alias("spans"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urlfilter.train(urlfilter.labelled_urls(spark))
    return urlfilter.judge(_table(spark, sf_dir, "pages"), weights).withColumnRenamed("id", "page_id")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    found = mtree.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def piece_model(name: str = PIECES) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(_table(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        F.col("id").alias("doc_id"), (F.length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    found = licenses.scan(_table(spark, sf_dir, "documents"))
    starts = F.col("base.word")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"), "score")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return maxent.score(docs, id_crc() % 7 == 2).withColumnRenamed("id", "doc_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.read(spark, path, payloads=False))
    return found.select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers").alias("refers_to"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.vocabulary(_table(spark, sf_dir, "documents"), spoil_every=199)
    return variants.group_variants(words)


def planted_periods(docs: DataFrame) -> DataFrame:
    """Some texts with a planted repetition: from word ``at`` on, ``period`` words again and again."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    place = lambda word, i: F.when(i < F.col("at"), word).otherwise(F.get(
        "words", (F.col("at") + (i - F.col("at")) % F.col("period")).cast("int")))
    return (
        docs.select("doc_id", "text", F.when(h % 10 == 0, F.array_remove(
            F.split("text", r"[\x20\x09-\x0D]+", -1), "")).alias("words"))
        .withColumn("at", g % n).withColumn("period", 1 + F.floor((n - F.col("at")) / (3 + g % 8)))
        .select("doc_id", F.when(n > 0, F.array_join(F.transform("words", place), " "))
                .otherwise(F.col("text")).alias("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_periods(_table(spark, sf_dir, "documents"))
    found = periodic.find_runs(docs).withColumn("best", periodic.most_repeated(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_url_filter": op5_url_filter,
    "op6_top_k": op6_top_k,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_license_scan": op8_license_scan,
    "op9_lm_scores": op9_lm_scores,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_jaccard_join": op13_jaccard_join,
}
ORACLES: dict[str, str] = {
    "op3_decontamination": oracles.DECONTAMINATION,
    "op6_top_k": oracles.TOP_K,
    "op10_warc": oracles.WARC,
    "op11_spelling_variants": oracles.VARIANTS,
    "op12_periodic_runs": oracles.PERIODIC_RUNS,
    "op13_jaccard_join": oracles.JACCARD,
}
