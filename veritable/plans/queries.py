"""Every operator as a named query over the dirty fixtures of one scale factor.

Decimals are cast to DOUBLE at the end so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.functions import dates, text
from veritable.operators import evaluate, profile, report, rules, score, standardize
from veritable.operators.evaluate import Frames
from veritable.plans import phases
from veritable.sources.fixtures import FIXTURE_KEYWORDS, FIXTURES, DirtyFrames, unnormalized
from veritable.sources.raw import (
    default_paths,
    line_faults,
    normalize_nulls,
    number_rows,
    read_all,
    read_csv,
    read_lines,
)
from veritable.sources.schemas import ENTITIES
from veritable.sources.scratch import new_path, written
from veritable.sources.tables import Store, write_csv

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = dt.datetime(2025, 1, 1)
SECOND_RUN = dt.datetime(2025, 2, 1)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def over_frames(build: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(DirtyFrames(spark, sf_dir))


def _rule(table: str, name: str, ruleset: str = "sql") -> Query:
    def build(frames: Frames) -> DataFrame:
        chosen = [r for r in rules.RULESETS[ruleset]() if (r.table, r.name) == (table, name)]
        return evaluate.violations_log(frames, chosen)

    return over_frames(build)


def _cell(*names: str) -> Query:
    """Violations of some cell rules, with the rule's name to tell them apart."""
    def build(frames: Frames) -> DataFrame:
        chosen = [r for r in rules.cell_rules() if r.name.startswith(names)]
        log = evaluate.violations_log(frames, chosen)
        return log.select("table_name", "dimension", "rule_name", "record_id")

    return over_frames(build)


def sql_card(frames: Frames) -> DataFrame:
    return score.scorecard(evaluate.violation_counts(frames, rules.sql_rules()))


def cell_card(frames: Frames) -> DataFrame:
    return score.scorecard(evaluate.violation_counts(frames, rules.cell_rules()), exact=False)


def products_audit(frames: Frames) -> DataFrame:
    return standardize.standardize_products(frames["products"], FIXTURE_KEYWORDS)


def _tagged(frames: Frames) -> DataFrame:
    return standardize.standardize_categories(frames["products"], FIXTURE_KEYWORDS)


# --- loading --------------------------------------------------------------------------


def load_normalized_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_nulls(unnormalized(spark, sf_dir, "products"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products written as CSV and scanned back as text."""
    path = new_path(spark, "products_csv")
    write_csv(unnormalized(spark, sf_dir, "products"), path)
    return read_csv(spark, path, ENTITIES["products"].raw_schema)


def raw_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, new_path(spark, "store"), register=False)
    return store.write_raw(DirtyFrames(spark, sf_dir))


def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered entity written as CSV, found by its path and scanned: rows and filled cells."""
    folder = new_path(spark, "erp_csv")
    paths = default_paths(folder)
    for name in FIXTURES:
        write_csv(unnormalized(spark, sf_dir, name), paths[name])
    return evaluate.union_all([
        df.agg(F.count(F.lit(1)).alias("row_count"),
               sum(F.count(c) for c in df.columns).alias("cells"))
        .select(F.lit(name).alias("table_name"), "row_count", "cells")
        for name, df in read_all(spark, paths).items()])


def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads: every row twice."""
    store = Store(spark, new_path(spark, "store"), register=False)
    frames = DirtyFrames(spark, sf_dir)
    store.write_raw(frames, "append")
    return store.write_raw(frames, "append")


def raw_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, a reset and an appended load: every row once."""
    store = Store(spark, new_path(spark, "store"), register=False)
    frames = DirtyFrames(spark, sf_dir)
    store.write_raw(frames)
    store.reset_raw()
    return store.write_raw(frames, "append")


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw and a staging table of one name, written twice and found by layer in the catalog."""
    store = Store(spark, new_path(spark, "store"))
    store.create_layers()
    products = DirtyFrames(spark, sf_dir)["products"]
    for _ in range(2):
        stored = store.write(products, "raw", "products")
        store.write(stored.where("category IS NOT NULL"), "staging", "products")
    counted = "count(*) AS row_count, count(DISTINCT category) AS categories"
    return spark.sql(f"SELECT 'raw' AS layer, {counted} FROM raw.products UNION ALL "
                     f"SELECT 'staging' AS layer, {counted} FROM staging.products")


def raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lines of which some have a cell too many or an open quote: the rejects by line and
    reason, and the number of lines loaded."""
    columns = ENTITIES["products"].columns
    cells = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    tail = F.right("sku", F.lit(2))
    cells[1] = F.when(tail.isin("57", "91"), F.concat(F.lit('"'), cells[1])).otherwise(cells[1])
    extra = F.when(tail.isin("13", "91"), ",EXTRA").otherwise("")
    line = F.concat(F.concat_ws(",", *cells), extra)
    path = new_path(spark, "lines")
    unnormalized(spark, sf_dir, "products").select(line.alias(",".join(columns))).write.csv(
        path, header=True, quote="\u0000", sep="\u0001", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False)
    store = Store(spark, new_path(spark, "store"), register=False)
    schema = ENTITIES["products"].raw_schema
    split = store.write_split(
        read_lines(spark, path, schema), "raw", "products", line_faults(schema), "raw_rejects",
        {c: F.col(c) for c in columns}, max_rejected=None)
    loaded = split.accepted.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("string").alias("line"), F.lit("loaded").alias("reason"), "n")
    return loaded.unionByName(split.rejects.select("line", "reason", F.lit(1).alias("n")))


def staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw inventory into staging, keyed by key and warehouse: wrong dates and repeated keys."""
    entity = ENTITIES["inventory"]
    store = Store(spark, new_path(spark, "store"), register=False)
    rows = standardize.with_repeats(DirtyFrames(spark, sf_dir)["inventory"], entity)
    split = store.write_split(
        rows, "staging", "inventory", standardize.staging_faults(rows, entity), "staging_rejects",
        standardize.staged_columns(entity), max_rejected=0.9)
    staged = split.accepted.agg(F.count(F.lit(1)).alias("n")).select(
        *[F.lit(None).cast("string").alias(c) for c in ("key", "column", "raw_value")],
        F.lit("staged").alias("reason"), "n")
    return staged.unionByName(
        split.rejects.select("key", "column", "raw_value", "reason", F.lit(1).alias("n")))


# --- values that the plain fixtures lack -----------------------------------------------


def casing(frames: Frames) -> DataFrame:
    """Both trims and both capitalizations of values with digits, tabs and inner marks."""
    raw = F.concat(F.lit(" \t"), F.lower("product_name"), F.lit("3d-x o'B "), F.col("category"),
                   F.lit("\t "))
    return frames["products"].select("sku", "category", raw.alias("value")).select(
        "sku", F.trim("value").alias("trimmed"), text.strip(F.col("value")).alias("stripped"),
        text.initcap(F.trim("value")).alias("initcap"),
        text.title(text.strip(F.col("value"))).alias("title"),
        text.differs_from_initcap(F.col("category")).alias("not_initcap"),
        text.differs_from_title(F.col("category")).alias("not_title"))


def key_prefixes(frames: Frames) -> DataFrame:
    """Prefix operations on keys of which some have no letters."""
    sku = F.regexp_replace("sku", "^(ITM|PROD)", "")
    return frames["products"].select(sku.alias("key")).select(
        "key", text.leading_letters(F.col("key")).alias("prefix"),
        text.without_prefix(F.col("key")).alias("rest"),
        text.replace_prefix(F.col("key"), "SKU").alias("rewritten"))


def rule_sku_without_letters(frames: Frames) -> DataFrame:
    bare = frames["products"].withColumn("sku", F.regexp_replace("sku", "^(ITM|PROD)", ""))
    chosen = [r for r in rules.sql_rules() if r.name == "non_standard_sku_prefix"]
    return evaluate.violations_log({"products": bare}, chosen)


def rule_sign_with_zero(frames: Frames) -> DataFrame:
    """Quantities that end in 7 become zero, which fits either sign."""
    change = F.col("quantity_change")
    some = frames["inventory_transactions"].withColumn(
        "quantity_change", F.when(change.endswith("7"), "0").otherwise(change))
    chosen = [r for r in rules.sql_rules() if r.name == "sign_mismatch"]
    return evaluate.violations_log({"inventory_transactions": some}, chosen)


# --- the log and its sinks ------------------------------------------------------------


def full_log(frames: Frames) -> DataFrame:
    return evaluate.violations_log(frames, rules.sql_rules())


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log stored by table and dimension, read back and counted."""
    store = Store(spark, new_path(spark, "store"), register=False)
    log = store.write_log(full_log(DirtyFrames(spark, sf_dir)))
    return log.groupBy("table_name", "dimension", "rule_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("records"))


def record_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violations of the last bad record of each table, looked up one by one in the stored log."""
    store = Store(spark, new_path(spark, "store"), register=False)
    log = store.write_log(full_log(DirtyFrames(spark, sf_dir)))
    last = log.groupBy("table_name").agg(F.max("record_id").alias("record_id")).collect()
    return evaluate.union_all([
        report.record_violations(log, r.table_name, r.record_id).select(*evaluate.LOG_COLUMNS)
        for r in last])


def catalog_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of the twelve rules and of one more, which is found as a view of the session."""
    frames = DirtyFrames(spark, sf_dir)
    frames["products"].createOrReplaceTempView("user_products")
    spark.sql("""CREATE OR REPLACE TEMPORARY VIEW v_user_short_name AS
        SELECT 'products' AS table_name, 'validity' AS dimension, 'short_name' AS rule_name,
          sku AS record_id, product_name AS detail
        FROM user_products WHERE length(product_name) < 10""")
    try:
        views = evaluate.catalog_views(spark, spark.catalog.currentDatabase(), "v_user_*")
        store = Store(spark, new_path(spark, "store"), register=False)
        log = store.write_log(evaluate.whole_log(frames, rules.sql_rules(), views))
    finally:
        for name in ("v_user_short_name", "user_products"):
            spark.catalog.dropTempView(name)
    return as_double(score.scorecard_from_log(log, score.row_counts(frames)), "quality_score")


def surplus_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus products of a numbered load, whose files hold the products by the digest of their key."""
    path = new_path(spark, "products_csv")
    products = unnormalized(spark, sf_dir, "products")
    write_csv(products.repartitionByRange(5, F.md5("sku")).sortWithinPartitions(F.md5("sku")), path)
    schema = ENTITIES["products"].raw_schema
    numbered = number_rows(read_lines(spark, path, schema))
    surplus = [r for r in rules.cell_rules(F.col("row_number")) if r.name.startswith("surplus_")]
    log = evaluate.violations_log({"products": numbered}, surplus)
    return log.select("table_name", "dimension", "rule_name", "record_id")


def appended_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys in two loads, the second with a tenth of the first: those that clash."""
    database = f"keys_{uuid.uuid4().hex}"
    orders = DirtyFrames(spark, sf_dir)["purchase_orders"].select("purchase_order_id")
    odd = F.right("purchase_order_id", F.lit(1)).isin("1", "3", "5", "7", "9")
    ending = F.right("purchase_order_id", F.lit(1)) == "9"
    store = Store(spark, new_path(spark, "store"), database=database)
    spark.sql(f"CREATE DATABASE {database}")
    keys = ("purchase_order_id",)
    store.append_keys(orders.where(odd), "orders", keys)
    known = written(store.known_keys(orders.where(~odd | ending), "orders", keys), "known")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return known


def scorecard_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored log ⋈ stored row counts."""
    frames = DirtyFrames(spark, sf_dir)
    store = Store(spark, new_path(spark, "store"), register=False)
    log = store.write_log(full_log(frames))
    rows = store.write(score.row_counts(frames), "governance", "table_row_counts")
    return as_double(score.scorecard_from_log(log, rows), "quality_score")


def rule_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve rules queried through their views."""
    names = evaluate.create_rule_views(DirtyFrames(spark, sf_dir), rules.sql_rules())
    union = " UNION ALL ".join(f"SELECT dimension, record_id FROM {n}" for n in names)
    return spark.sql(f"SELECT dimension, count(*) AS n FROM ({union}) GROUP BY dimension")


def flexible_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published SQL function on both date columns of the purchase orders."""
    dates.register_sql_functions(spark)
    orders = DirtyFrames(spark, sf_dir)["purchase_orders"]
    return orders.select(
        "purchase_order_id",
        F.expr("parse_flexible_date(order_date)").alias("order_date"),
        F.expr("parse_flexible_date(expected_delivery_date)").alias("expected_delivery_date"),
    )


# --- staging --------------------------------------------------------------------------


def _date_audit(table: str) -> Query:
    return over_frames(lambda f: standardize.standardize_table_dates(f[table], table))


def _staging(table: str) -> Query:
    def build(frames: Frames) -> DataFrame:
        audit = standardize.standardize_table_dates(frames[table], table)
        typed = standardize.to_staging(standardize.final_dates(audit, table), ENTITIES[table])
        return as_double(typed, *[c for c, t in typed.dtypes if t.startswith("decimal")])

    return over_frames(build)


def staging_typed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = standardize.final_products(products_audit(DirtyFrames(spark, sf_dir)))
    return as_double(standardize.to_staging(final, ENTITIES["products"]), "price")


def staging_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that could not be primary keys: none for orders, all for a careless choice."""
    frames = DirtyFrames(spark, sf_dir)
    by_order = standardize.key_problems(frames["purchase_orders"], ["purchase_order_id"])
    by_pair = standardize.key_problems(frames["products"], ["product_name", "supplier_id"])
    return by_order.select(
        F.lit("purchase_orders").alias("table_name"), F.col("purchase_order_id").alias("key"), "n",
    ).unionByName(by_pair.select(
        F.lit("products").alias("table_name"),
        F.concat("product_name", F.lit("|"), F.coalesce("supplier_id", F.lit("-"))).alias("key"),
        "n",
    ))


def sku_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colliding rewritten keys of products and inventory; products have none."""
    frames = DirtyFrames(spark, sf_dir)

    def of(table: str) -> DataFrame:
        clashes = standardize.collisions(standardize.standardize_sku_prefix(frames[table]))
        return clashes.select(F.lit(table).alias("table_name"), "sku_clean", "n")

    return of("products").unionByName(of("inventory"))


def staging_wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of fifteen digits and five places through the staging types."""
    products = DirtyFrames(spark, sf_dir)["products"]
    wide = F.concat(F.lit("123456789"), F.lpad(F.length("sku").cast("string"), 6, "4"), F.lit(".12345"))
    typed = standardize.to_staging(products.withColumn("price", wide), ENTITIES["products"])
    return typed.select("sku", F.col("price").cast("string").alias("price"))


def staging_lost_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that raw text → staging types would lose if dates were not standardized first."""
    frames = DirtyFrames(spark, sf_dir)
    return evaluate.union_all([
        standardize.lost_casts(frames[t], ENTITIES[t]).select(
            F.lit(t).alias("table_name"), "column", "lost")
        for t in ("products", "inventory")
    ])


def category_by_keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories from a table of keywords: pieces of the parts' names, the first part's piece first."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    piece = F.substr(F.col("p_name"), (1 + F.col("p_partkey") % 4).cast("int"),
                     (3 + F.col("p_partkey") % 5).cast("int"))
    keywords = part.select(F.lower(piece).alias("keyword"), "p_partkey", "p_brand").groupBy(
        "keyword").agg(F.min("p_partkey").alias("priority"),
                       F.min_by("p_brand", "p_partkey").alias("category"))
    products = DirtyFrames(spark, sf_dir)["products"]
    return standardize.standardize_categories(products, written(keywords, "keywords")).select(
        "sku", "product_name", "category_clean")


def category_medians_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians from the sketches of two loads: rows, and whether the rank is within 3 % of them."""
    tagged = _tagged(DirtyFrames(spark, sf_dir)).withColumn("price", F.col("price").try_cast("double"))
    even = F.right("sku", F.lit(1)).isin("0", "2", "4", "6", "8")
    loads = [written(standardize.median_sketches(df, "category_clean", "price"), "sketches")
             for df in (tagged.where(even), tagged.where(~even))]
    medians = written(
        standardize.sketched_medians(evaluate.union_all(loads), "category_clean"), "medians")
    below, upto = (F.count_if(F.col("price") < F.col("median")),
                   F.count_if(F.col("price") <= F.col("median")))
    n = F.max("n")
    return tagged.join(medians, "category_clean").groupBy("category_clean").agg(
        n.alias("n"), ((below <= 0.53 * n) & (upto >= 0.47 * n)).alias("close"))


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of two loads, the second added without reading the first."""
    frames = DirtyFrames(spark, sf_dir)
    store = Store(spark, new_path(spark, "store"), register=False)
    for load in (0, 1):
        part = {t: df.where(F.pmod(F.hash(df.columns[0]), F.lit(2)) == load)
                for t, df in frames.items()}
        merged = phases.profile_load(store, part, f"load-{load}")
    exact = profile.column_profile(frames).select(
        "table", "column", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.08 * F.col("exact")
    return merged.join(exact, ["table", "column"]).select(
        "table", "column", "row_count", "null_count", "null_pct", "whitespace_dirty_count",
        close.alias("distinct_close"))


# --- reports --------------------------------------------------------------------------


def drillthrough(frames: Frames) -> DataFrame:
    table, dimension = "purchase_orders", "consistency"
    log = evaluate.violations_log(
        frames, rules.select_rules(rules.sql_rules(), table, dimension))
    return report.drill_through(
        log, frames[table], "purchase_order_id", table, dimension)


def _remediated(frames: Frames) -> Frames:
    final = standardize.final_products(products_audit(frames))
    return {**frames, "products": final.withColumn("price", F.col("price").cast("string"))}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score history of two runs: before and after the products were standardized."""
    frames = DirtyFrames(spark, sf_dir)
    store = Store(spark, new_path(spark, "store"), register=False)
    store.append_history(score.history_snapshot(sql_card(frames), FIRST_RUN))
    return store.append_history(
        score.history_snapshot(sql_card(_remediated(frames)), SECOND_RUN))


def history_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run appended twice and the second once: one snapshot of each."""
    frames = DirtyFrames(spark, sf_dir)
    store = Store(spark, new_path(spark, "store"), register=False)
    for when, card in ((FIRST_RUN, sql_card(frames)), (FIRST_RUN, sql_card(frames)),
                       (SECOND_RUN, sql_card(_remediated(frames)))):
        kept = store.append_history(score.history_snapshot(card, when))
    return as_double(kept, "quality_score").withColumn(
        "measured_at", F.date_format("measured_at", "yyyy-MM-dd"))


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(history(spark, sf_dir), "quality_score").drop("measured_at")


def score_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = score.score_trend(history(spark, sf_dir))
    return as_double(trend, "quality_score", "previous_score", "change").withColumn(
        "measured_at", F.date_format("measured_at", "yyyy-MM-dd"))


def remediation(frames: Frames) -> DataFrame:
    return report.remediation_summary(products_audit(frames), frames)


def review_queue(frames: Frames) -> DataFrame:
    by_hand = [r for r in rules.sql_rules()
               if r.name in ("duplicate_product_supplier", "orphan_supplier_id")]
    return report.review_queue(frames, _tagged(frames), by_hand)


def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = DirtyFrames(spark, sf_dir)
    row = report.headline(
        written(sql_card(frames), "scorecard"),
        written(score.row_counts(frames), "row_counts"),
        written(remediation(frames), "remediation"),
    )
    return as_double(row, *[c for c, t in row.dtypes if t.startswith("decimal")])


QUERIES: dict[str, Query] = {
    # loading
    "load_normalized_products": load_normalized_products,
    "csv_roundtrip": csv_roundtrip,
    "raw_load_counts": raw_load_counts,
    "raw_append": raw_append,
    "raw_reset": raw_reset,
    "registry_scan": registry_scan,
    "raw_rejects": raw_rejects,
    "layers": layers,
    "table_row_counts": over_frames(score.row_counts),
    # rules, one row per record
    "rule_completeness_products": _rule("products", "missing_required_field"),
    "rule_completeness_po": _rule("purchase_orders", "missing_required_field"),
    "rule_uniqueness": _rule("products", "duplicate_product_supplier"),
    "rule_orphan_supplier": _rule("products", "orphan_supplier_id"),
    "rule_non_positive_price": _rule("products", "non_positive_price"),
    "rule_category": _rule("products", "non_canonical_category"),
    "rule_delivery_status": _rule("purchase_orders", "non_canonical_delivery_status"),
    "rule_transaction_type": _rule("inventory_transactions", "non_canonical_transaction_type"),
    "rule_sku_prefix": _rule("products", "non_standard_sku_prefix"),
    "rule_date_format": _rule("purchase_orders", "non_primary_date_format"),
    "rule_po_dates": _rule("purchase_orders", "delivery_before_order"),
    "rule_sign": _rule("inventory_transactions", "sign_mismatch"),
    "rule_sku_without_letters": over_frames(rule_sku_without_letters),
    "rule_sign_with_zero": over_frames(rule_sign_with_zero),
    "casing": over_frames(casing),
    "key_prefixes": over_frames(key_prefixes),
    "rule_views": rule_views,
    "catalog_rules": catalog_rules,
    "record_lookup": record_lookup,
    "flexible_dates": flexible_dates,
    "violations_log": over_frames(full_log),
    "violation_counts": over_frames(
        lambda f: evaluate.violation_counts(f, rules.sql_rules())),
    # scores
    "scorecard": over_frames(lambda f: as_double(sql_card(f), "quality_score")),
    "scorecard_from_log": scorecard_from_log,
    "scorecard_domain": over_frames(
        lambda f: as_double(score.domain_scorecard(sql_card(f)), "overall_score")),
    "scorecard_worst_first": over_frames(
        lambda f: as_double(score.worst_scores(sql_card(f)), "quality_score")),
    # rules, one row per cell
    "cell_completeness": _cell("missing_"),
    "surplus_duplicates": _cell("surplus_"),
    "surplus_in_file_order": surplus_in_file_order,
    "orphan_untrimmed": _cell("orphan_"),
    "title_case_rules": _cell("non_canonical_"),
    "date_accuracy": _cell("off_format_"),
    "cell_log": over_frames(
        lambda f: evaluate.cell_log(evaluate.violations_log(f, rules.cell_rules()))),
    "cell_scorecard": over_frames(cell_card),
    "cell_domain": over_frames(lambda f: score.cell_domain_scorecard(cell_card(f))),
    # profiling
    "column_profile": over_frames(profile.column_profile),
    "profile_merged": profile_merged,
    "null_offenders": over_frames(
        lambda f: profile.null_offenders(profile.column_profile(f))),
    "duplicate_checks": over_frames(profile.duplicate_checks),
    "fk_checks": over_frames(profile.reference_checks),
    "prefix_distribution": over_frames(lambda f: profile.prefix_distribution(f["products"])),
    "date_violations": over_frames(profile.date_violations),
    "date_violation_counts": over_frames(profile.date_violation_counts),
    # standardization
    "category_clean": over_frames(
        lambda f: standardize.standardize_categories(f["products"], FIXTURE_KEYWORDS)
        .select("sku", "category", "category_clean")),
    "category_inferred": over_frames(
        lambda f: _tagged(f).filter("category IS NULL")
        .select("sku", "product_name", "category_clean")),
    "category_by_keyword_table": category_by_keyword_table,
    "category_medians_sketched": category_medians_sketched,
    "category_medians": over_frames(lambda f: standardize.category_medians(_tagged(f))),
    "sku_clean": over_frames(
        lambda f: standardize.standardize_sku_prefix(f["products"]).select("sku", "sku_clean")),
    "sku_collisions": sku_collisions,
    "price_imputed": over_frames(
        lambda f: products_audit(f).select("sku", "category_clean", "price", "price_clean")),
    "po_dates_standardized": _date_audit("purchase_orders"),
    "inventory_dates_standardized": _date_audit("inventory"),
    "date_recovery_counts": over_frames(standardize.all_date_recovery_counts),
    "staging_products_audit": over_frames(products_audit),
    "staging_products_final": over_frames(
        lambda f: standardize.final_products(products_audit(f))),
    "staging_key_check": staging_key_check,
    "appended_keys": appended_keys,
    "staging_wide_numbers": staging_wide_numbers,
    "staging_lost_casts": staging_lost_casts,
    "staging_rejects": staging_rejects,
    "staging_typed_products": staging_typed_products,
    "staging_typed_po": _staging("purchase_orders"),
    "staging_typed_inventory": _staging("inventory"),
    # reports
    "dimension_counts": over_frames(lambda f: report.dimension_counts(sql_card(f))),
    "top_category": over_frames(lambda f: report.top_category(sql_card(f))),
    "composition": over_frames(
        lambda f: as_double(report.composition(sql_card(f)), "pct_of_violations")),
    "prevalence": over_frames(
        lambda f: as_double(report.prevalence(sql_card(f), score.row_counts(f)),
                            "prevalence_pct")),
    "heatmap": over_frames(
        lambda f: as_double(report.heatmap(sql_card(f)), *report.DIMENSIONS)),
    "drillthrough": over_frames(drillthrough),
    "remediation_summary": over_frames(remediation),
    "review_queue": over_frames(review_queue),
    "headline": headline,
    # sinks
    "sink_roundtrip": sink_roundtrip,
    "history_append": history_append,
    "history_rerun": history_rerun,
    "score_trend": score_trend,
}
