"""One key holds a third of the rows: joins split it and results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritable.operators import evaluate, keyed, report, rules, standardize

ROWS = 60_000
HOT = ROWS // 3


@pytest.fixture
def small_splits(settings):
    """Shrink adaptive execution's sizes so that this small table has a skewed partition."""
    settings(**{
        "autoBroadcastJoinThreshold": "-1",
        "adaptive.autoBroadcastJoinThreshold": "-1",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "adaptive.advisoryPartitionSizeInBytes": "16KB",
        "adaptive.skewJoin.skewedPartitionFactor": "2",
    })


@pytest.fixture
def hot_products(spark, tmp_path):
    """A third of the products share name, supplier and category; the rest come in pairs."""
    i = F.col("id")
    hot = i % 3 == 0
    df = spark.range(0, ROWS, 1, 16).select(
        F.concat(F.lit("PRO"), F.lpad(i.cast("string"), 9, "0")).alias("sku"),
        F.when(hot, "same").otherwise(F.concat(F.lit("name "), F.floor(i / 6).cast("string")))
        .alias("product_name"),
        F.when(hot, "Tools").otherwise(F.concat(F.lit("Group "), (i % 50).cast("string")))
        .alias("category"),
        F.when(i % 7 == 0, None).otherwise((i % 1000).cast("string")).alias("price"),
        F.when(hot, "SUP999").otherwise(F.concat(F.lit("SUP"), (i % 100).cast("string")))
        .alias("supplier_id"),
    )
    df.write.parquet(str(tmp_path / "products"))
    return spark.read.parquet(str(tmp_path / "products"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def sql_rule(name):
    return next(r for r in rules.sql_rules() if r.name == name)


def cell_rule(name):
    return next(r for r in rules.cell_rules() if r.name == name)


def test_duplicates_split_the_hot_key(hot_products, small_splits):
    ids = evaluate.rule_violations(
        {"products": hot_products}, sql_rule("duplicate_product_supplier"))
    sizes = hot_products.groupBy("product_name", "supplier_id").count().filter("count > 1")
    assert ids.count() == sizes.agg(F.sum("count")).first()[0] >= HOT
    assert "skew=true" in final_plan(ids)


def test_the_log_keeps_the_split_when_it_is_stored(spark, hot_products, small_splits):
    """The rebalance before the write neither undoes the split nor makes one task per folder."""
    frames = {"products": hot_products, "suppliers": spark.createDataFrame(
        [("SUP1",)], "supplier_id string")}
    log = evaluate.violations_log(frames, rules.select_rules(rules.sql_rules(), "products"))
    stored = log.hint("rebalance", "table_name", "dimension")
    plan = final_plan(stored)
    assert plan.count("skew=true") == 2
    assert stored.rdd.getNumPartitions() > 8


def test_surplus_splits_the_hot_key(hot_products, small_splits):
    ids = evaluate.rule_violations(
        {"products": hot_products}, cell_rule("surplus_product_supplier"))
    groups = hot_products.select("product_name", "supplier_id").distinct().count()
    assert ids.count() == ids.distinct().count() == ROWS - groups
    assert "skew=true" in final_plan(ids)


def test_surplus_of_exact_copies(spark, monkeypatch):
    """A third of all rows are one and the same row: all but one are surplus."""
    monkeypatch.setattr(keyed, "COPIES_PER_TASK_ROW", 1000)
    copies = spark.range(HOT).select(
        F.lit("PRO1").alias("sku"), F.lit("a").alias("product_name"),
        F.lit(None).cast("string").alias("supplier_id"))
    later = spark.createDataFrame(
        [("PRO2", "a", None), ("PRO3", "b", "s")], copies.schema)
    ids = keyed.surplus(copies.union(later), ("product_name", "supplier_id"), "sku", F.col("sku"))
    assert {r["sku"]: r["count"] for r in ids.groupBy("sku").count().collect()} == {
        "PRO1": HOT - 1, "PRO2": 1}


def test_orphans_split_the_hot_key(spark, hot_products, small_splits):
    parents = spark.range(50).select(
        F.concat(F.lit("SUP"), F.col("id").cast("string")).alias("supplier_id"))
    frames = {"products": hot_products, "suppliers": parents}
    log = evaluate.rule_violations(frames, sql_rule("orphan_supplier_id"))
    expected = hot_products.join(parents, "supplier_id", "left_anti").count()
    assert log.count() == expected >= HOT
    assert "skew=true" in final_plan(log)
    counted = evaluate.violation_counts(frames, [sql_rule("orphan_supplier_id")]).first()
    assert (counted["violation_count"], counted["row_count"]) == (expected, ROWS)


def test_price_fill_splits_the_hot_category(hot_products, small_splits):
    tagged = standardize.standardize_categories(hot_products)
    medians = standardize.category_medians(tagged)
    filled = standardize.impute_price(tagged, medians)
    assert filled.filter("price_clean is null").count() == 0
    assert filled.count() == ROWS
    assert "skew=true" in final_plan(filled)


def test_drill_through_does_not_multiply_rows(spark, hot_products, small_splits):
    """20,000 rows share one id and each breaks two rules; every row comes back once."""
    source = hot_products.withColumn(
        "sku", F.when(F.col("product_name") == "same", "X").otherwise(F.col("sku")))
    log = source.select(
        F.col("sku").alias("record_id"), F.lit("products").alias("table_name"),
        F.lit("consistency").alias("dimension"),
        F.explode(F.array(F.lit("b"), F.lit("a"))).alias("rule_name"))
    found = report.drill_through(log, source, "sku", "products", "consistency")
    assert found.count() == ROWS
    assert found.select("rules").distinct().collect() == [("a, b",)]
    assert "skew=true" in final_plan(found)


def test_small_sides_are_broadcast_by_size(hot_products):
    """With the usual threshold the written medians are broadcast: products are not shuffled."""
    audit = standardize.standardize_products(hot_products)
    plan = final_plan(audit)
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
