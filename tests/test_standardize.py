from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritable.functions import dates
from veritable.operators import standardize
from veritable.sources.schemas import ENTITIES

SCHEMA = ENTITIES["products"].raw_schema


def test_category_is_cleaned_or_inferred(spark):
    df = spark.createDataFrame(
        [("1", "Phone Mount", " tools ", None, None), ("2", "Phone Mount", None, None, None),
         ("3", "Snowboard App", None, None, None), ("4", "Chair", None, None, None),
         ("5", None, None, None, None), ("6", "x", "  ", None, None)], SCHEMA)
    clean = standardize.standardize_categories(df).orderBy("sku").select("category_clean")
    assert [r[0] for r in clean.collect()] == [
        "Tools", "Accessories", "Software", None, None, ""]


def test_collisions_stop_the_rewrite(spark):
    df = spark.createDataFrame([("PRO00001",), ("ITM00001",), ("X2",)], "sku string")
    rewritten = standardize.standardize_sku_prefix(df)
    assert standardize.collisions(rewritten).collect() == [("SKU00001", 2)]
    with pytest.raises(ValueError, match="1 duplicate"):
        standardize.assert_no_collisions(rewritten)
    standardize.assert_no_collisions(rewritten.filter("sku != 'ITM00001'"))


def test_key_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 1)], "k string, v int")
    problems = standardize.key_problems(df, ["k", "v"])
    assert {tuple(r) for r in problems.collect()} == {("a", 1, 2), ("b", None, 1)}
    with pytest.raises(ValueError, match="no key"):
        standardize.assert_key(df, ["k"])
    standardize.assert_key(df.filter("k != 'a'"), ["k"])


def test_price_fill(spark):
    rows = [("1", "n", "A", "1", None), ("2", "n", "A", "4", None), ("3", "n", "A", "oops", None),
            ("4", "zzz", None, None, None), ("5", "zzz", None, "7", None),
            ("6", "n", "B", None, None)]
    audit = standardize.standardize_products(spark.createDataFrame(rows, SCHEMA))
    prices = {r.sku: (r.price, r.price_clean) for r in audit.collect()}
    assert prices["3"] == (None, 2.5)
    assert prices["4"] == (None, None), "NULL categories have no median"
    assert prices["5"] == (7.0, 7.0)
    assert prices["6"] == (None, None)


@pytest.mark.parametrize("ranked", [200, 100_000])
def test_medians_are_exact(spark, ranked):
    """Heavy ties, continuous values, tiny groups, outliers: all equal numpy's median."""
    rng = np.random.default_rng(7)
    groups = {
        "uniform": rng.uniform(-5, 5, 40_001), "even": rng.uniform(0, 1, 30_000),
        "ties": rng.integers(0, 3, 20_000).astype(float), "one": np.array([3.0]),
        "two": np.array([1.0, 4.0]), "constant": np.full(5_000, 2.5),
        "outlier": np.concatenate([rng.normal(0, 1e-6, 9_999), [1e300]]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [(None, 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(16)
    medians = {r.g: r["median"] for r in standardize.exact_medians(df, "g", "v", ranked).collect()}
    assert medians == {g: float(np.median(v)) for g, v in groups.items()}


def test_dates_keep_what_the_primary_format_read(spark):
    df = spark.createDataFrame(
        [("08/10/2025",), ("08-10-2025",), ("2025-10-08",), ("31-02-2020",), (None,)],
        "last_updated string")
    formats = (dates.YMD, dates.DMY, dates.MDY)
    out = standardize.standardize_dates(df, "last_updated", formats).collect()
    assert [r[1] for r in out] == [
        dt.date(2025, 8, 10), dt.date(2025, 10, 8), dt.date(2025, 10, 8), None, None]
    counts = standardize.date_recovery_counts(df, "t", {"last_updated": formats}).first()
    assert tuple(counts) == ("t", "last_updated", 4, 1, 2, 1)


def test_cleaned_products_break_no_format_rule(spark):
    from veritable.operators import evaluate, rules

    rows = [(f"PRO{i}", "lamp", c, "1", "s") for i, c in enumerate([" tools", "TOOLS", "Tools"])]
    audit = standardize.standardize_products(spark.createDataFrame(rows, SCHEMA))
    final = standardize.final_products(audit).withColumn("price", F.col("price").cast("string"))
    catalog = [r for r in rules.sql_rules()
               if r.name in ("non_canonical_category", "non_standard_sku_prefix")]
    assert evaluate.violations_log({"products": final}, catalog).count() == 0
    assert tuple(final.columns) == ENTITIES["products"].columns


def test_lost_casts(spark):
    df = spark.createDataFrame([("1", "n", "c", "12x", "s"), ("2", "n", "c", "1.5", "s")], SCHEMA)
    assert standardize.lost_casts(df, ENTITIES["products"]).collect() == [("price", 1)]


def test_wide_and_fine_numbers(spark):
    """What fits is kept to the last digit; what does not is counted, rounding included."""
    kept = ["123456789012345.5", "0.00004", "1.23456", "-7", "+1.50", " 2. ", ".5", "1e3", "0012.10000000000000"]
    lost = ["0.12345678901", "1" * 29, "1e-11", "x"]
    df = spark.createDataFrame([(str(i), "n", "c", p, "s") for i, p in enumerate(kept + lost)], SCHEMA)
    entity = ENTITIES["products"]
    assert standardize.lost_casts(df, entity).collect() == [("price", len(lost))]
    typed = {r.sku: r.price for r in standardize.to_staging(df, entity).collect()}
    assert [typed[str(i)] for i in range(len(kept))] == [Decimal(p.strip()) for p in kept]


def test_lost_casts_stop_the_run(spark):
    report = spark.createDataFrame([("products", "price", 2), ("products", "x", 0)],
                                   "table_name string, column string, lost long")
    with pytest.raises(ValueError, match="products.price: 2"):
        standardize.assert_no_lost_casts(report)
    standardize.assert_no_lost_casts(report.where("lost = 0"))
