from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veritable.operators import profile, report, score

COUNTS = "table_name string, dimension string, rule_name string, violation_count long, row_count long"


def products(spark, rows):
    return spark.createDataFrame(
        rows, "sku string, product_name string, category string, price string, supplier_id string")


def test_column_profile(spark):
    df = spark.createDataFrame(
        [("a", " x"), ("b", None), ("b", "x\t"), (None, "x"), ("c", "x")], "k string, v string")
    rows = {r["column"]: r for r in profile.column_profile({"t": df}).collect()}
    assert tuple(rows["k"]) == ("t", "k", 5, 1, 20.0, 3, 0)
    assert tuple(rows["v"]) == ("t", "v", 5, 1, 20.0, 3, 2)


def test_approximate_profile(spark):
    """Distinct counts within three deviations, the rest exact, and no cell in a shuffle."""
    df = spark.range(30000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, " x").alias("v"))
    exact = {r["column"]: r for r in profile.column_profile({"t": df}).collect()}
    rough = profile.column_profile({"t": df}, distinct_error=0.02)
    plan = rough._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(number" in plan
    for r in rough.collect():
        e = exact[r["column"]]
        assert abs(r.distinct_count - e.distinct_count) <= 0.06 * e.distinct_count
        assert (r.row_count, r.null_count, r.whitespace_dirty_count) == (
            e.row_count, e.null_count, e.whitespace_dirty_count)


def test_typed_tables_can_be_profiled_too(spark):
    df = spark.sql("SELECT 1 AS a, DATE'2025-01-01' AS b UNION ALL SELECT NULL, DATE'2025-01-01'")
    rows = {r["column"]: tuple(r)[2:] for r in profile.column_profile({"t": df}).collect()}
    assert rows == {"a": (2, 1, 50.0, 1, 0), "b": (2, 0, 0.0, 1, 0)}
    other = profile.Reference("t", "a", "t", "a")
    assert profile.reference_checks({"t": df}, [other]).first()[1] == 0


def test_null_percent_rounds_halves_to_even(spark):
    df = spark.range(8000).select(F.when(F.col("id") >= 262, "x").alias("v"))
    assert profile.column_profile({"t": df}).first()["null_pct"] == 3.28


def test_null_keys_in_duplicate_and_reference_checks(spark):
    child = products(spark, [("A", "n", "c", "1", None), ("A", "n", "c", "1", None),
                             (None, "n", "c", "1", "S1"), (None, "m", "c", "1", "S9")])
    suppliers = spark.createDataFrame([("S1",), (None,)], "supplier_id string")
    inventory = spark.createDataFrame([("A",), (None,), ("Z",)], "sku string")
    frames = {"products": child, "suppliers": suppliers, "inventory": inventory}
    assert [r[1] for r in profile.duplicate_checks(frames).collect()] == [2, 1, 0]

    def check(skip, parent=suppliers):
        ref = profile.Reference("products", "supplier_id", "suppliers", "supplier_id", skip)
        return profile.reference_checks({**frames, "suppliers": parent}, [ref]).first()[1]

    assert check(skip=True) == 1
    assert check(skip=False) == 1, "a NULL child is found when the parent has a NULL"
    assert check(skip=False, parent=suppliers.dropna()) == 3
    stock = profile.Reference("inventory", "sku", "products", "sku")
    assert profile.reference_checks(frames, [stock]).first()[1] == 1


def test_empty_child_gives_zero(spark):
    empty = products(spark, [])
    suppliers = spark.createDataFrame([("S1",)], "supplier_id string")
    frames = {"products": empty, "suppliers": suppliers}
    assert profile.reference_checks(frames, profile.REFERENCES[:1]).first()[1] == 0
    assert profile.duplicate_checks(frames).first()[1] == 0


def test_prefixes_most_frequent_first(spark):
    df = products(spark, [(k, "n", "c", "1", "s") for k in ("B1", "A1", "A2", "7")])
    assert [tuple(r) for r in profile.prefix_distribution(df).collect()] == [
        ("A", 2), (None, 1), ("B", 1)]


# Published results, as counts by rule.
PUBLISHED = [
    ("products", "completeness", "r1", 21, 200), ("products", "uniqueness", "r3", 10, 200),
    ("products", "validity", "r4", 3, 200), ("products", "validity", "r5", 0, 200),
    ("products", "consistency", "r6", 10, 200), ("products", "consistency", "r9", 150, 200),
    ("purchase_orders", "completeness", "r2", 189, 3000),
    ("purchase_orders", "consistency", "r7", 87, 3000),
    ("purchase_orders", "consistency", "r10", 24, 3000),
    ("purchase_orders", "accuracy", "r11", 21, 3000),
    ("inventory_transactions", "consistency", "r8", 253, 8000),
    ("inventory_transactions", "accuracy", "r12", 0, 8000),
]


@pytest.fixture(scope="module")
def card(spark):
    return score.scorecard(spark.createDataFrame(PUBLISHED, COUNTS))


def test_published_scores(card):
    scores = {(r[0], r[1]): float(r["quality_score"]) for r in card.collect()}
    assert scores[("products", "consistency")] == 0.2
    assert ("inventory_transactions", "accuracy") not in scores
    domains = score.domain_scorecard(card).collect()
    assert [(r.domain, float(r.overall_score), r.total_violations) for r in domains] == [
        ("products", 0.7575, 194), ("purchase_orders", 0.9643, 321),
        ("inventory_transactions", 0.9684, 253)]


def test_published_composition(spark, card):
    shares = [(r.dimension, r.violation_count, float(r[2]))
              for r in report.composition(card).collect()]
    assert shares == [("consistency", 524, 68.23), ("completeness", 210, 27.34),
                      ("accuracy", 21, 2.73), ("uniqueness", 10, 1.3), ("validity", 3, 0.39)]
    rows = spark.createDataFrame(
        [("products", 200), ("suppliers", 30), ("inventory", 1000),
         ("inventory_transactions", 8000), ("purchase_orders", 3000)],
        "table_name string, row_count long")
    prevalence = report.prevalence(card, rows).filter("dimension = 'consistency'").first()
    assert (prevalence["total_rows"], float(prevalence["prevalence_pct"])) == (12230, 4.28)
    assert report.top_category(card).first()["dimension"] == "consistency"


def test_heatmap_leaves_unmeasured_cells_empty(card):
    row = report.heatmap(card).filter("table_name = 'inventory_transactions'").first()
    assert float(row["consistency"]) == 0.9684 and row["accuracy"] is None


def test_cell_domain_mean_is_not_rounded(spark):
    counts = [("products", d, d, n, 200) for d, n in (
        ("completeness", 21), ("consistency", 10), ("uniqueness", 5), ("validity", 3))]
    counts += [("purchase_orders", d, d, n, 3000) for d, n in (
        ("accuracy", 60), ("completeness", 193), ("consistency", 87))]
    cells = score.scorecard(spark.createDataFrame(counts, COUNTS), exact=False)
    assert [tuple(r) for r in score.cell_domain_scorecard(cells).collect()] == [
        ("products", 0.9512499999999999, 39), ("purchase_orders", 0.9622333333333333, 340)]


def test_scores_can_be_negative_and_need_rows(spark):
    counts = spark.createDataFrame(
        [("a", "x", "r", 7, 4), ("b", "x", "r", 1, 0)], COUNTS)
    for exact in (True, False):
        scores = {r[0]: r["quality_score"] for r in score.scorecard(counts, exact).collect()}
        assert float(scores["a"]) == -0.75 and scores["b"] is None


def test_trend(card):
    first = score.history_snapshot(card, dt.datetime(2025, 1, 1))
    second = score.history_snapshot(card, dt.datetime(2025, 2, 1)).withColumn(
        "quality_score", (F.col("quality_score") + F.lit("0.01").cast("decimal(38,4)")))
    trend = score.score_trend(first.unionByName(second)).filter("previous_score is not null")
    assert {float(r["change"]) for r in trend.collect()} == {0.01}
