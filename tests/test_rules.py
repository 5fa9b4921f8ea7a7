"""Each rule on hand-made rows, for the cases where NULL, blanks and casing matter."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritable.operators import evaluate, rules, score
from veritable.sources.schemas import ENTITIES

PRODUCTS = [
    # sku, product_name, category, price, supplier_id
    ("SKU1", "lamp", "Tools", "5", "S1"),
    ("PRO2", "lamp", "tools", "0", "S1"),
    ("sku3", "desk", " Tools", "-1.5", " S1 "),
    ("4", "desk", None, None, None),
    ("ITM5", "desk", "3d Print", "x", None),
    ("ITM6", "sofa", None, "9", "S9"),
]
SUPPLIERS = [("S1", "a", "1", "1"), ("S2 ", "b", "1", "1")]
ORDERS = [
    # id, supplier, sku, qty, order_date, expected, status
    ("P1", "S1", "SKU1", "1", "09-05-2025", "10-05-2025", "In-Transit"),
    ("P2", "S1", "SKU1", None, None, "10-05-2025", "In-transit"),
    ("P3", "S1", "SKU1", "1", "09/05/2025", "04-09-2025", "Pending "),
    ("P4", "S1", "SKU1", "1", "9-5-2025", "31-02-2020", None),
    ("P5", "S1", "SKU1", "1", "someday", "01-01-2001", "Delivered"),
]
TRANSACTIONS = [
    ("T1", "SKU1", "W", "INBOUND", "5", "2025-01-01T00:00:00"),
    ("T2", "SKU1", "W", " outbound ", "5", "2025-01-01T00:00:00"),
    ("T3", "SKU1", "W", "OUTBOUND", "0", "2025-01-01 00:00:00"),
    ("T4", "SKU1", "W", "INBOUND", None, None),
    ("T5", "SKU1", "W", None, "-3", "x"),
    ("T6", "SKU1", "W", "INBOUND", "-0.5", "2025-01-01T00:00:00"),
]
INVENTORY = [("SKU1", "W", "1", "1", "2025-01-01"), ("SKU1", "V", "1", "1", "01-01-2025"),
             ("GONE", "V", "1", "1", "01/13/2025"), (None, "V", "1", "1", None)]


@pytest.fixture(scope="module")
def frames(spark):
    rows = {"products": PRODUCTS, "suppliers": SUPPLIERS, "purchase_orders": ORDERS,
            "inventory_transactions": TRANSACTIONS, "inventory": INVENTORY}
    return {n: spark.createDataFrame(r, ENTITIES[n].raw_schema) for n, r in rows.items()}


def found(frames, catalog, table, name):
    rule = next(r for r in catalog if (r.table, r.name) == (table, name))
    log = evaluate.rule_violations(frames, rule)
    assert tuple(log.columns) == evaluate.LOG_COLUMNS
    return sorted((r.record_id, r.detail) for r in log.collect())


@pytest.mark.parametrize("table, name, expected", [
    ("products", "missing_required_field",
     [("4", "category"), ("ITM5", "supplier_id"), ("ITM6", "category")]),
    ("purchase_orders", "missing_required_field", [("P2", "qty_ordered"),
                                                   ("P4", "delivery_status")]),
    ("products", "duplicate_product_supplier",
     [(i, "duplicate (product_name, supplier_id) pair") for i in ("4", "ITM5", "PRO2", "SKU1")]),
    ("products", "orphan_supplier_id", [("ITM6", "supplier_id S9 not found in suppliers")]),
    ("products", "non_positive_price", [("PRO2", "price = 0"), ("sku3", "price = -1.5")]),
    ("products", "non_canonical_category", [("PRO2", 'category = "tools"'),
                                            ("sku3", 'category = " Tools"')]),
    ("purchase_orders", "non_canonical_delivery_status",
     [("P2", 'delivery_status = "In-transit"'), ("P3", 'delivery_status = "Pending "')]),
    ("inventory_transactions", "non_canonical_transaction_type",
     [("T2", 'transaction_type = " outbound "')]),
    ("products", "non_standard_sku_prefix",
     [("ITM5", "prefix = ITM"), ("ITM6", "prefix = ITM"), ("PRO2", "prefix = PRO"),
      ("sku3", "prefix = sku")]),
    ("purchase_orders", "non_primary_date_format",
     [("P3", 'order_date = "09/05/2025" did not match DD-MM-YYYY'),
      ("P4", 'order_date = "9-5-2025" did not match DD-MM-YYYY')]),
    ("purchase_orders", "delivery_before_order",
     [("P3", "expected_delivery_date before order_date")]),
    ("inventory_transactions", "sign_mismatch",
     [("T2", " outbound  with quantity_change = 5"),
      ("T6", "INBOUND with quantity_change = -0.5")]),
])
def test_sql_rules(frames, table, name, expected):
    assert found(frames, rules.sql_rules(), table, name) == sorted(expected)


@pytest.mark.parametrize("table, name, expected", [
    ("products", "missing_category", ["4", "ITM6"]),
    ("products", "missing_price", ["4"]),
    ("products", "missing_supplier_id", ["4", "ITM5"]),
    ("products", "surplus_product_supplier", ["ITM5", "PRO2"]),
    ("products", "orphan_supplier_id", ["ITM6", "sku3"]),
    ("products", "non_canonical_category", ["ITM5", "PRO2", "sku3"]),
    ("purchase_orders", "off_format_order_date", ["P3", "P5"]),
    ("purchase_orders", "off_format_expected_delivery_date", ["P4"]),
    ("inventory", "off_format_last_updated", ["GONE", "SKU1"]),
])
def test_cell_rules(frames, table, name, expected):
    assert [i for i, _ in found(frames, rules.cell_rules(), table, name)] == expected


@pytest.mark.parametrize("ruleset", ["sql", "cell"])
def test_counts_agree_with_the_log(frames, ruleset):
    catalog = rules.RULESETS[ruleset]()
    log = evaluate.violations_log(frames, catalog)
    by_log = {tuple(r)[:3]: r["count"] for r in
              log.groupBy("table_name", "dimension", "rule_name").count().collect()}
    counted = evaluate.violation_counts(frames, catalog).collect()
    assert {tuple(r)[:3]: r["violation_count"] for r in counted if r["violation_count"]} == by_log
    assert {r["table_name"]: r["row_count"] for r in counted}.items() <= {
        n: df.count() for n, df in frames.items()}.items()

    exact = ruleset == "sql"
    cards = (score.scorecard_from_log(log, score.row_counts(frames), exact),
             score.scorecard(evaluate.violation_counts(frames, catalog), exact))
    assert sorted(cards[0].collect()) == sorted(cards[1].collect())


def test_every_log_id_exists_in_its_table(frames):
    log = evaluate.violations_log(frames, rules.sql_rules())
    for rule in rules.sql_rules():
        ids = log.filter(F.col("table_name") == rule.table).select("record_id")
        known = frames[rule.table].select(F.col(rule.record_id).alias("record_id"))
        assert ids.join(known, "record_id", "left_anti").count() == 0


def test_a_user_can_add_a_rule(frames):
    late = rules.RowRule("suppliers", "supplier_id", "validity", "padded_id",
                         F.col("supplier_id") != F.trim("supplier_id"), F.col("supplier_id"))
    counts = evaluate.violation_counts(frames, [*rules.sql_rules(), late])
    assert counts.filter("rule_name = 'padded_id'").first()["violation_count"] == 1


def test_rule_views(spark, frames):
    names = evaluate.create_rule_views(frames, rules.sql_rules())
    assert len(set(names)) == 12
    assert spark.sql("SELECT record_id FROM v_accuracy_po_dates").collect() == [("P3",)]


def test_row_rules_scan_a_table_once(frames, spark, tmp_path):
    frames["products"].write.parquet(str(tmp_path / "p"))
    stored = {**frames, "products": spark.read.parquet(str(tmp_path / "p"))}
    row_rules = [r for r in rules.select_rules(rules.sql_rules(), "products")
                 if isinstance(r, rules.RowRule)]
    assert len(row_rules) == 4
    for df in (evaluate.violations_log(stored, row_rules),
               evaluate.violation_counts(stored, row_rules)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[-1].count("FileScan") == 1
