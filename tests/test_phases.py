"""CSV files through all four phases, and the scan's treatment of odd cells."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from veritable.__main__ import main
from veritable.operators import report, score
from veritable.plans import phases
from veritable.sources import raw
from veritable.sources.schemas import ENTITIES
from veritable.sources.tables import Store, TooManyRejects, write_csv

CSV = {
    "products": [
        "sku,product_name,category,price,supplier_id",
        'PRO1,"Level 24""",Tools,10.5,S1',
        'SKU2,"Desk, oak", tools ,N/A,S9',
        "ITM3,Power Drill,,20.5,S1",
    ],
    "suppliers": ["supplier_id,name,lead_time_days,reliability_score", "S1,Acme,3,90.5"],
    "inventory": [
        "sku,warehouse_id,current_stock,safety_stock,last_updated",
        "PRO1,W1,5,1,2025-01-02", "PRO1,W2,,1,02-01-2025", "GONE,W1,5,1,unknown",
    ],
    "inventory_transactions": [
        "transaction_id,sku,warehouse_id,transaction_type,quantity_change,timestamp",
        "T1,PRO1,W1,INBOUND,5,2025-01-02T10:00:00", "T2,PRO1,W1,outbound,-5,2025-01-02",
    ],
    "purchase_orders": [
        "purchase_order_id,supplier_id,sku,qty_ordered,order_date,expected_delivery_date,"
        "delivery_status",
        "P1,S1,PRO1,5,02-01-2025,01/01/2025,Pending", "P2,S1,PRO1,,01/02/2025,03-01-2025,Pending",
    ],
}


@pytest.fixture
def data_dir(tmp_path):
    for name, lines in CSV.items():
        (tmp_path / f"erp_{name}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    phases.prepare(store)
    yield store
    spark.sql("DROP FUNCTION IF EXISTS governance.parse_flexible_date")
    for layer in ("raw", "staging", "governance"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_all_phases(spark, data_dir, store, tmp_path):
    reports = str(tmp_path / "reports")
    loaded = phases.load(spark, store, raw.default_paths(data_dir))
    assert {r[0]: r[1] for r in loaded.collect()} == {
        n: len(lines) - 1 for n, lines in CSV.items()}

    profiled = phases.run_profile(store, reports)
    assert profiled["profiling_column_summary"].count() == 27
    assert profiled["profiling_date_format_violations"].count() == 5

    for when in (dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)):
        assessed = phases.run_assess(store, reports, measured_at=when)
    log = store.read("governance", "violations_log")
    assert {r.rule_name for r in log.filter("table_name = 'products'").collect()} == {
        "missing_required_field", "orphan_supplier_id", "non_canonical_category",
        "non_standard_sku_prefix"}
    assert spark.sql("SELECT record_id, detail FROM governance.v_validity_orphan_supplier "
                     "UNION ALL SELECT record_id, detail FROM v_validity_orphan_supplier"
                     ).collect() == [("SKU2", "supplier_id S9 not found in suppliers")] * 2
    assert spark.sql("SELECT governance.parse_flexible_date('08/10/2025')").first()[0] == dt.date(
        2025, 8, 10)
    card = assessed["quality_scorecard"]
    history = store.read("governance", "quality_scorecard_history")
    assert history.count() == 2 * card.count()
    assert sum(r.violation_count for r in card.collect()) == log.count()

    out = phases.run_standardize(store, reports)
    products = {r.sku: r for r in store.read("staging", "products").collect()}
    assert set(products) == {"SKU1", "SKU2", "SKU3"}
    assert products["SKU3"].category == "Tools" and float(products["SKU2"].price) == 15.5
    assert dict(out["purchase_orders"].dtypes)["order_date"] == "date"
    assert [r.last_updated for r in out["inventory"].orderBy("last_updated").collect()] == [
        None, dt.date(2025, 1, 2), dt.date(2025, 1, 2)]
    issues = {r.issue: (r.affected, r.resolved) for r in out["remediation_summary"].collect()}
    assert issues["malformed last_updated"] == (2, 1)
    assert issues["null category"] == (1, 1)

    made = phases.run_report(store, reports)
    assert set(made) == {f"report_{n}" for n in (
        "composition", "prevalence", "heatmap", "trend", "review_queue", "headline")}
    assert made["report_trend"].count() == history.count()
    assert made["report_trend"].filter("previous_score is not null").count() == card.count()
    assert made["report_headline"].first().total_violations == log.count()
    assert {(r.record_id, r.reason) for r in made["report_review_queue"].collect()} == {
        ("SKU2", "orphan_supplier_id")}

    cells = phases.run_assess(store, reports, ruleset="cell")
    assert cells["violations_log"].columns == ["table_name", "dimension", "record_id"]
    assert store.read("governance", "violations_log").count() == log.count(), "left as it was"


def test_phases_from_the_command_line(spark, data_dir, store, tmp_path, capsys):
    """Each phase finds the tables of the one before by folder."""
    for phase in ("load", "profile", "assess", "standardize", "report"):
        main([phase, "--data", data_dir, "--root", store.root, "--csv"])
    assert "purchase_orders" in capsys.readouterr().out
    assert (tmp_path / "store/reports/staging_products_final").is_dir()
    assert spark.sql("SELECT count(*) FROM governance.quality_scorecard").first()[0] > 0


def test_history_outlives_the_catalog(spark, data_dir, store):
    """A job whose catalog does not know the history still appends to it."""
    phases.load(spark, store, raw.default_paths(data_dir))
    first = phases.run_assess(store, measured_at=dt.datetime(2025, 1, 1))
    scores = first["quality_scorecard"].collect()
    spark.sql("DROP TABLE governance.quality_scorecard_history")
    phases.run_assess(store, measured_at=dt.datetime(2025, 2, 1))
    history = spark.table("governance.quality_scorecard_history")
    assert history.count() == 2 * len(scores)
    assert history.select("measured_at").distinct().count() == 2
    assert spark.table("governance.violations_log").count() == sum(
        r.violation_count for r in scores)


def test_append_doubles_unless_reset(spark, data_dir, store):
    paths = raw.default_paths(data_dir)
    phases.load(spark, store, paths)
    assert store.read("raw", "products").count() == 3
    phases.load(spark, store, paths, mode="append")
    assert store.read("raw", "products").count() == 6
    store.reset_raw()
    phases.load(spark, store, paths, mode="append")
    assert store.read("raw", "products").count() == 3


def test_failed_overwrite_leaves_the_old_table(spark, store, tmp_path):
    old = store.write(spark.range(5).toDF("x"), "raw", "numbers")
    bad = spark.range(5).selectExpr("IF(id = 4, raise_error('broken'), id) AS x")
    with pytest.raises(Exception, match="broken"):
        store.write(bad, "raw", "numbers")
    assert old.count() == spark.table("raw.numbers").count() == 5
    assert [p.name for p in (tmp_path / "store/raw").iterdir()
            if not p.name.startswith(".")] == ["numbers"]


def test_a_table_can_be_rewritten_from_itself(spark, store):
    table = store.write(spark.range(5).toDF("x"), "raw", "numbers")
    store.write(table.where("x > 1"), "raw", "numbers")
    assert spark.table("raw.numbers").count() == 3
    wider = store.write(spark.range(2).selectExpr("id AS x", "'a' AS y"), "raw", "numbers")
    assert spark.table("raw.numbers").collect() == wider.collect()
    for day in (1, 2):
        parts = spark.sql(f"SELECT 1 AS x, {day} AS day")
        store.write(parts, "raw", "days", partition_by=["day"])
    assert spark.sql("SELECT day FROM raw.days").collect() == [(2,)]


def test_views_and_functions_in_another_session(spark, data_dir, store):
    phases.load(spark, store, raw.default_paths(data_dir))
    phases.run_assess(store)
    other = spark.newSession()
    assert other.sql("SELECT count(*) FROM governance.v_validity_orphan_supplier").first()[0] == 1
    assert other.sql("SELECT governance.parse_flexible_date('08/10/2025')").first()[0] == dt.date(
        2025, 8, 10)


def test_scan_keeps_text_as_it_is(spark, data_dir):
    products = raw.read_all(spark, {"products": f"{data_dir}/erp_products.csv"})["products"]
    rows = {r.sku: r for r in products.collect()}
    assert rows["PRO1"].product_name == 'Level 24"'
    assert rows["SKU2"].product_name == "Desk, oak"
    assert (rows["SKU2"].category, rows["SKU2"].price) == (" tools ", None)
    assert rows["ITM3"].category is None
    assert {t for _, t in products.dtypes} == {"string"}


def test_report_round_trip(spark, tmp_path):
    schema = ENTITIES["suppliers"].raw_schema
    rows = [('a "b"', " padded ", None, "x,y"), ("c", "d", "1", "2")]
    write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "report"))
    back = raw.read_csv(spark, str(tmp_path / "report"), schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_lines_of_another_length(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "supplier_id,name,lead_time_days,reliability_score\na,b\nc,d,1,2\n")
    schema = ENTITIES["suppliers"].raw_schema
    rows = raw.read_csv(spark, str(tmp_path / "s.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [("a", "b", None, None), ("c", "d", "1", "2")]
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_csv(spark, str(tmp_path / "s.csv"), schema, mode="FAILFAST").collect()


@pytest.mark.parametrize("line", ["S2,b,1,2,EXTRA", 'S1,"Ac\nme",3,9', 'S1,"open'])
def test_lines_that_would_lose_cells_are_refused(spark, tmp_path, line):
    (tmp_path / "s.csv").write_text(
        f"supplier_id,name,lead_time_days,reliability_score\n{line}\nc,d,1,2\n")
    schema = ENTITIES["suppliers"].raw_schema
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("name").collect()):
        with pytest.raises(Exception, match="malformed line"):
            use(raw.read_csv(spark, str(tmp_path / "s.csv"), schema))


def test_quoted_line_breaks(spark, tmp_path, store):
    for name, lines in CSV.items():
        (tmp_path / f"erp_{name}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "erp_suppliers.csv").write_text(
        'supplier_id,name,lead_time_days,reliability_score\nS1,"Ac\nme",3,9\nS2,b\n')
    phases.load(spark, store, raw.default_paths(str(tmp_path)), multi_line=True)
    rows = sorted(tuple(r) for r in store.read("raw", "suppliers").collect())
    assert rows == [("S1", "Ac\nme", "3", "9"), ("S2", "b", None, None)]


def test_default_time_is_the_same_in_any_zone(spark, monkeypatch):
    card = spark.createDataFrame([("t", "d", 1, 2, 50.0)], "table_name string, dimension string, "
                                 "violation_count long, row_count long, quality_score double")
    seen = []
    for zone in ("America/New_York", "Asia/Tokyo"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        snapshot = score.history_snapshot(card, phases.now())
        seen.append(snapshot.selectExpr("unix_timestamp(measured_at) AS t").first().t)
    monkeypatch.delenv("TZ")
    time.tzset()
    assert 0 <= seen[1] - seen[0] < 60 and abs(time.time() - seen[1]) < 60


def test_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "s.csv").write_text("supplier_id,name,reliability_score,lead_time_days\na,b,c,d\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_csv(spark, str(tmp_path / "s.csv"), ENTITIES["suppliers"].raw_schema).collect()


def test_refused_lines_are_kept_apart(spark, data_dir, store, tmp_path):
    """One line with a cell too many and one open quote: the others are loaded, both are reported."""
    suppliers = ["supplier_id,name,lead_time_days,reliability_score", "S1,Acme,3,90.5", "S2,b,1,2,EXTRA",
                 'S3,"open', "S4,short", 'S5,"x,""1",2,3', 'S6,"open,b']
    (tmp_path / "erp_suppliers.csv").write_text("\n".join(suppliers) + "\n")
    paths = raw.default_paths(data_dir)
    phases.load(spark, store, {"suppliers": f"{data_dir}/erp_suppliers.csv"}, max_rejected=None)
    with pytest.raises(TooManyRejects, match="suppliers: 3 of 6 rows.*EXTRA"):
        phases.load(spark, store, paths, max_rejected=2)
    assert store.read("raw", "suppliers").count() == 3, "as it was"
    loaded = phases.load(spark, store, paths, max_rejected=0.5)
    assert {r.table_name: r.row_count for r in loaded.collect()}["suppliers"] == 3
    assert sorted(tuple(r) for r in store.read("raw", "suppliers").collect()) == [
        ("S1", "Acme", "3", "90.5"), ("S4", "short", None, None), ("S5", 'x,"1', "2", "3")]
    assert spark.table("raw.suppliers").columns == suppliers[0].split(",")
    told = {(r.line, r.reason) for r in store.rejects("raw_rejects", raw.LINE_REJECTS).collect()}
    assert told == {(suppliers[2], "too many cells"), (suppliers[3], "unclosed quote"),
                    (suppliers[6], "unclosed quote")}
    rows = spark.sql("SELECT table_name, source_file, line FROM governance.raw_rejects").collect()
    assert len(rows) == 3 and {r.table_name for r in rows} == {"suppliers"}
    assert all(r.source_file.endswith("erp_suppliers.csv") for r in rows)

    phases.load(spark, store, paths, "append", max_rejected=None)
    assert store.read("raw", "suppliers").count() == 6
    assert store.rejects("raw_rejects", raw.LINE_REJECTS).count() == 6
    (tmp_path / "erp_suppliers.csv").write_text("\n".join(suppliers[:2]) + "\n")
    phases.load(spark, store, paths)
    assert store.rejects("raw_rejects", raw.LINE_REJECTS).count() == 0, "replaced with the load"


def test_staging_rejects(spark, data_dir, store, tmp_path):
    """Wrong dates, numbers and keys by row and reason; the rest is staged."""
    header = CSV["purchase_orders"][0]
    (tmp_path / "erp_purchase_orders.csv").write_text("\n".join([
        header, "P1,S1,K,5,02-01-2025,03-01-2025,Pending", "P2,S1,K,7d,02-01-2025,,Pending",
        ",S1,K,1,02-01-2025,,Pending", "P3,S1,K,1,,,Pending", "P3,S1,K,2.12345678901,,,Pending"]) + "\n")
    phases.load(spark, store, raw.default_paths(data_dir))
    with pytest.raises(TooManyRejects, match="purchase_orders: 4 of 5 rows"):
        phases.run_standardize(store, max_rejected=3)
    lost = {(r.table_name, r.column): r.lost
            for r in store.read("governance", "staging_lost_casts").collect()}
    assert lost["purchase_orders", "qty_ordered"] == 2
    out = phases.run_standardize(store, max_rejected=0.8)
    assert [r.purchase_order_id for r in out["purchase_orders"].collect()] == ["P1"]
    assert out["products"].count() == 3 and out["inventory"].count() == 3
    found = sorted(tuple(r)[2:] for r in out["staging_rejects"].collect())
    assert found == [
        ("", "purchase_order_id", None, "key is null"),
        ("P2", "qty_ordered", "7d", "no decimal(38,10)"),
        ("P3", "purchase_order_id", "P3", "key is repeated"),
        ("P3", "purchase_order_id", "P3", "key is repeated"),
        ("P3", "qty_ordered", "2.12345678901", "not exact as decimal(38,10)")]
    assert spark.table("governance.staging_rejects").count() == 5


def test_counters_come_from_the_writes(spark, data_dir, store, tmp_path):
    """No job of load and standardize scans a table only to count it."""
    loaded = phases.load(spark, store, raw.default_paths(data_dir))
    assert not loaded.inputFiles(), "a local relation"
    out = phases.run_standardize(store)
    frames = phases.raw_frames(store)
    audit = store.read("governance", "staging_products")
    assert sorted(map(tuple, out["remediation_summary"].collect())) == sorted(
        map(tuple, report.remediation_summary(audit, frames).collect()))
    rows = store.write_raw(frames)
    assert not rows.inputFiles() and {r[0]: r[1] for r in rows.collect()} == {
        n: len(lines) - 1 for n, lines in CSV.items()}
